"""Session builder and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def build_session(app: str = "quirefold", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the tests and bench use; a cluster brings its own."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("QUIREFOLD_DRIVER_MEMORY", "8g"))
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share.

    Only where it is unset (tests on one machine) a temporary folder is set instead."""
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        d = sc._jsc.sc().getCheckpointDir()
        d = d.get() if d.isDefined() else None
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = "file://" + tempfile.mkdtemp(prefix="quirefold-")
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def _app_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/quirefold-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder for a table of this application."""
    return f"{_app_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder and read back: the lineage is cut and a lost
    executor costs nothing that was computed before. `release` deletes what an application wrote."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def counted(df: DataFrame, name: str, **what: Column) -> tuple[DataFrame, dict]:
    """`written`, and aggregates of what was written, found on the way without another pass."""
    seen = Observation()
    out = written(df.observe(seen, *[c.alias(n) for n, c in what.items()]), name)
    return out, seen.get


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def forget(df: DataFrame) -> None:
    """Deletes the table of a result of `written` that nothing reads any more, as those of the rounds of a loop."""
    if path := getattr(df, "_written_at", None):
        _delete(df.sparkSession, path)


def release(spark: SparkSession) -> None:
    """Deletes all intermediates this application wrote; results that aren't computed yet can't be any more."""
    _delete(spark, _app_dir(spark))
