"""Incremental runs: new documents of a folder through the bronze reader, each once.

The reference behaviour is "skip what has an output already"; here a file-source stream with a checkpoint does
that: `available_now` takes what is new and ends. A document whose deliverable isn't there yet simply joins to nothing and
comes with a later run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quirefold.operators.nested import read_pages, words_of


def document_stream(spark: SparkSession, folder: str, schema: StructType | str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def available_now(stream: DataFrame, path: str, checkpoint: str, name: str | None = None) -> None:
    """Append what is new to path and end."""
    w = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    (w.queryName(name) if name else w).start().awaitTermination()


def ocr_words(spark: SparkSession, folder: str, path: str, checkpoint: str) -> None:
    """New raw OCR records (rec_id, raw_json) of a folder as word rows; copies of a record in one run count once."""
    s = document_stream(spark, folder, "rec_id long, raw_json string")

    def batch(df: DataFrame, _id: int) -> None:
        words_of(read_pages(df.dropDuplicates(["rec_id"]), meta=False)).write.mode("append").parquet(path)

    s.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def event_windows(events: DataFrame, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums of events by type and window, with a watermark for late ones; works on a table and on a stream."""
    t = F.col("ts").cast("timestamp")
    x = events.withColumn("t", t).withWatermark("t", late)
    return x.groupBy(F.window("t", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")
