"""Train, validation and test splits that keep related records together.

Entities (documents, by the key of their name) and their ties are kept in a component table
(node, comp). An update maps new ties to the components they touch, merges those by hooking to the smallest
neighbour and pointer jumping, and rewrites only the labels that changed. Splits are kept by node and
configuration: components that have a split keep it, new ones fill what the splits still lack, and where
a merge ties components of different splits, their nodes keep their splits and are marked as quarantined.

`Store` keeps both tables from run to run. Null keys tie nothing; self ties and repeated ties count once; empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirefold.session import counted, forget, written

NODE = "node string, comp string"
SPLITS = ("validation", "test", "train")
#: A component over this share of all rows is placed one by one; there are at most 1/LARGE of them.
LARGE = 0.002
#: Small components are put in seeded order by way of so many buckets.
BUCKETS = 256


def merge_labels(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, comp) of every node of the edges (a, b): the smallest node of its connected component."""
    e = edges.filter("a is not null and b is not null and a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    live, got = counted(e, "ties", n=F.count(F.lit(1)))
    both = live.union(live.select("b", "a"))
    parent = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select("node", F.least("node", "least").alias("comp"))
    for _ in range(rounds):
        parent = _jump(written(parent, "parents"))
        if not got["n"]:
            return parent
        ties = (
            live.join(parent.select(F.col("node").alias("a"), F.col("comp").alias("ra")), "a")
            .join(parent.select(F.col("node").alias("b"), F.col("comp").alias("rb")), "b")
            .filter("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
            .distinct()
        )
        old = live
        live, got = counted(ties, "ties", n=F.count(F.lit(1)))
        forget(old)
        if not got["n"]:
            return parent
        hook = live.union(live.select("b", "a")).groupBy(F.col("a").alias("root")).agg(F.min("b").alias("least")).filter("least < root")
        parent = parent.join(hook, parent.comp == hook.root, "left").select("node", F.coalesce("least", "comp").alias("comp"))
    raise RuntimeError("components didn't settle")


def _jump(parent: DataFrame) -> DataFrame:
    """Pointer jumping: every node points to its parent's parent, until all point to roots."""
    while True:
        up = parent.filter("node <> comp").select(F.col("node").alias("n"), F.col("comp").alias("c"))
        far = parent.join(up, parent.comp == up.n, "left").select("node", F.coalesce("c", "comp").alias("comp"), F.col("c").isNotNull().alias("moved"))
        far, got = counted(far, "parents", moved=F.count_if("moved"))
        forget(parent)
        parent = far.drop("moved")
        parent._written_at = far._written_at
        if not got["moved"]:
            return parent


def update_components(old: DataFrame | None, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The component table after new nodes (node) and ties (a, b)."""
    spark = nodes.sparkSession
    old = spark.createDataFrame([], NODE) if old is None else old.select("node", "comp")
    e = edges.filter("a is not null and b is not null")
    known = nodes.select("node").filter("node is not null").union(e.select("a")).union(e.select("b")).distinct()
    table = old.union(known.join(old, "node", "left_anti").select("node", F.col("node").alias("comp")))
    # ties between nodes become ties between the components they are in now
    mapped = (
        e.join(old.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a", "left")
        .join(old.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b", "left")
        .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    )
    to = merge_labels(mapped).select(F.col("node").alias("was"), F.col("comp").alias("now"))
    return table.join(to, table.comp == to.was, "left").select("node", F.coalesce("now", "comp").alias("comp"))


def assign(components: DataFrame, sizes: DataFrame, configs: list[dict], old: DataFrame | None = None) -> DataFrame:
    """(node, comp, config_id, split, quarantined) for every node and configuration.

    sizes: (node, n), the rows of each node. configs: config_id, val_ratio, test_ratio (null: 0), seed; a
    handful of settings, not data. old: the result of the update before."""
    spark = components.sparkSession
    if not configs:
        return spark.createDataFrame([], "node string, comp string, config_id int, split string, quarantined boolean")
    comp = components.join(sizes, "node", "left").groupBy("comp").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    comp = written(comp, "sizes")
    total = comp.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    big = comp.filter(F.col("n") > LARGE * total).orderBy(F.desc("n"), "comp").collect()  # fewer than 1/LARGE rows
    kept = None
    if old is not None:
        kept = components.join(old.select("node", "config_id", "split"), "node").join(sizes, "node", "left")
        kept = kept.groupBy("comp", "config_id", "split").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("kept_n"))
        by = Window.partitionBy("comp", "config_id")
        kept = kept.withColumn("kinds", F.count("*").over(by)).withColumn("rank", F.row_number().over(by.orderBy(F.desc("kept_n"), "split")))
        kept = written(kept, "kept")
    parts = []
    for c in configs:
        ratios = {"validation": float(c["val_ratio"] or 0), "test": float(c["test_ratio"] or 0)}
        ratios["train"] = max(0.0, 1 - sum(ratios.values()))
        seed = int(c["seed"] or 0)
        have = dict.fromkeys(SPLITS, 0.0)
        mine = None
        if kept is not None:
            mine = kept.filter((F.col("config_id") == c["config_id"]) & (F.col("rank") == 1)).select("comp", "split", (F.col("kinds") > 1).alias("quarantined"))
            for r in mine.join(comp, "comp").groupBy("split").agg(F.sum("n").alias("n")).collect():
                have[r.split] += r.n
        fixed = {r.comp for r in mine.join(comp, "comp").filter(F.col("n") > LARGE * total).select("comp").collect()} if mine is not None else set()
        placed = []
        for r in big:
            if r.comp not in fixed:
                # where most is lacking, measured in rows; a component no split has room for goes where it spills least
                at = max(SPLITS, key=lambda s: (ratios[s] * total - have[s], s)) if ratios["train"] < 1 else "train"
                have[at] += r.n
                placed.append((r.comp, at))
        rest = comp.join(spark.createDataFrame(placed, "comp string, split string").select("comp"), "comp", "left_anti")
        if mine is not None:
            rest = rest.join(mine, "comp", "left_anti")
        h = F.xxhash64("comp", F.lit(seed))
        rest = rest.withColumn("h", h).withColumn("bucket", F.pmod("h", F.lit(BUCKETS)).cast("int"))
        heads = {r.bucket: r.n for r in rest.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}  # at most BUCKETS rows
        left, before, acc = sum(heads.values()), [], 0
        for b in range(BUCKETS):
            before.append((b, acc))
            acc += heads.get(b, 0)
        lack = {s: max(0.0, ratios[s] * total - have[s]) for s in SPLITS}
        scale = left / sum(lack.values()) if sum(lack.values()) else 0.0
        v, t = lack["validation"] * scale, (lack["validation"] + lack["test"]) * scale
        mid = F.col("before") + F.sum("n").over(Window.partitionBy("bucket").orderBy("h", "comp")) - F.col("n") / 2
        rest = rest.join(F.broadcast(spark.createDataFrame(before, "bucket int, before long")), "bucket").withColumn("mid", mid)
        rest = rest.select("comp", F.when(F.col("mid") < v, "validation").when(F.col("mid") < t, "test").otherwise("train").alias("split"), F.lit(False).alias("quarantined"))
        all_ = rest.union(spark.createDataFrame([(k, s, False) for k, s in placed], "comp string, split string, quarantined boolean"))
        if mine is not None:
            all_ = all_.union(mine)
        parts.append(all_.withColumn("config_id", F.lit(int(c["config_id"]))))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    out = components.join(out, "comp").select("node", "comp", "config_id", "split", "quarantined")
    if old is not None:  # a node that has a split keeps it, also within a conflicting merge
        was = old.select("node", "config_id", F.col("split").alias("was"))
        out = out.join(was, ["node", "config_id"], "left").select("node", "comp", "config_id", F.coalesce("was", "split").alias("split"), "quarantined")
    return out


class Store:
    """A table kept between runs, in numbered versions below one folder; a version counts once it is whole, so a
    run that fails leaves the one before. Used for the component table and the splits."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(at):
            return []
        names = [x.getPath().getName() for x in fs.listStatus(at)]
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit() and fs.exists(done(f"{self.path}/{n}/_SUCCESS")))

    def load(self) -> DataFrame | None:
        """The newest version, None if there is none yet."""
        v = self.versions()
        return self.spark.read.parquet(f"{self.path}/v{v[-1]:06d}") if v else None

    def save(self, df: DataFrame) -> DataFrame:
        """Writes the next version and reads it back; older ones stay for runs that still read them."""
        v = (self.versions() or [0])[-1] + 1
        df.write.mode("overwrite").parquet(f"{self.path}/v{v:06d}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/v{v:06d}")


def shared_pairs(stems: DataFrame, components: DataFrame) -> DataFrame:
    """(stem_a, stem_b), stem_a < stem_b: spellings (stem, node) whose nodes are in one component.

    As many rows as pairs; `component_stems` tells the same in one row a spelling."""
    x = stems.join(components, "node", "left").select("stem", F.coalesce("comp", "node").alias("comp")).filter("comp is not null")
    a, b = x.select(F.col("stem").alias("stem_a"), "comp"), x.select(F.col("stem").alias("stem_b"), "comp")
    return a.join(b, "comp").filter("stem_a < stem_b").select("stem_a", "stem_b")


def component_stems(stems: DataFrame, components: DataFrame) -> DataFrame:
    """(stem, comp, links): the component of each spelling (stem, node), and with how many other spellings it is shared."""
    x = stems.join(components, "node", "left").select("stem", F.coalesce("comp", "node").alias("comp")).filter("comp is not null")
    return x.join(x.groupBy("comp").agg((F.count("*") - 1).alias("links")), "comp").select("stem", "comp", "links")


#: Settings in prep_config; more is an error.
MAX_CONFIGS = 1000


def configs_of(spark: SparkSession, path: str) -> list[dict]:
    """The settings of prep_config, one for each config_id."""
    import math

    rows = spark.read.parquet(path).filter("config_id is not null").dropDuplicates(["config_id"]).orderBy("config_id").limit(MAX_CONFIGS + 1).collect()
    if len(rows) > MAX_CONFIGS:
        raise ValueError(f"more than {MAX_CONFIGS} configurations")
    return [{k: None if isinstance(v, float) and math.isnan(v) else v for k, v in r.asDict().items()} for r in rows]
