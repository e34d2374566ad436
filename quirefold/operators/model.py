"""The heading filter: labels, imputation, a classifier that keeps the given directions, audit, reclassification.

The classifier is a logistic regression whose coefficients are bounded to the direction each feature may act
in; without directions it can be a boosted forest. It is fitted on at most MAX_TRAIN labelled rows, taken
by hash, and scores every row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_TRAIN = 500_000
LEAST_ROWS = 20


def label(c: Column) -> Column:
    """1, 0 or null: numbers as they are, -1 as 0, anything else as no label."""
    x = c.try_cast("double")
    return F.when(x == 1, 1).when((x == 0) | (x == -1), 0)


def impute(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls, NaN and infinities as 0."""
    def clean(n: str) -> Column:
        x = F.nanvl(F.col(n).cast("double"), F.lit(0.0))
        return F.when(F.abs(x) == float("inf"), 0.0).otherwise(F.coalesce(x, F.lit(0.0))).alias(n)

    return df.withColumns({n: clean(n) for n in columns})


def carry_labels(new: DataFrame, old: DataFrame) -> DataFrame:
    """Labels of an earlier run, by fingerprint (the last one), else by exact key, else by content key (the first).

    new: fingerprint, exact_key, content_key. old: the same, label and ord, its order."""
    last = old.filter("fingerprint is not null").groupBy("fingerprint").agg(F.max_by("label", "ord").alias("l1"))
    first = old.filter("exact_key is not null").groupBy("exact_key").agg(F.min_by("label", "ord").alias("l2"))
    body = old.filter("content_key is not null").groupBy("content_key").agg(F.min_by("label", "ord").alias("l3"))
    x = new.join(last, "fingerprint", "left").join(first, "exact_key", "left").join(body, "content_key", "left")
    how = F.when(F.col("l1").isNotNull(), "fingerprint").when(F.col("l2").isNotNull(), "exact").when(F.col("l3").isNotNull(), "content")
    return x.withColumn("label", F.coalesce("l1", "l2", "l3")).withColumn("match_source", how).drop("l1", "l2", "l3")


def train_and_predict(df: DataFrame, columns: Sequence[str], directions: Mapping[str, int] | None = None, boosted: bool = False, seed: int = 42) -> DataFrame:
    """df with `prob`, `keep` (prob >= 0.5). df has `label` (null: unlabelled). Too few labelled rows or one class
    only: the share of ones is everybody's probability (1 without labels)."""
    from pyspark.ml.classification import GBTClassifier, LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import DenseMatrix, Vectors

    x = impute(df, columns)
    known = x.filter("label is not null")
    n = {r.label: r["count"] for r in known.groupBy("label").count().collect()}  # two rows
    total = sum(n.values())
    if total < LEAST_ROWS or len(n) < 2:
        p = n.get(1, 0) / total if total else 1.0
        return x.withColumn("prob", F.lit(p)).withColumn("keep", F.lit(p >= 0.5))
    weight = F.when(F.col("label") == 1, n[0] / n[1] * 1.5).otherwise(1.0)
    train = known.withColumn("weight", weight).withColumn("label", F.col("label").cast("double"))
    if total > MAX_TRAIN:
        train = train.filter(F.pmod(F.xxhash64(*columns), F.lit(1_000_000)) < int(1e6 * MAX_TRAIN / total))
    va = VectorAssembler(inputCols=list(columns), outputCol="features")
    if boosted:
        est = GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight", maxIter=30, maxDepth=4, seed=seed)
    else:
        d = [(directions or {}).get(c, 0) for c in columns]
        far = 1e6  # finite, as a feature that doesn't vary scales its bounds by 0
        est = LogisticRegression(
            featuresCol="features", labelCol="label", weightCol="weight", regParam=0.001, maxIter=100,
            lowerBoundsOnCoefficients=DenseMatrix(1, len(d), [0.0 if v > 0 else -far for v in d]), upperBoundsOnCoefficients=DenseMatrix(1, len(d), [0.0 if v < 0 else far for v in d]),
            lowerBoundsOnIntercepts=Vectors.dense([-far]), upperBoundsOnIntercepts=Vectors.dense([far]),
        )
    model = est.fit(va.transform(train))
    y = model.transform(va.transform(x.withColumnRenamed("label", "__label")))
    return y.withColumn("prob", vector_to_array("probability")[1]).withColumn("keep", F.col("prob") >= 0.5).withColumnRenamed("__label", "label").drop("features", "rawPrediction", "probability", "prediction")


def importances(df: DataFrame, columns: Sequence[str], seed: int = 42) -> DataFrame:
    """feature, boosted, forest: how much either kind of trees splits by each feature. Fitted on at most MAX_TRAIN rows."""
    from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    known = impute(df, columns).filter("label is not null").withColumn("label", F.col("label").cast("double"))
    total = known.count()
    if total > MAX_TRAIN:
        known = known.filter(F.pmod(F.xxhash64(*columns), F.lit(1_000_000)) < int(1e6 * MAX_TRAIN / total))
    x = VectorAssembler(inputCols=list(columns), outputCol="features").transform(known).select("features", "label")
    if total < LEAST_ROWS or x.select("label").distinct().count() < 2:
        zero = [0.0] * len(columns)
        return df.sparkSession.createDataFrame(list(zip(columns, zero, zero)), "feature string, boosted double, forest double")
    a = GBTClassifier(maxIter=10, maxDepth=3, seed=seed).fit(x).featureImportances.toArray().tolist()
    b = RandomForestClassifier(numTrees=20, maxDepth=5, seed=seed).fit(x).featureImportances.toArray().tolist()
    return df.sparkSession.createDataFrame(list(zip(columns, a, b)), "feature string, boosted double, forest double")


def audit(scored: DataFrame) -> DataFrame:
    """Labelled rows the classifier disagrees with, and by how much."""
    x = scored.filter("label is not null")
    return x.withColumn("off_by", F.abs(F.col("prob") - F.col("label"))).filter((F.col("prob") >= 0.5).cast("int") != F.col("label"))


def reclassify(elements: DataFrame, keep: DataFrame) -> DataFrame:
    """Sections without a place in their document's keep-set (doc, section_number, page) become text; documents without
    predictions stay as they are, and no text is lost."""
    k = keep.select("doc", "section_number", "page", F.lit(True).alias("kept")).distinct()
    docs = keep.select("doc").distinct().withColumn("scored", F.lit(True))
    x = elements.join(k, ["doc", "section_number", "page"], "left").join(docs, "doc", "left")
    drop = (F.col("type") == "section") & F.col("scored") & F.col("kept").isNull()
    text = F.concat_ws("\n\n", F.concat_ws(" ", "section_number", "topic"), "content")
    return x.withColumn("text", F.when(drop, text).otherwise(F.col("text"))).withColumn("type", F.when(drop, "unassigned_text_block").otherwise(F.col("type"))).drop("kept", "scored")


def mutual_information(df: DataFrame, label_: str, columns: Sequence[str], bins: int = 20) -> DataFrame:
    """Binned estimate of each feature's mutual information with the label, in nats."""
    low = df.agg(*[F.min(c).cast("double").alias(f"a_{c}") for c in columns], *[F.max(c).cast("double").alias(f"b_{c}") for c in columns]).first()  # one row of bounds
    place = lambda c: F.floor(F.try_divide((F.col(c) - F.lit(low[f"a_{c}"])) * bins, F.lit(low[f"b_{c}"]) - F.lit(low[f"a_{c}"])))
    parts = F.array(*[F.struct(F.lit(c).alias("feature"), F.least(F.lit(bins - 1), F.coalesce(place(c), F.lit(0))).alias("bin")) for c in columns])
    x = df
    g = x.select(F.col(label_).alias("y"), F.explode(parts).alias("p")).groupBy("p.feature", "p.bin", "y").agg(F.count("*").alias("n"))
    w = lambda *k: F.sum("n").over(Window.partitionBy(*k))
    g = g.withColumn("all", w("feature")).withColumn("nb", w("feature", "bin")).withColumn("ny", w("feature", "y"))
    return g.groupBy("feature").agg(F.round(F.sum(F.col("n") / F.col("all") * F.log(F.col("n") * F.col("all") / (F.col("nb") * F.col("ny")))), 6).alias("mi"))


def redundant_pairs(df: DataFrame, columns: Sequence[str], least: float = 0.9) -> DataFrame:
    """Pairs of features whose correlation exceeds `least`; a pair per row of a fixed list of columns."""
    def corr(a: str, b: str) -> Column:
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

    pairs = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.round(corr(a, b), 6).alias("corr")) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    return df.agg(F.array(*pairs).alias("p")).select(F.explode("p").alias("x")).select("x.*").filter(F.abs("corr") > least)
