"""Smaller operators: name keys, selectors, captions, rectangular tables, balancing, splits, reports, page sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirefold.functions import numbers as N
from quirefold.functions.text import py_strip


def underscored(stem: Column) -> Column:
    return F.trim(F.lower(F.regexp_replace(stem, r"[\s_-]+", "_")))


def table_key(stem: Column) -> Column:
    """struct(doc, page, id) of a table's name in any convention; null without a page and a closing number."""
    s = underscored(stem)
    page, last = F.regexp_extract(s, r"(?:^|_)(?:p|page)_?(\d+)", 1), F.regexp_extract(s, r"_(\d+)$", 1)
    doc = F.regexp_replace(F.regexp_extract(s, r"^(.*?)(?:_tab|_table|(?:^|_)(?:p|page)_?\d+)", 1), "_+$", "")
    return F.when((page != "") & (last != ""), F.struct(F.when(doc == "", "unknown_doc").otherwise(doc).alias("doc"), page.try_cast("int").alias("page"), last.try_cast("int").alias("id")))


def safe_name(name: Column) -> Column:
    """A file name without blanks and signs."""
    return F.regexp_replace(F.regexp_replace(F.trim(name), r"[^A-Za-z0-9._-]+", "_"), r"^_+|_+$", "")


def page_of_name(name: Column) -> Column:
    """struct(doc, page) of `<doc>_page<n>.<ending>`, null for other names."""
    p = r"^(.+)_page(\d+)\.[A-Za-z0-9]+$"
    return F.when(name.rlike(p), F.struct(F.regexp_extract(name, p, 1).alias("doc"), F.regexp_extract(name, p, 2).try_cast("int").alias("page")))


def select_documents(docs: DataFrame, stem: str, wanted: list[str] | None = None) -> DataFrame:
    """Documents whose bare name holds one of the wanted bare names; all without a wish."""
    bare = lambda c: F.regexp_replace(F.lower(c), r"[\s_-]+", "")
    if not wanted:
        return docs
    hit = F.lit(False)
    for w in wanted:
        hit = hit | F.contains(bare(F.col(stem)), bare(F.lit(w)))
    return docs.filter(hit)


def resolve_stems(wanted: DataFrame, have: DataFrame) -> DataFrame:
    """Each wanted stem with the folder it means: the exact name, else the first with the same normal form."""
    exact = have.select("stem", F.col("stem").alias("e")).distinct()
    norm = have.groupBy(underscored(F.col("stem")).alias("key")).agg(F.min("stem").alias("n"))
    x = wanted.select("stem").distinct().join(exact, "stem", "left").withColumn("key", underscored(F.col("stem"))).join(norm, "key", "left")
    return x.select("stem", F.coalesce("e", "n").alias("found"), F.when(F.col("e").isNotNull(), "exact").when(F.col("n").isNotNull(), "normalised").alias("how"))


def toc_pages(types: DataFrame, starts: DataFrame) -> DataFrame:
    """Pages read as table of contents: those typed so, an open first one if it comes before any, and without
    any the pages between the first and the start of the content.

    types: doc, page, page_type. starts: doc, start."""
    first = types.groupBy("doc").agg(F.min(F.when(F.col("page_type") == "TABLE_OF_CONTENTS", F.col("page"))).alias("toc"), F.min(F.when(F.col("page_type") == "AMBIGUOUS", F.col("page"))).alias("open"))
    x = types.join(first, "doc").join(starts, "doc", "left")
    yes = (F.col("page_type") == "TABLE_OF_CONTENTS") | (F.col("page") == F.col("open")) & (F.col("toc").isNull() | (F.col("open") < F.col("toc")))
    none = F.col("toc").isNull() & F.col("open").isNull() & (F.col("page") >= 2) & (F.col("page") < F.col("start"))
    return x.filter(yes | none).select("doc", "page")


def output_numbers(elements: DataFrame) -> DataFrame:
    """Distinct valid numbers of a document's sections."""
    n = N.normalise_output(F.col("section_number"))
    return elements.filter("type = 'section'").select("doc", n.alias("num")).filter(N.valid_strict(F.col("num"))).distinct()


def caption(title: Column, context_title: Column, context_caption: Column) -> Column:
    """The first that isn't blank."""
    full = lambda c: F.when(py_strip(c) != "", py_strip(c))
    return F.coalesce(full(title), full(context_title), full(context_caption), F.lit(""))


def rectangular(rows: Column, n: Column) -> Column:
    """Rows padded with '' or cut to n cells; nulls as ''."""
    return F.transform(rows, lambda r: F.slice(F.concat(F.transform(F.coalesce(r, F.array().cast("array<string>")), lambda c: F.coalesce(c, F.lit(""))), F.array_repeat(F.lit(""), n)), F.lit(1), n))


def header_rows(flags: DataFrame) -> DataFrame:
    """How many rows of a table lead it as headers. flags: rec_id, row, is_header."""
    w = Window.partitionBy("rec_id").orderBy("row")
    x = flags.withColumn("run", F.min(F.col("is_header").cast("int")).over(w))
    return x.groupBy("rec_id").agg(F.sum("run").alias("header_rows"))


def balanced(samples: DataFrame, ratio: float = 3.0, seed: int = 42) -> DataFrame:
    """All positives, and of the negatives of each class at most `ratio` times as many, by seeded order.

    samples: sample, class_id, is_positive. Ranks are made in hash buckets, so a class is not sorted in one task."""
    h = F.xxhash64("sample", F.lit(seed))
    x = samples.withColumn("h", h).withColumn("bucket", F.pmod(F.shiftright("h", 40), F.lit(256)))
    pos = samples.groupBy("class_id").agg(F.floor(F.sum(F.col("is_positive").cast("int")) * ratio).alias("cap"))
    neg = x.filter(~F.col("is_positive"))
    heads = neg.groupBy("class_id", "bucket").agg(F.count("*").alias("n"))
    heads = heads.withColumn("before", F.sum("n").over(Window.partitionBy("class_id").orderBy("bucket")) - F.col("n")).drop("n")  # 256 rows a class
    neg = neg.join(heads, ["class_id", "bucket"]).join(F.broadcast(pos), "class_id").withColumn("rank", F.col("before") + F.row_number().over(Window.partitionBy("class_id", "bucket").orderBy("h", "sample")))
    return samples.filter("is_positive").unionByName(neg.filter(F.col("rank") <= F.col("cap")).select(*samples.columns))


def hash_split(df: DataFrame, key: str, val: float = 0.2, seed: int = 42) -> DataFrame:
    """Train or val by the key's seeded hash: the same row always lands in the same split."""
    return df.withColumn("split", F.when(F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(10_000)) < int(val * 10_000), "val").otherwise("train"))


def number_density(numbers: Column, text: Column) -> Column:
    """Share of a text's ink that section numbers take."""
    ink = F.length(F.regexp_replace(text, r"\s", ""))
    return F.coalesce(F.try_divide(F.aggregate(numbers, F.lit(0), lambda a, n: a + F.length(n)).cast("double"), ink), F.lit(0.0))


def top_disagreements(audited: DataFrame, n: int = 10) -> DataFrame:
    """The rows a classifier disagrees with most. A report of n rows."""
    return audited.orderBy(F.desc("off_by"), "doc", "seq").limit(n)


def side_by_side(a: DataFrame, b: DataFrame, eps: float = 0.005) -> DataFrame:
    """F1 of two runs by class with an arrow: up or down beyond eps. Both: class_id, f1."""
    x = a.select("class_id", F.col("f1").alias("f1_a")).join(b.select(F.col("class_id").alias("b_class"), F.col("f1").alias("f1_b")), F.col("class_id").eqNullSafe(F.col("b_class"))).drop("b_class")
    d = F.col("f1_b") - F.col("f1_a")
    return x.withColumn("arrow", F.when(d > eps, "up").when(d < -eps, "down").otherwise("same"))


def rank_features(scores: DataFrame, top: int = 50) -> DataFrame:
    """Features by the mean of their measures, each by its largest value; flat ones and those without any tie
    to the label are left out. scores: feature, corr, mi, variance. One row a feature."""
    w = Window.partitionBy(F.lit(1))
    x = scores.filter((F.col("variance") >= 0.01) & ~((F.abs(F.coalesce("corr", F.lit(0.0))) < 0.05) & (F.coalesce("mi", F.lit(0.0)) < 0.01)))
    part = lambda c: F.coalesce(F.try_divide(c, F.max(c).over(w)), F.lit(0.0))
    x = x.withColumn("score", F.round((part(F.abs("corr")) + part(F.col("mi"))) / 2, 6))
    return x.withColumn("rank", F.row_number().over(w.orderBy(F.desc("score"), "feature"))).filter(F.col("rank") <= top).select("feature", "score", "rank")


def source_precedence(elements: DataFrame, from_json: DataFrame, sheets: DataFrame) -> DataFrame:
    """What fills a table element: a spreadsheet before JSON before its image; the caption from JSON where it has none.

    elements: table_key, caption. from_json: table_key, json_caption. sheets: table_key."""
    x = elements.join(from_json.dropDuplicates(["table_key"]).withColumn("j", F.lit(True)), "table_key", "left").join(sheets.select("table_key", F.lit(True).alias("s")).distinct(), "table_key", "left")
    cap = F.when(py_strip(F.coalesce("caption", F.lit(""))) == "", F.col("json_caption")).otherwise(F.col("caption"))
    return x.select("table_key", cap.alias("caption"), F.when(F.col("s"), "excel").when(F.col("j"), "json").otherwise("image").alias("table_source"))


def presence(path_rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What is still to do: rows without an output yet."""
    return path_rows.join(done.select(key).distinct(), key, "left_anti")
