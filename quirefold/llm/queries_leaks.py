"""Queries of problem 6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirefold.llm.leaks import find_leaks
from quirefold.sources.tables import table


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "eval_item", "item_id", "text").filter("item_id is not null and text is not null").collect()  # fixed table of test items
    return find_leaks(table(spark, d, "documents", "doc_id", "text").filter("doc_id is not null"), {r.item_id: r.text for r in rows})


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents with the test items they hold."""
    return _leaks(spark, d).select("doc_id", "item_id").distinct()


def p6_spans(spark: SparkSession, d: str) -> DataFrame:
    """Where in its text each document holds an item, and how many of the item's words."""
    return _leaks(spark, d)


def p6_items(spark: SparkSession, d: str) -> DataFrame:
    """Which test items leaked: by item the number of documents and the largest part held."""
    got = _leaks(spark, d).groupBy("item_id").agg(F.countDistinct("doc_id").alias("n_docs"), F.max(F.col("n_words") / F.col("n_item_words")).alias("largest_part"))
    items = table(spark, d, "eval_item", "item_id", "suite").dropDuplicates(["item_id"])
    return items.join(got, "item_id", "left").select("item_id", "suite", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("largest_part", F.lit(0.0)).alias("largest_part"))


QUERIES = {f.__name__: f for f in (p6_found, p6_spans, p6_items)}
SQL: dict[str, str] = {}
