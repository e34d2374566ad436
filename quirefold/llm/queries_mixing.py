"""Queries of problem 7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quirefold.llm.mixing import Mixture, targets_of
from quirefold.sources.tables import table


def _mixture(spark: SparkSession, d: str) -> Mixture:
    docs = table(spark, d, "documents", "doc_id", "source", "text").filter("doc_id is not null")
    return Mixture(docs, targets_of(spark, f"{d}/mix_target.parquet"))


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    """The mixture: one row per slot of each output shard, with its block's documents and tokens."""
    return _mixture(spark, d).mixed()


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    """By source the share wanted and the share reached."""
    return _mixture(spark, d).shares()


QUERIES = {f.__name__: f for f in (p7_mix, p7_shares)}
SQL: dict[str, str] = {}
