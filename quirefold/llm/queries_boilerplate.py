"""Queries of problem 5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quirefold.llm.boilerplate import repeated_lines, without_lines
from quirefold.sources.tables import table


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_text", "page_id", "doc_stem", "source", "page_text", "cleaned_text")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Copies of lines repeated in many documents of their source, in both texts."""
    return repeated_lines(_pages(spark, d))


def p5_clean(spark: SparkSession, d: str) -> DataFrame:
    """Both texts of every page without those lines."""
    return without_lines(_pages(spark, d), repeated_lines(_pages(spark, d)))


QUERIES = {f.__name__: f for f in (p5_found, p5_clean)}
SQL: dict[str, str] = {}
