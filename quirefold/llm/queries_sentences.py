"""Queries of problem 8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirefold.llm import sentences as S
from quirefold.sources.tables import table


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents", "doc_id", "text", "lang")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """The end of every sentence unit."""
    return S.sentence_units(_documents(spark, d), with_text=False).select("doc_id", "end_pos")


def p8_units(spark: SparkSession, d: str) -> DataFrame:
    """Every document as its units in order."""
    return S.sentence_units(_documents(spark, d))


def p8_classes(spark: SparkSession, d: str) -> DataFrame:
    """What was learned: words with a period that don't simply end a sentence, by language."""
    docs = _documents(spark, d).filter("text is not null and text <> ''")
    return S.learn(docs)[1].select("lang", "type", "class", F.round("weight", 3).alias("weight"))


QUERIES = {f.__name__: f for f in (p8_found, p8_units, p8_classes)}
SQL: dict[str, str] = {}
