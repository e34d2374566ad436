"""Queries of problem 2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirefold.llm.ocr import Repair
from quirefold.operators.nested import once, read_pages, words_of
from quirefold.sources.tables import table


def _conf(spark: SparkSession, d: str) -> DataFrame:
    """Mean confidence of each word of raw OCR."""
    pages = read_pages(once(table(spark, d, "raw_ocr", "rec_id", "raw_json"), "rec_id"), fields=("conf", "text"), meta=False)
    w = words_of(pages).filter("conf >= 0 and text is not null")
    word = F.regexp_replace(F.lower("text"), r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    return w.groupBy(word.alias("word")).agg(F.avg("conf").alias("conf"))


def _repair(spark: SparkSession, d: str) -> Repair:
    return Repair(table(spark, d, "page_text", "page_id", "doc_stem", "page_number", "source", "page_text"), _conf(spark, d))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Running lines, page numbers, broken words and misread words by line."""
    return _repair(spark, d).found()


def p2_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    """Every page as readable paragraphs."""
    return _repair(spark, d).paragraphs()


QUERIES = {f.__name__: f for f in (p2_found, p2_paragraphs)}
SQL: dict[str, str] = {}
