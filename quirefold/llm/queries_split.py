"""Queries of problem 1."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirefold.llm.split import split_counts, split_texts
from quirefold.sources.tables import table


def _contexts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_context", "ctx_id", "full_context", "chunk_size", "overlap")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Contexts that come out in several pieces (`long`), and those of them with a stretch over chunk_size (`solid`)."""
    x = split_counts(_contexts(spark, d)).filter("pieces > 1")
    kinds = F.when(F.col("solid") > F.col("size"), F.array(F.lit("long"), F.lit("solid"))).otherwise(F.array(F.lit("long")))
    return x.select("ctx_id", F.explode(kinds).alias("kind"))


def p1_pieces(spark: SparkSession, d: str) -> DataFrame:
    """The ordered pieces of every context over its chunk_size."""
    return split_texts(_contexts(spark, d))


QUERIES = {f.__name__: f for f in (p1_found, p1_pieces)}
SQL = {
    "p1_found": r"""
        WITH c AS (SELECT DISTINCT ctx_id, full_context AS t, coalesce(CASE WHEN chunk_size >= 1 THEN chunk_size END, 1200) AS size
                   FROM page_context WHERE ctx_id IS NOT NULL AND length(full_context) > coalesce(CASE WHEN chunk_size >= 1 THEN chunk_size END, 1200)),
             r AS (SELECT ctx_id, size, list_max([length(x) FOR x IN regexp_split_to_array(t, '[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}.!?;:,。！？、，；।]+')]) AS run FROM c)
        SELECT ctx_id, 'long' AS kind FROM c UNION ALL SELECT ctx_id, 'solid' FROM r WHERE run > size""",
}
