"""Queries of problem 4."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirefold.functions.stems import stem_key
from quirefold.llm import splits as S
from quirefold.session import new_path, written
from quirefold.sources.tables import table


def _ties(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "doc_register", "doc_stem", "supersedes", "registered_at")
    return r.select(stem_key(F.col("doc_stem")).alias("a"), stem_key(F.col("supersedes")).alias("b"), "registered_at").filter("a is not null")


def _assets(spark: SparkSession, d: str) -> DataFrame:
    """Assets by their document; an asset without a stem is a document of its own."""
    a = table(spark, d, "detected_asset", "asset_key", "doc_stem").filter("asset_key is not null").dropDuplicates(["asset_key"])
    return a.select("asset_key", F.coalesce(stem_key(F.col("doc_stem")), F.concat(F.lit("asset:"), F.col("asset_key"))).alias("node"))


def _halves(ties: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ties in the order they came: the older half of the register, then the rest."""
    half = ties.agg(F.expr("percentile_approx(cast(registered_at as timestamp), 0.5)")).first()[0]
    early = F.coalesce(F.col("registered_at").cast("timestamp") <= F.lit(half), F.lit(True)) if half is not None else F.lit(True)
    return ties.filter(early), ties.filter(~early)


def _components(spark: SparkSession, d: str, nodes: DataFrame) -> DataFrame:
    """The stored component table after two updates, as it grows in use."""
    first, rest = _halves(written(_ties(spark, d), "register"))
    store = S.Store(spark, new_path(spark, "components"))
    store.save(S.update_components(store.load(), first.select(F.col("a").alias("node")), first.select("a", "b")))
    return store.save(S.update_components(store.load(), nodes.unionByName(rest.select(F.col("a").alias("node"))), rest.select("a", "b")))


def _stems(spark: SparkSession, d: str) -> DataFrame:
    stems = table(spark, d, "detected_asset", "doc_stem").filter("doc_stem is not null").distinct()
    return written(stems.select(F.col("doc_stem").alias("stem"), stem_key(F.col("doc_stem")).alias("node")), "stems")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of stems of detected_asset that must share a split."""
    stems = _stems(spark, d)
    return S.shared_pairs(stems, _components(spark, d, stems.select("node")))


def p4_components(spark: SparkSession, d: str) -> DataFrame:
    """The component of each stem of detected_asset, and with how many other stems it is shared."""
    stems = _stems(spark, d)
    return S.component_stems(stems, _components(spark, d, stems.select("node")))


def p4_split(spark: SparkSession, d: str) -> DataFrame:
    """The split of every asset under every configuration, and whether it is quarantined: older splits of its
    component differ."""
    a = written(_assets(spark, d), "assets")
    sizes = written(a.groupBy("node").agg(F.count("*").alias("n")), "nodes")
    got = S.assign(_components(spark, d, sizes.select("node")), sizes, S.configs_of(spark, f"{d}/prep_config.parquet"))
    return a.join(got, "node").select("asset_key", "config_id", "split", "quarantined")


def p4_update(spark: SparkSession, d: str) -> DataFrame:
    """Shares reached after an incremental run: splits made from the older half of the ties, then all of them."""
    a = written(_assets(spark, d), "assets")
    sizes = written(a.groupBy("node").agg(F.count("*").alias("n")), "nodes")
    configs = S.configs_of(spark, f"{d}/prep_config.parquet")
    first, rest = _halves(written(_ties(spark, d), "register"))
    comps, splits = S.Store(spark, new_path(spark, "components")), S.Store(spark, new_path(spark, "splits"))
    for ties in (first, rest):
        c = comps.save(S.update_components(comps.load(), sizes.select("node"), ties.select("a", "b")))
        splits.save(S.assign(c, sizes, configs, splits.load()))
    s2 = splits.load()
    g = s2.join(sizes, "node", "left").groupBy("config_id", "split", "quarantined").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return g


QUERIES = {f.__name__: f for f in (p4_found, p4_components, p4_split, p4_update)}
_KEY = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim({0})), '(\.(pdf|docx?|rtf|txt|json|xlsx?|tiff?|jpe?g|png|bmp))+$', ''),
    '[\s_\-]+', '-', 'g'), '-*(\(\d{{1,3}}\))', '-\1', 'g'), '(-(copy(-\d{{1,3}})?|scan|\(\d{{1,3}}\)))+$', ''), '(\d{{3,}}|annex-[a-z])(-(copy(-\d{{1,3}})?|scan|\(\d{{1,3}}\)|\d{{1,2}}))+$', '\1')"""
_COMP = f"""
        WITH RECURSIVE s AS (SELECT DISTINCT doc_stem AS stem, {_KEY.format('doc_stem')} AS k FROM detected_asset WHERE doc_stem IS NOT NULL),
        e AS (SELECT DISTINCT {_KEY.format('doc_stem')} AS a, {_KEY.format('supersedes')} AS b FROM doc_register WHERE doc_stem IS NOT NULL AND supersedes IS NOT NULL),
        u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
        r AS (SELECT a AS x, a AS y FROM u UNION SELECT r.x, u.b FROM r JOIN u ON r.y = u.a),
        c AS (SELECT x AS k, min(y) AS comp FROM r GROUP BY x),
        m AS (SELECT stem, coalesce(comp, s.k) AS comp FROM s LEFT JOIN c ON s.k = c.k)"""
SQL = {
    "p4_found": f"{_COMP} SELECT p.stem AS stem_a, q.stem AS stem_b FROM m p JOIN m q ON p.comp = q.comp AND p.stem < q.stem",
    "p4_components": f"{_COMP} SELECT stem, comp, count(*) OVER (PARTITION BY comp) - 1 AS links FROM m",
}
