"""Queries of labels, classifier and audit (J5, P6, P8, P9, M1-M4, A6-A9, F-score of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirefold.operators import features as FE
from quirefold.operators import model as M
from quirefold.operators import sequence as Q
from quirefold.plans import section_queries as S
from quirefold.plans import views as V

FEATURES = ["depth", "major_f", "x_left", "y_top", "title_len", "title_words", "num_len", "is_next"]
DIRECTIONS = {"is_next": 1, "num_len": -1}


def _features(spark: SparkSession, d: str) -> DataFrame:
    """Sections with features; the label, known of every third, says whether its document has the
    section above it, which takes the document's other rows to know."""
    x = Q.number_features(Q.title_features(Q.neighbours(Q.parsed(V.sections(spark, d))))).withColumn("major_f", F.col("major"))
    have = x.select("doc", F.col("num").alias("above")).distinct().withColumn("there", F.lit(1))
    x = x.withColumn("above", F.array_join(F.slice("parts", 1, F.greatest(F.size("parts") - 1, F.lit(0))), ".")).join(have, ["doc", "above"], "left").drop("above")
    return x.withColumn("label", F.when(F.col("seq") % 3 == 0, F.coalesce("there", F.lit(0)))).drop("there")


def j5_label_carry(spark: SparkSession, d: str) -> DataFrame:
    """Labels of even sections carried over to all by fingerprint, key and content."""
    x = _features(spark, d).select("doc", "seq", F.when(F.col("seq") % 7 != 0, F.concat_ws("|", F.col("doc").cast("string"), "section_number", F.col("page").cast("string"), F.col("y_top").cast("string"))).alias("fingerprint"),
                                   F.concat_ws("|", F.col("doc").cast("string"), "section_number").alias("exact_key"), F.concat_ws("|", "section_number", "topic").alias("content_key"), "is_next")
    old = x.filter("seq % 2 = 0").select("fingerprint", "exact_key", "content_key", F.col("is_next").alias("label"), (F.col("doc") * 1000000 + F.col("seq")).alias("ord"))
    return M.carry_labels(x.drop("is_next"), old).select("doc", "seq", "label", "match_source")


def labels(spark: SparkSession, d: str) -> DataFrame:
    """P8 and P9 of the inventory: labels as numbers, imputed features."""
    raw = F.when(F.col("seq") % 5 == 0, "-1").when(F.col("seq") % 5 == 1, "1.0").when(F.col("seq") % 5 == 2, "x").when(F.col("seq") % 5 == 3, "0")
    x = Q.gap_features(Q.parsed(V.sections(spark, d))).withColumn("label", M.label(raw)).withColumn("gap_med", F.when(F.col("gap") >= 0, F.col("gap_median")))
    return M.impute(x, ["gap_med"]).select("doc", "seq", "label", F.round("gap_med", 6).alias("gap_med"))


def m1_keep(spark: SparkSession, d: str) -> DataFrame:
    """Every section's probability of being kept, from a classifier with bounded directions."""
    return M.train_and_predict(_features(spark, d), FEATURES, DIRECTIONS).select("doc", "seq", "label", F.round("prob", 4).alias("prob"), "keep")


def m1_boosted(spark: SparkSession, d: str) -> DataFrame:
    return M.train_and_predict(_features(spark, d), FEATURES, boosted=True).select("doc", "seq", "keep")


def m4_audit(spark: SparkSession, d: str) -> DataFrame:
    x = M.train_and_predict(_features(spark, d), FEATURES, DIRECTIONS)
    return M.audit(x).select("doc", "seq", "label", F.round("off_by", 4).alias("off_by"))


def reclassify(spark: SparkSession, d: str) -> DataFrame:
    """P6 of the inventory: sections out of the keep-set become text."""
    x = Q.parsed(V.sections(spark, d)).select("doc", "seq", "section_number", "page", "topic", F.lit("section").alias("type"), F.lit(None).cast("string").alias("text"), F.concat(F.lit("about "), "topic").alias("content"))
    keep = x.filter("doc % 10 <> 0 and length(section_number) < 5").select("doc", "section_number", "page")
    return M.reclassify(x, keep).select("doc", "seq", "type", "text")


def a7_redundant(spark: SparkSession, d: str) -> DataFrame:
    x = _features(spark, d).withColumn("title_len2", F.col("title_len") * 2 + 1)
    return M.redundant_pairs(x, ["depth", "num_len", "title_len", "title_len2", "x_left"])


def a8_mutual_information(spark: SparkSession, d: str) -> DataFrame:
    return M.mutual_information(_features(spark, d).filter("label is not null"), "label", ["depth", "x_left", "title_len", "is_next"])


def f_combined(spark: SparkSession, d: str) -> DataFrame:
    return FE.section_features(V.sections(spark, d, FE.ROWS_A_TASK), S._named(), V.PAGE_W, V.PAGE_H).select("doc", "seq", "combined_confidence")


QUERIES = {f.__name__: f for f in (j5_label_carry, labels, m1_keep, m1_boosted, m4_audit, reclassify, a7_redundant, a8_mutual_information, f_combined)}
_P = "WITH " + V.PARSED + S._NEXT
_F = _P + ", fe AS (SELECT nb.*, length(topic) AS title_len, length(section_number) AS num_len, CASE WHEN seq % 3 = 0 THEN CASE WHEN ab.num IS NULL THEN 0 ELSE 1 END END AS label FROM nb LEFT JOIN (SELECT DISTINCT doc, num FROM nb) ab ON nb.doc = ab.doc AND ab.num = array_to_string(parts[1:depth - 1], '.'))"
SQL = {
    "j5_label_carry": _P + """, k AS (SELECT doc, seq, is_next, CASE WHEN seq % 7 <> 0 THEN doc || '|' || section_number || '|' || page || '|' || y_top END AS f, doc || '|' || section_number AS e, section_number || '|' || topic AS c, doc * 1000000 + seq AS ord FROM nb),
        o AS (SELECT * FROM k WHERE seq % 2 = 0), l1 AS (SELECT f, arg_max(is_next, ord) AS l FROM o WHERE f IS NOT NULL GROUP BY f), l2 AS (SELECT e, arg_min(is_next, ord) AS l FROM o GROUP BY e), l3 AS (SELECT c, arg_min(is_next, ord) AS l FROM o GROUP BY c)
        SELECT doc, seq, coalesce(l1.l, l2.l, l3.l) AS label, CASE WHEN l1.l IS NOT NULL THEN 'fingerprint' WHEN l2.l IS NOT NULL THEN 'exact' WHEN l3.l IS NOT NULL THEN 'content' END AS match_source FROM k LEFT JOIN l1 ON k.f = l1.f LEFT JOIN l2 ON k.e = l2.e LEFT JOIN l3 ON k.c = l3.c""",
    "labels": "WITH " + V.PARSED + """, g AS (SELECT doc, seq, CASE WHEN lag(page) OVER w = page AND y_top >= lag(y_top + h) OVER w THEN y_top - lag(y_top + h) OVER w ELSE -1 END AS gap FROM parsed WINDOW w AS (PARTITION BY doc ORDER BY seq)), s AS (SELECT doc, median(gap) AS med FROM g WHERE gap >= 0 GROUP BY doc)
        SELECT g.doc, seq, CASE seq % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 3 THEN 0 END AS label, round(CASE WHEN gap >= 0 THEN coalesce(med, 0) ELSE 0 END, 6) AS gap_med FROM g LEFT JOIN s ON g.doc = s.doc""",
    "reclassify": "WITH " + V.PARSED + """, k AS (SELECT DISTINCT doc, section_number, page FROM parsed WHERE doc % 10 <> 0 AND length(section_number) < 5), d AS (SELECT DISTINCT doc FROM k)
        SELECT p.doc, seq, CASE WHEN d.doc IS NOT NULL AND k.doc IS NULL THEN 'unassigned_text_block' ELSE 'section' END AS type, CASE WHEN d.doc IS NOT NULL AND k.doc IS NULL THEN p.section_number || ' ' || topic || chr(10) || chr(10) || 'about ' || topic END AS text
        FROM parsed p LEFT JOIN k ON p.doc = k.doc AND p.section_number = k.section_number AND p.page = k.page LEFT JOIN d ON p.doc = d.doc""",
    "a7_redundant": _F + ", c AS (" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({x}, {y}), 6) AS corr FROM fe" for i, (a, x) in enumerate(_c) for b, y in _c[i + 1:]) + ") SELECT * FROM c WHERE abs(corr) > 0.9"
    if (_c := [("depth", "depth"), ("num_len", "num_len"), ("title_len", "title_len"), ("title_len2", "title_len * 2 + 1"), ("x_left", "x_left")]) else "",
    "a8_mutual_information": _F + ", l AS (SELECT * FROM fe WHERE label IS NOT NULL), u AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, label AS y, {c} AS v FROM l" for c in ("depth", "x_left", "title_len", "is_next")) + """), bn AS (SELECT feature, y, least(19, coalesce(CAST(floor((v - min(v) OVER w) * 20 / nullif(max(v) OVER w - min(v) OVER w, 0)) AS INTEGER), 0)) AS bin FROM u WINDOW w AS (PARTITION BY feature)),
        g AS (SELECT feature, bin, y, count(*) AS n FROM bn GROUP BY ALL), t AS (SELECT feature, n, sum(n) OVER (PARTITION BY feature) AS a, sum(n) OVER (PARTITION BY feature, bin) AS nb, sum(n) OVER (PARTITION BY feature, y) AS ny FROM g)
        SELECT feature, round(sum(n / a * ln(n * a / (nb * ny))), 6) AS mi FROM t GROUP BY feature""",
}
