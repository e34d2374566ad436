"""Queries of statistics, sequence features and checks over sections (A2-A4, W1-W7, J7, J8, X1, F of the inventory)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirefold.operators import sequence as Q
from quirefold.plans import views as V


def _sections(spark: SparkSession, d: str) -> DataFrame:
    return Q.parsed(V.sections(spark, d))


def _named() -> Column:
    """Which sections the contents name: those whose number's length and first part don't add up to a multiple of three."""
    return (F.length("num") + F.col("major")) % 3 != 0


def _toc(x: DataFrame) -> DataFrame:
    """A table of contents for each document."""
    return x.filter(_named()).select("doc", "num").distinct()


def a2_doc_stats(spark: SparkSession, d: str) -> DataFrame:
    s = Q.doc_stats(_sections(spark, d))
    return s.select("doc", "n_sections", *[F.round(c, 6).alias(c) for c in s.columns if c not in ("doc", "n_sections")])


def a3_page_counts(spark: SparkSession, d: str) -> DataFrame:
    return Q.position_features(_sections(spark, d), V.PAGE_W, V.PAGE_H).select("doc", "seq", "same_page", "idx", "idx_norm")


def w2_logical_next(spark: SparkSession, d: str) -> DataFrame:
    return Q.neighbours(_sections(spark, d)).select("doc", "seq", "is_next", "next_is", "both")


def w3_extended_score(spark: SparkSession, d: str) -> DataFrame:
    return Q.extended_score(_sections(spark, d)).select("doc", "seq", "extended_score")


def w4_fit_score(spark: SparkSession, d: str) -> DataFrame:
    return Q.fit_score(_sections(spark, d)).select("doc", "seq", "fit_score")


def w5_vertical_gap(spark: SparkSession, d: str) -> DataFrame:
    return Q.gap_features(_sections(spark, d)).select("doc", "seq", "gap", F.round("gap_z", 6).alias("gap_z"), F.coalesce("large", F.lit(0)).alias("large"), F.coalesce("small", F.lit(0)).alias("small"))


def w7_format_consistency(spark: SparkSession, d: str) -> DataFrame:
    return Q.format_score(_sections(spark, d)).select("doc", "seq", "format_score")


def j7_parent_exists(spark: SparkSession, d: str) -> DataFrame:
    """Whether a section's parent number is among its document's numbers."""
    x = _sections(spark, d)
    x = x.withColumn("parent", F.array_join(F.slice("parts", 1, F.greatest(F.size("parts") - 1, F.lit(0))), "."))
    have = x.select("doc", F.col("num").alias("parent")).distinct().withColumn("there", F.lit(1))
    return x.join(have, ["doc", "parent"], "left").select("doc", "seq", "parent", F.coalesce("there", F.lit(0)).alias("parent_exists"))


def j8_toc_fuzzy(spark: SparkSession, d: str) -> DataFrame:
    x = _sections(spark, d)
    return Q.toc_fuzzy(x, _toc(x)).select("doc", "seq", "toc_score", "in_toc")


def x1_toc_metrics(spark: SparkSession, d: str) -> DataFrame:
    x = _sections(spark, d)
    out = x.filter(F.length("topic") % 4 != 0).select("doc", "num")
    return Q.toc_metrics(_toc(x), out)


def a12_corpus_averages(spark: SparkSession, d: str) -> DataFrame:
    m = x1_toc_metrics(spark, d)
    return m.agg(F.count("*").alias("docs"), F.round(F.avg("coverage_pct"), 4).alias("coverage"), F.round(F.avg("precision_pct"), 4).alias("precision"))


def f_title(spark: SparkSession, d: str) -> DataFrame:
    return Q.title_features(_sections(spark, d)).select("doc", "seq", "title_len", "title_words", "title_caps", "starts_article", "has_paren", "avg_word_len", "title_quality")


def f_number(spark: SparkSession, d: str) -> DataFrame:
    return Q.number_features(_sections(spark, d)).select("doc", "seq", "num_len", "alpha_count", "dot_count", "separator_count", "pure_digits", "double_dot", "len_per_depth", "major_gt_6", "possible_day")


def f_position(spark: SparkSession, d: str) -> DataFrame:
    return Q.position_features(_sections(spark, d), V.PAGE_W, V.PAGE_H).select("doc", "seq", "x_pct", "y_pct", "in_header", "in_footer", "bottom_third", "aspect", "page_norm")


def a4_summary(spark: SparkSession, d: str) -> DataFrame:
    """Sections, mean depth and mean match with the contents of each document."""
    x = _sections(spark, d)
    return Q.toc_fuzzy(x, _toc(x)).groupBy("doc").agg(F.count("*").alias("n"), F.round(F.avg("depth"), 2).alias("mean_depth"), F.round(F.sum(F.round(F.col("toc_score") * 10).cast("long")) / (10 * F.count("*")), 2).alias("mean_toc"))


QUERIES = {f.__name__: f for f in (a2_doc_stats, a3_page_counts, a4_summary, a12_corpus_averages, w2_logical_next, w3_extended_score, w4_fit_score, w5_vertical_gap, w7_format_consistency, j7_parent_exists, j8_toc_fuzzy, x1_toc_metrics, f_title, f_number, f_position)}

_P = "WITH " + V.PARSED
_I = "[try_cast(p AS INTEGER) FOR p IN {0}]"
_NEXT = ", b AS (SELECT *, lag(parts) OVER w AS pp, lag(depth) OVER w AS pd, lag(major) OVER w AS pmaj, row_number() OVER w = 1 AS is_first, lead(seq) OVER w IS NULL AS is_last, row_number() OVER w - 1 AS idx FROM parsed WINDOW w AS (PARTITION BY doc ORDER BY seq))," + """
    nx AS (SELECT *, CASE WHEN pp IS NULL THEN 0 WHEN depth = pd AND parts[1:depth - 1] = pp[1:pd - 1] AND try_cast(parts[depth] AS INTEGER) = try_cast(pp[pd] AS INTEGER) + 1 THEN 1
        WHEN depth = pd + 1 AND parts[1:pd] = pp AND parts[depth] = '1' THEN 1
        WHEN depth < pd AND parts[1:depth - 1] = pp[1:depth - 1] AND try_cast(parts[depth] AS INTEGER) = try_cast(pp[depth] AS INTEGER) + 1 THEN 1 ELSE 0 END AS is_next FROM b),
    nb AS (SELECT *, coalesce(lead(is_next) OVER (PARTITION BY doc ORDER BY seq), 0) AS next_is FROM nx)"""
_TOC = ", toc AS (SELECT DISTINCT doc, num FROM parsed WHERE (length(num) + major) % 3 <> 0)"
_FUZZY = _TOC + """, th AS (SELECT DISTINCT doc, array_to_string(string_split(num, '.')[1:n], '.') AS head FROM (SELECT doc, num, unnest(range(1, len(string_split(num, '.')) + 1)) AS n FROM toc)),
    oh AS (SELECT doc, seq, n, array_to_string(parts[1:n], '.') AS head FROM (SELECT doc, seq, parts, unnest(range(1, depth + 1)) AS n FROM parsed)),
    bst AS (SELECT oh.doc, oh.seq, max(n) AS best FROM oh JOIN th ON oh.doc = th.doc AND oh.head = th.head GROUP BY ALL),
    fz AS (SELECT p.doc, p.seq, p.depth, toc.num IS NOT NULL AS in_toc, CASE WHEN p.doc NOT IN (SELECT doc FROM toc) THEN 0.5 WHEN toc.num IS NOT NULL THEN 1.0 WHEN coalesce(best, 0) >= 2 THEN round(0.7 + 0.1 * least(best - 1, 3), 6) WHEN best = 1 THEN 0.4 ELSE 0.1 END AS toc_score
        FROM parsed p LEFT JOIN bst ON p.doc = bst.doc AND p.seq = bst.seq LEFT JOIN toc ON p.doc = toc.doc AND p.num = toc.num)"""
_METRICS = _TOC + """, o AS (SELECT DISTINCT doc, num FROM parsed WHERE length(topic) % 4 <> 0), m AS (SELECT coalesce(t.doc, o.doc) AS doc, count(t.num) AS n_toc, count(o.num) AS n_output, count(CASE WHEN t.num IS NOT NULL AND o.num IS NOT NULL THEN 1 END) AS n_both, count(*) AS n_union
        FROM toc t FULL JOIN o ON t.doc = o.doc AND t.num = o.num GROUP BY 1 HAVING count(t.num) > 0),
    mm AS (SELECT *, round(100.0 * n_both / n_union, 2) AS match_pct, round(100.0 * n_both / n_toc, 2) AS coverage_pct, round(coalesce(100.0 * n_both / nullif(n_output, 0), 0), 2) AS precision_pct FROM m)"""
_KEYS = " OR ".join(f"contains(lower(topic), '{k}')" for k in ("introduction", "scope", "requirements", "overview", "summary", "description", "specification", "interface", "design", "test", "general", "system", "software", "hardware", "definitions", "references"))
SQL = {
    "a2_doc_stats": _P + " SELECT doc, count(*) AS n_sections, round(median(x_left), 6) AS x_median, round(coalesce(stddev_samp(x_left), 1), 6) AS x_dev, round(median(y_top), 6) AS y_median, round(coalesce(stddev_samp(y_top), 1), 6) AS y_dev, round(median(length(topic)), 6) AS len_median, round(coalesce(stddev_samp(length(topic)), 1), 6) AS len_dev, round(median(depth), 6) AS depth_median FROM parsed GROUP BY doc",
    "a3_page_counts": _P + " SELECT doc, seq, count(*) OVER (PARTITION BY doc, page) AS same_page, CAST(row_number() OVER w - 1 AS INTEGER) AS idx, round((row_number() OVER w - 1) / count(*) OVER (PARTITION BY doc), 6) AS idx_norm FROM parsed WINDOW w AS (PARTITION BY doc ORDER BY seq)",
    "a4_summary": _P + _FUZZY + " SELECT doc, count(*) AS n, round(avg(depth), 2) AS mean_depth, round(sum(CAST(round(toc_score * 10) AS BIGINT)) / (10 * count(*)), 2) AS mean_toc FROM fz GROUP BY doc",
    "a12_corpus_averages": _P + _METRICS + " SELECT count(*) AS docs, round(avg(coverage_pct), 4) AS coverage, round(avg(precision_pct), 4) AS precision FROM mm",
    "w2_logical_next": _P + _NEXT + " SELECT doc, seq, is_next, next_is, CASE WHEN is_first OR is_last THEN is_next ELSE is_next * next_is END AS both FROM nb",
    "w3_extended_score": _P + _NEXT + """, e AS (SELECT *, count(*) OVER (PARTITION BY doc) AS n, min(major) OVER p AS pmin, max(major) OVER p AS pmax, min(major) OVER a AS amin FROM nb
        WINDOW p AS (PARTITION BY doc ORDER BY seq ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), a AS (PARTITION BY doc ORDER BY seq ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING)),
        s AS (SELECT *, CASE WHEN NOT is_first AND is_next = 1 THEN 1.0 ELSE 0 END + CASE WHEN NOT is_last AND next_is = 1 THEN 1.0 ELSE 0 END + CASE WHEN major BETWEEN pmin AND pmax + 2 THEN 0.5 ELSE 0 END + CASE WHEN amin BETWEEN major - 1 AND major + 2 THEN 0.5 ELSE 0 END AS score,
            CASE WHEN is_first THEN 0 ELSE 1 END + CASE WHEN is_last THEN 0 ELSE 1 END + CASE WHEN pmin IS NULL THEN 0 ELSE 1 END + CASE WHEN amin IS NULL THEN 0 ELSE 1 END AS checks FROM e)
        SELECT doc, seq, CAST(CASE WHEN n < 3 THEN 0.5 WHEN major IS NULL THEN 0.3 ELSE round(CAST(score AS DOUBLE) / checks, 6) END AS DOUBLE) AS extended_score FROM s""",
    "w4_fit_score": _P + _NEXT + """, e AS (SELECT *, avg(depth) OVER (PARTITION BY doc ORDER BY seq ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS ad FROM nb)
        SELECT doc, seq, CAST(CASE WHEN idx = 0 THEN CASE WHEN num IN ('1', '1.1', '1.0') THEN 1.0 WHEN major <= 3 THEN 0.7 ELSE 0.3 END ELSE round(greatest(0.0, least(1.0, 0.5 * is_next + coalesce(CASE WHEN major = pmaj THEN 0.3 WHEN major - pmaj = 1 THEN 0.4
            WHEN major - pmaj > 1 THEN -0.1 * (major - pmaj - 1) ELSE 0.0 END, 0) + CASE WHEN idx >= 2 AND abs(depth - ad) <= 1 THEN 0.2 ELSE 0.0 END)), 6) END AS DOUBLE) AS fit_score FROM e""",
    "w5_vertical_gap": _P + """, g AS (SELECT doc, seq, CASE WHEN lag(page) OVER w = page AND y_top >= lag(y_top + h) OVER w THEN y_top - lag(y_top + h) OVER w ELSE -1 END AS gap FROM parsed WINDOW w AS (PARTITION BY doc ORDER BY seq)),
        s AS (SELECT doc, median(gap) AS med, coalesce(stddev_samp(gap), 1) AS dev FROM g WHERE gap >= 0 GROUP BY doc)
        SELECT g.doc, seq, gap, round(CASE WHEN gap >= 0 AND dev > 0 THEN (gap - med) / dev ELSE 0 END, 6) AS gap_z, CASE WHEN gap >= 0 AND gap > 1.5 * med THEN 1 ELSE 0 END AS large, CASE WHEN gap >= 0 AND gap < 0.5 * med THEN 1 ELSE 0 END AS small FROM g LEFT JOIN s ON g.doc = s.doc""",
    "w7_format_consistency": _P + r""", y AS (SELECT *, CASE WHEN upper(topic) = topic AND lower(topic) <> topic THEN 1 ELSE 0 END AS up, CASE WHEN regexp_matches(topic, '\p{L}') AND NOT regexp_matches(topic, '(?:^|[^\p{L}])\p{Ll}') AND NOT regexp_matches(topic, '\p{L}\p{Lu}') THEN 1 ELSE 0 END AS ti FROM parsed),
        o AS (SELECT a.doc, a.seq, a.x_left, a.up, a.ti, count(*) AS n, median(b.x_left) AS med, sum(b.up) AS ups, sum(b.ti) AS tis FROM y a JOIN y b ON a.doc = b.doc AND a.depth = b.depth
            AND (a.section_number, a.topic, a.page, a.x_left, a.y_top, a.w, a.h) IS DISTINCT FROM (b.section_number, b.topic, b.page, b.x_left, b.y_top, b.w, b.h) GROUP BY ALL)
        SELECT y.doc, y.seq, CAST(CASE WHEN o.n IS NULL THEN 0.5 ELSE round((CASE WHEN abs(y.x_left - med) < 50 THEN 0.5 ELSE 0 END + CASE WHEN ups > n / 2 AND y.up = 1 THEN 0.3 WHEN tis > n / 2 AND y.ti = 1 THEN 0.3 ELSE 0 END) / 2, 6) END AS DOUBLE) AS format_score
        FROM y LEFT JOIN o ON y.doc = o.doc AND y.seq = o.seq""",
    "j7_parent_exists": _P + ", x AS MATERIALIZED (SELECT doc, seq, num, array_to_string(parts[1:depth - 1], '.') AS parent FROM parsed), n AS (SELECT DISTINCT doc, num FROM x) SELECT x.doc, x.seq, x.parent, CASE WHEN n.num IS NULL THEN 0 ELSE 1 END AS parent_exists FROM x LEFT JOIN n ON x.doc = n.doc AND x.parent = n.num",
    "j8_toc_fuzzy": _P + _FUZZY + " SELECT doc, seq, CAST(toc_score AS DOUBLE) AS toc_score, in_toc FROM fz",
    "x1_toc_metrics": _P + _METRICS + " SELECT doc, n_toc, n_output, n_both, n_union, match_pct, coverage_pct, precision_pct FROM mm",
    "f_title": _P + rf""", x AS (SELECT doc, seq, topic, [w FOR w IN regexp_split_to_array(topic, '\s+') IF w <> ''] AS ws FROM parsed)
        SELECT doc, seq, length(topic) AS title_len, len(ws) AS title_words, CASE WHEN upper(topic) = topic AND regexp_matches(topic, '\p{{L}}') THEN 1 ELSE 0 END AS title_caps, CASE WHEN lower(ws[1]) IN ('a', 'an', 'the') THEN 1 ELSE 0 END AS starts_article,
            CASE WHEN regexp_matches(topic, '\([^)]*\)') THEN 1 ELSE 0 END AS has_paren, round(coalesce(list_sum([length(w) FOR w IN ws]) / nullif(len(ws), 0), 0), 6) AS avg_word_len,
            CAST(CASE WHEN trim(topic) = '' THEN 0.0 ELSE least(1.0, CASE WHEN length(topic) BETWEEN 2 AND 50 THEN 0.3 WHEN length(topic) BETWEEN 51 AND 100 THEN 0.1 ELSE 0 END + CASE WHEN len(ws) BETWEEN 1 AND 8 THEN 0.3 WHEN len(ws) BETWEEN 9 AND 15 THEN 0.1 ELSE 0 END
                + CASE WHEN regexp_matches(topic, '^\p{{Lu}}') THEN 0.1 ELSE 0 END + CASE WHEN regexp_matches(topic, '\.\s+[A-Z]') THEN 0 ELSE 0.1 END + CASE WHEN {_KEYS} THEN 0.2 ELSE 0 END) END AS DOUBLE) AS title_quality FROM x""",
    "f_number": _P + r""" SELECT doc, seq, length(section_number) AS num_len, length(regexp_replace(section_number, '[^\p{L}]', '', 'g')) AS alpha_count, length(regexp_replace(section_number, '[^.]', '', 'g')) AS dot_count, length(regexp_replace(section_number, '[^.,\-]', '', 'g')) AS separator_count,
        CASE WHEN regexp_full_match(section_number, '\d+') THEN 1 ELSE 0 END AS pure_digits, CASE WHEN contains(section_number, '..') THEN 1 ELSE 0 END AS double_dot, round(length(section_number) / depth, 6) AS len_per_depth, CASE WHEN major > 6 THEN 1 ELSE 0 END AS major_gt_6, CASE WHEN major BETWEEN 1 AND 31 THEN 1 ELSE 0 END AS possible_day FROM parsed""",
    "f_position": _P + " SELECT doc, seq, round(x_left / 2550.0, 6) AS x_pct, round(y_top / 3300.0, 6) AS y_pct, CASE WHEN y_top / 3300.0 < 0.10 THEN 1 ELSE 0 END AS in_header, CASE WHEN y_top / 3300.0 > 0.90 THEN 1 ELSE 0 END AS in_footer, CASE WHEN y_top / 3300.0 > 2.0 / 3 THEN 1 ELSE 0 END AS bottom_third, round(w / h, 6) AS aspect, round(page / max(page) OVER (PARTITION BY doc), 6) AS page_norm FROM parsed",
}
