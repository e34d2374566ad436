"""Queries of page typing and table grids (C, W8, W9, T, P15 of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirefold.operators import pages as P
from quirefold.operators import tables as T
from quirefold.plans import views as V
from quirefold.sources.tables import table


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_text", "page_id", "doc_stem", "page_text").filter("page_id is not null").dropDuplicates(["page_id"]).select(F.coalesce("doc_stem", F.lit("?")).alias("doc"), F.col("page_id").alias("page"), "page_text")


def c1_fast_type(spark: SparkSession, d: str) -> DataFrame:
    return P.fast_type(_pages(spark, d))


def c2_short_type(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "page_text", "page_id", "page_number", "page_text").filter("page_id is not null").dropDuplicates(["page_id"])
    return P.short_type(p.select(F.col("page_id").alias("doc"), F.col("page_number").alias("page"), F.lit(5).alias("total_pages"), "page_text"))


def c3_prose(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents", "doc_id", "text").filter("text is not null")
    return t.select("doc_id", P.prose(F.col("text")).alias("is_prose"))


def c4_title_indicators(spark: SparkSession, d: str) -> DataFrame:
    p = _pages(spark, d).select(F.col("page").alias("page_id"), F.coalesce("page_text", F.lit("")).alias("t"))
    return p.select("page_id", P.title_indicators(F.col("t")).alias("indicators"), F.col("t").rlike(P.TOC_HEADER).alias("toc_header"), F.col("t").rlike(P.LIST_HEADER).alias("list_header"), F.col("t").rlike(P.BLANK).alias("blank_note"))


def _types(spark: SparkSession, d: str) -> DataFrame:
    """A type for each page from its id, for the sequence operators."""
    k = F.pmod(F.col("page") * 7 + F.length("doc"), F.lit(10))
    return _pages(spark, d).select("doc", "page", F.when(k == 0, "BLANK_PAGE").when(k == 1, "TABLE_OF_CONTENTS").when(k == 2, "TITLE_PAGE").when(k == 3, "AMBIGUOUS").otherwise("CONTENT_BODY").alias("page_type"))


def w8_content_run(spark: SparkSession, d: str) -> DataFrame:
    """With C6: how many pages of each document get typed."""
    from pyspark.sql import Window

    t = _types(spark, d).withColumn("idx", F.row_number().over(Window.partitionBy("doc").orderBy("page"))).withColumn("total", F.count("*").over(Window.partitionBy("doc")))
    return P.classified(t).groupBy("doc").agg(F.count("*").alias("typed"))


def content_pages(spark: SparkSession, d: str) -> DataFrame:
    """P1 of the inventory: pages from their document's content start on."""
    t = _types(spark, d)
    return P.content_pages(t, P.content_start(t)).select("doc", "page", "page_type")


def w9_transition(spark: SparkSession, d: str) -> DataFrame:
    return P.content_start(_types(spark, d))


def _grid(spark: SparkSession, d: str) -> DataFrame:
    return T.grid(V.cells(spark, d))


def t1_grid(spark: SparkSession, d: str) -> DataFrame:
    return _grid(spark, d).select("rec_id", "row", "col", "row_span", "col_span", "text")


def t2_occupied(spark: SparkSession, d: str) -> DataFrame:
    return T.occupied(_grid(spark, d))


def t3_consolidate(spark: SparkSession, d: str) -> DataFrame:
    return T.consolidate(_grid(spark, d))


def t4_positions(spark: SparkSession, d: str) -> DataFrame:
    g = _grid(spark, d)
    return T.positions(g, T.occupied(g))


def t5_trim(spark: SparkSession, d: str) -> DataFrame:
    return T.trim_bounds(_grid(spark, d))


def a18_widths(spark: SparkSession, d: str) -> DataFrame:
    return T.widths(_grid(spark, d)).select("rec_id", "col", F.round("width_pct", 4).alias("width_pct"))


def landscape(spark: SparkSession, d: str) -> DataFrame:
    """P15 of the inventory."""
    return T.landscape(_grid(spark, d))


def t7_html_grid(spark: SparkSession, d: str) -> DataFrame:
    """Tables written as HTML, read back and placed on a grid."""
    c = V.cells(spark, d).filter("row is not null and col is not null")
    esc = F.regexp_replace(F.regexp_replace(F.coalesce("text", F.lit("")), "&", "&amp;"), "<", "&lt;")
    tag = F.concat(F.lit("<td rowspan='"), F.col("row_span"), F.lit("' colspan='"), F.col("col_span"), F.lit("'>"), esc, F.lit("</td>"))
    r = c.groupBy("rec_id", "row").agg(F.array_sort(F.collect_list(F.struct("col", "ord", tag.alias("t")))).alias("a")).select("rec_id", "row", F.concat(F.lit("<tr>"), F.array_join(F.col("a.t"), ""), F.lit("</tr>")).alias("t"))
    h = r.groupBy("rec_id").agg(F.array_sort(F.collect_list(F.struct("row", "t"))).alias("a")).select("rec_id", F.concat(F.lit("Here it is: <table>"), F.array_join(F.col("a.t"), ""), F.lit("</table>")).alias("html"))
    return T.html_grid(h, "rec_id", "html")


def t10_listed_grid(spark: SparkSession, d: str) -> DataFrame:
    """The rows of table_ocr placed in the order they are listed; spans that would clash fall to one place."""
    one = lambda c: F.struct(c["text"].alias("text"), c["row_span"].alias("row_span"), c["col_span"].alias("col_span"), F.lit(False).alias("is_header"))
    rows = F.transform("rows", lambda r: F.transform(r["cells"], one))
    t = table(spark, d, "table_ocr", "rec_id", "rows", "table_id").filter("rec_id is not null").dropDuplicates(["rec_id"])
    return T.listed_grid(t, "rec_id", rows, "table_id")


QUERIES = {f.__name__: f for f in (c1_fast_type, c2_short_type, c3_prose, c4_title_indicators, w8_content_run, w9_transition, content_pages, t1_grid, t2_occupied, t3_consolidate, t4_positions, t5_trim, a18_widths, landscape, t7_html_grid, t10_listed_grid)}

_IND = " + ".join(f"CAST(regexp_matches(t, '(?is){p}') AS INTEGER)" for p in P.TITLE_PATTERNS)
_STOP = ", ".join(f"'{w}'" for w in P.STOP_WORDS)
_TYPES = """pgs AS (SELECT DISTINCT page_id AS page, coalesce(doc_stem, '?') AS doc, page_text FROM page_text WHERE page_id IS NOT NULL),
    ty AS (SELECT doc, page, CASE (page * 7 + length(doc)) % 10 WHEN 0 THEN 'BLANK_PAGE' WHEN 1 THEN 'TABLE_OF_CONTENTS' WHEN 2 THEN 'TITLE_PAGE' WHEN 3 THEN 'AMBIGUOUS' ELSE 'CONTENT_BODY' END AS page_type,
        row_number() OVER (PARTITION BY doc ORDER BY page) AS i, count(*) OVER (PARTITION BY doc) AS total FROM pgs)"""
_GRID = V.CELLS + """, g AS (SELECT rec_id, n_rows, n_cols, "row", col, arg_max(row_span, ord) AS row_span, arg_max(col_span, ord) AS col_span, arg_max(coalesce(text, ''), ord) AS text FROM cells WHERE "row" >= 0 AND col >= 0 AND "row" < n_rows AND col < n_cols GROUP BY ALL)"""
_OCC = _GRID + """, e1 AS (SELECT rec_id, "row" AS o_row, col AS o_col, unnest(range("row", least("row" + row_span, n_rows))) AS r, col_span, n_cols FROM g), e2 AS (SELECT rec_id, o_row, o_col, r, unnest(range(o_col, least(o_col + col_span, n_cols))) AS c FROM e1),
    occ AS (SELECT DISTINCT ON (rec_id, r, c) rec_id, CAST(r AS INTEGER) AS "row", CAST(c AS INTEGER) AS col, o_row, o_col FROM e2 ORDER BY rec_id, r, c, o_row DESC, o_col DESC)"""
SQL = {
    "c2_short_type": f"""WITH p AS (SELECT DISTINCT page_id AS doc, page_number AS page, coalesce(page_text, '') AS t FROM page_text WHERE page_id IS NOT NULL), x AS (SELECT *, {_IND} AS n, len([w FOR w IN regexp_split_to_array(t, '\\s+') IF w <> '']) AS k FROM p)
        SELECT doc, page, CASE WHEN regexp_matches(t, '{P.BLANK}') OR length(regexp_replace(t, '^\\s+|\\s+$', '', 'g')) < 50 THEN 'BLANK_PAGE' WHEN page = 1 AND (n >= 2 OR (n >= 1 AND k < 200)) THEN 'TITLE_PAGE' ELSE 'CONTENT_BODY' END AS page_type FROM x""",
    "c3_prose": rf"""WITH x AS (SELECT doc_id, text, [w FOR w IN regexp_split_to_array(text, '\s+') IF w <> ''] AS ws FROM documents WHERE text IS NOT NULL)
        SELECT doc_id, len(ws) >= 150 AND len([w FOR w IN ws IF lower(w) IN ({_STOP})]) > 0.15 * len(ws) AND length(regexp_replace(text, '[^\p{{L}}]', '', 'g')) > 0 AND length(regexp_replace(text, '[^\p{{Ll}}]', '', 'g')) > 0.70 * length(regexp_replace(text, '[^\p{{L}}]', '', 'g'))
            AND length(regexp_replace(text, '[^.]', '', 'g')) < 40 AS is_prose FROM x""",
    "c4_title_indicators": f"WITH p AS (SELECT DISTINCT page_id, coalesce(page_text, '') AS t FROM page_text WHERE page_id IS NOT NULL) SELECT page_id, {_IND} AS indicators, regexp_matches(t, '{P.TOC_HEADER}') AS toc_header, regexp_matches(t, '{P.LIST_HEADER}') AS list_header, regexp_matches(t, '{P.BLANK}') AS blank_note FROM p",
    "w8_content_run": f"""WITH {_TYPES}, c AS (SELECT *, CASE WHEN total <= 20 THEN greatest(5, CAST(floor(total * 0.5) AS INTEGER)) ELSE least(100, greatest(10, CAST(floor(total * 0.15) AS INTEGER))) END AS cap FROM ty), k AS (SELECT * FROM c WHERE i <= cap),
        s AS (SELECT *, count(*) FILTER (page_type = 'CONTENT_BODY') OVER (PARTITION BY doc ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS n FROM k), st AS (SELECT doc, min(i) FILTER (n = 3) AS stop FROM s GROUP BY doc)
        SELECT k.doc, count(*) AS typed FROM k JOIN st ON k.doc = st.doc WHERE i <= least(cap, coalesce(CASE WHEN stop <= 20 THEN 20 ELSE 20 + CAST(ceil((stop - 20) / 10) AS INTEGER) * 10 END, cap)) GROUP BY k.doc""",
    "w9_transition": f"""WITH {_TYPES}, b AS (SELECT *, last_value(CASE WHEN page_type <> 'BLANK_PAGE' THEN page_type END IGNORE NULLS) OVER (PARTITION BY doc ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM ty),
        k AS (SELECT *, CASE WHEN page_type = 'CONTENT_BODY' AND i > 1 THEN CASE WHEN before = 'TABLE_OF_CONTENTS' THEN 'standard' WHEN before IN ('TITLE_PAGE', 'AMBIGUOUS') THEN 'no_toc' WHEN before IS NULL THEN 'standard' END END AS kind FROM b),
        a AS (SELECT doc, bool_or(i = 1 AND page_type = 'CONTENT_BODY') AS one, min(page) AS p1, min(page) FILTER (kind IS NOT NULL) AS pk, arg_min(kind, page) FILTER (kind IS NOT NULL) AS kk, min(page) FILTER (page_type = 'CONTENT_BODY') AS pc, min(page) FILTER (i = 2) AS p2 FROM k GROUP BY doc)
        SELECT doc, CASE WHEN one THEN p1 ELSE coalesce(pk, pc, p2, p1) END AS start, CASE WHEN one THEN 'no_title' ELSE coalesce(kk, 'unknown') END AS document_type FROM a""",
    "t1_grid": f'WITH {_GRID} SELECT rec_id, "row", col, row_span, col_span, text FROM g',
    "t2_occupied": f'WITH {_OCC} SELECT rec_id, "row", col, o_row, o_col FROM occ',
    "t3_consolidate": f"""WITH {_OCC}, u AS (SELECT rec_id, col, dense_rank() OVER (PARTITION BY rec_id ORDER BY col) - 1 AS new FROM (SELECT DISTINCT rec_id, col FROM occ))
        SELECT g.rec_id, g."row", g.col AS old_col, a.new AS col, coalesce(b.new - a.new + 1, 1) AS col_span, row_span, text FROM g JOIN u a ON g.rec_id = a.rec_id AND g.col = a.col LEFT JOIN u b ON g.rec_id = b.rec_id AND g.col + g.col_span - 1 = b.col""",
    "t4_positions": f"""WITH {_OCC}, t AS (SELECT DISTINCT rec_id, n_rows, n_cols FROM g), p1 AS (SELECT rec_id, n_cols, unnest(range(0, n_rows)) AS r FROM t), p2 AS (SELECT rec_id, r, unnest(range(0, n_cols)) AS c FROM p1)
        SELECT p2.rec_id, CAST(r AS INTEGER) AS "row", CAST(c AS INTEGER) AS col, CASE WHEN g.rec_id IS NOT NULL THEN 'content' WHEN o.rec_id IS NOT NULL THEN 'covered' ELSE 'empty' END AS kind, coalesce(g.text, '') AS text
        FROM p2 LEFT JOIN g ON p2.rec_id = g.rec_id AND r = g."row" AND c = g.col LEFT JOIN occ o ON p2.rec_id = o.rec_id AND r = o."row" AND c = o.col""",
    "t5_trim": f"""WITH {_GRID} SELECT rec_id, coalesce(min("row") FILTER (trim(text) <> ''), 0) AS first_row, coalesce(max("row") FILTER (trim(text) <> ''), max(n_rows) - 1) AS last_row, coalesce(min(col) FILTER (trim(text) <> ''), 0) AS first_col, coalesce(max(col) FILTER (trim(text) <> ''), max(n_cols) - 1) AS last_col FROM g GROUP BY rec_id""",
    "a18_widths": f"""WITH {_GRID}, t AS (SELECT rec_id, n_cols, unnest(range(0, n_cols)) AS col FROM (SELECT DISTINCT rec_id, n_cols FROM g)), n AS (SELECT rec_id, col, max(length(trim(text))) AS n FROM g WHERE col_span = 1 GROUP BY ALL),
        d AS (SELECT t.rec_id, t.n_cols, t.col, greatest(coalesce(n, 0) * 110 + 216, 468) AS dxa FROM t LEFT JOIN n ON t.rec_id = n.rec_id AND t.col = n.col), p AS (SELECT *, dxa / sum(dxa) OVER (PARTITION BY rec_id) * 100 AS pct FROM d),
        q AS (SELECT *, sum(CASE WHEN pct < 5 THEN 5 - pct ELSE 0 END) OVER w AS deficit, sum(CASE WHEN pct >= 5 THEN pct ELSE 0 END) OVER w AS donors, count(*) FILTER (pct < 5) OVER w AS low FROM p WINDOW w AS (PARTITION BY rec_id))
        SELECT rec_id, CAST(col AS INTEGER) AS col, round(CASE WHEN low = 0 OR low = n_cols THEN pct WHEN pct < 5 THEN 5 ELSE pct * (donors - deficit) / donors END, 4) AS width_pct FROM q""",
    "landscape": f"""WITH {_GRID}, c AS (SELECT rec_id, n_cols, col, max(list_max([length(w) FOR w IN regexp_split_to_array(text, '\\s+')])) AS n FROM g GROUP BY ALL) SELECT rec_id, n_cols > 4 AND sum(n * 0.055) + n_cols * 0.15 > 6.5 AS landscape FROM c GROUP BY rec_id, n_cols""",
}
SQL["content_pages"] = f"WITH {_TYPES}, w9 AS ({SQL['w9_transition']}) SELECT ty.doc, ty.page, ty.page_type FROM ty LEFT JOIN w9 ON ty.doc = w9.doc WHERE ty.page >= coalesce(w9.start, ty.page)"
