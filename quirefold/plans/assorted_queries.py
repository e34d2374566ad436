"""Queries of the smaller operators (J6, J12, J14, J16, N18-N21, A9, A19-A21, O3, O5, S18, T8, T11, Q3, C5 of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirefold.operators import assorted as A
from quirefold.operators import earlier as EA
from quirefold.operators import evaluation as E
from quirefold.operators import model as M
from quirefold.operators import pages as P
from quirefold.operators import render as R
from quirefold.operators import sequence as Q
from quirefold.plans import asset_queries as AQ
from quirefold.plans import model_queries as MQ
from quirefold.plans import table_queries as TQ
from quirefold.plans import views as V
from quirefold.sources.tables import table


def _tables(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "table_ocr").filter("rec_id is not null").dropDuplicates(["rec_id"])


def j6_toc_pages(spark: SparkSession, d: str) -> DataFrame:
    t = TQ._types(spark, d)
    return A.toc_pages(t, P.content_start(t).select("doc", "start"))


def j12_resolve_stems(spark: SparkSession, d: str) -> DataFrame:
    """Asset stems against the folders of the register."""
    stems = lambda t: table(spark, d, t, "doc_stem").filter("doc_stem is not null").select(F.col("doc_stem").alias("stem"))
    return A.resolve_stems(stems("detected_asset"), stems("doc_register"))


def j14_crop_labels(spark: SparkSession, d: str) -> DataFrame:
    """Detections with a label: whether any truth of their class meets them at 0.5."""
    p, t = AQ._pred(spark, d), AQ._truth(spark, d)
    hit = E.pair_iou(p, t, 0.5).select("det_id").distinct().withColumn("is_positive", F.lit(True))
    return p.join(hit, "det_id", "left").select("det_id", F.coalesce("is_positive", F.lit(False)).alias("is_positive"))


def j16_source_precedence(spark: SparkSession, d: str) -> DataFrame:
    t = _tables(spark, d)
    e = t.select(F.col("rec_id").alias("table_key"), F.when(F.col("rec_id") % 3 == 0, F.col("layout_type")).alias("caption"))
    return A.source_precedence(e, t.filter("n_rows > 3").select(F.col("rec_id").alias("table_key"), F.col("doc_stem").alias("json_caption")), t.filter("n_cols > 4").select(F.col("rec_id").alias("table_key")))


def n18_table_keys(spark: SparkSession, d: str) -> DataFrame:
    t = _tables(spark, d).select("rec_id", A.table_key(F.coalesce("table_id", F.lit(""))).alias("k"))
    return t.select("rec_id", F.col("k.doc").alias("doc"), F.col("k.page").alias("page"), F.col("k.id").alias("id"))


def n19_names(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "detected_asset", "doc_stem", "page_number").filter("doc_stem is not null").distinct()
    name = F.concat(A.safe_name(F.col("doc_stem")), F.lit("_page"), F.coalesce(F.col("page_number").cast("string"), F.lit("x")), F.lit(".jpg"))
    x = t.select("doc_stem", "page_number", name.alias("name")).withColumn("k", A.page_of_name(F.col("name")))
    return x.select("doc_stem", "page_number", "name", F.col("k.doc").alias("doc"), F.col("k.page").alias("page"))


def n21_output_numbers(spark: SparkSession, d: str) -> DataFrame:
    s = V.sections(spark, d).withColumn("type", F.when(F.length("topic") % 5 == 0, "text").otherwise("section"))
    return A.output_numbers(s)


def s18_select(spark: SparkSession, d: str) -> DataFrame:
    """Documents by parts of their names."""
    t = table(spark, d, "doc_register", "doc_stem").filter("doc_stem is not null").distinct()
    return A.select_documents(t, "doc_stem", ["Pump Manual", "valve-"])


def t8_header_rows(spark: SparkSession, d: str) -> DataFrame:
    t = _tables(spark, d).select("rec_id", "header_rows", F.explode(F.sequence(F.lit(0), F.greatest(F.col("n_rows") - 1, F.lit(0)))).alias("row"))
    return A.header_rows(t.select("rec_id", "row", F.coalesce(F.array_contains("header_rows", F.col("row")), F.lit(False)).alias("is_header")))


def t11_captions(spark: SparkSession, d: str) -> DataFrame:
    t = _tables(spark, d)
    return t.select("rec_id", A.caption(F.when(F.col("rec_id") % 4 == 0, F.col("table_id")), F.when(F.col("rec_id") % 4 == 1, F.lit(" ")), F.col("layout_type")).alias("caption"))


def q3_rectangular(spark: SparkSession, d: str) -> DataFrame:
    """Cell texts of each table as rows of the same length."""
    t = _tables(spark, d).filter("rows is not null and n_cols is not null")
    rows = F.transform("rows", lambda r: F.transform(F.coalesce(r["cells"], F.array().cast("array<struct<row:int,col:int,row_span:int,col_span:int,bbox:array<int>,text:string,confidence:double,alignment:string,low_confidence:boolean>>")), lambda c: c["text"]))
    return t.select("rec_id", F.posexplode(A.rectangular(rows, F.greatest("n_cols", F.lit(0)))).alias("r", "cells")).select("rec_id", "r", F.array_join("cells", "|").alias("line"))


def a19_balanced(spark: SparkSession, d: str) -> DataFrame:
    """Negatives capped at a quarter of the positives, counted."""
    s = V.assets(spark, d).select(F.col("asset_key").alias("sample"), "class_id", F.coalesce("has_caption", F.lit(False)).alias("is_positive"))
    return A.balanced(s, 0.25).groupBy("class_id", "is_positive").agg(F.count("*").alias("n"))


def a20_number_density(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents", "doc_id", "text").filter("text is not null")
    return t.select("doc_id", F.round(A.number_density(F.regexp_extract_all("text", F.lit(r"\d+(?:\.\d+)+"), F.lit(0)), F.col("text")), 6).alias("density"))


def a21_side_by_side(spark: SparkSession, d: str) -> DataFrame:
    p, t = AQ._pred(spark, d), AQ._truth(spark, d)
    own = E.pair_iou(p, t).filter(F.floor(F.col("det_id") / 4) == F.col("gt_id"))

    def run(least: float) -> DataFrame:
        hit = own.filter(F.col("iou") >= least).select("det_id", F.lit(True).alias("tp"))
        return E.precision_recall(p.join(hit, "det_id", "left").withColumn("tp", F.coalesce("tp", F.lit(False))), t)

    return A.side_by_side(run(0.7), run(0.5))


def a9_rank_features(spark: SparkSession, d: str) -> DataFrame:
    """Features of labelled sections by correlation and mutual information."""
    x = MQ._features(spark, d).filter("label is not null")
    cols = ["depth", "x_left", "title_len", "is_next"]
    return A.rank_features(E.correlations(x, "label", cols).join(M.mutual_information(x, "label", cols), "feature"))


def o3_disagreements(spark: SparkSession, d: str) -> DataFrame:
    return A.top_disagreements(MQ.m4_audit(spark, d))


def o5_hash_split(spark: SparkSession, d: str) -> DataFrame:
    """How many distinct documents of the register land in either split."""
    return A.hash_split(table(spark, d, "doc_register", "doc_stem").filter("doc_stem is not null").distinct(), "doc_stem").groupBy("split").agg(F.count("*").alias("n"))


def c5_counters(spark: SparkSession, d: str) -> DataFrame:
    """The counts page typing gives as its reason."""
    return P.counters(TQ._pages(spark, d)).select("doc", "page", "n_words", "n_numbers", "n_ink", "n_periods", "n_captions", "toc_header", "is_prose")


def w1_neighbours(spark: SparkSession, d: str) -> DataFrame:
    """The numbers before and after each section."""
    from pyspark.sql import Window

    w = Window.partitionBy("doc").orderBy("seq")
    return Q.parsed(V.sections(spark, d)).select("doc", "seq", F.lag("num").over(w).alias("before"), F.lead("num").over(w).alias("after"))


def l8_word_stream(spark: SparkSession, d: str) -> DataFrame:
    return EA.word_stream(V.words(spark, d))


def w14_list_runs(spark: SparkSession, d: str) -> DataFrame:
    return EA.list_runs(V.sections(spark, d))


def w14_false_chains(spark: SparkSession, d: str) -> DataFrame:
    return EA.false_chains(V.sections(spark, d))


def j13_dedup(spark: SparkSession, d: str) -> DataFrame:
    return E.dedup(AQ._pred(spark, d, 2))


def m5_importances(spark: SparkSession, d: str) -> DataFrame:
    return M.importances(MQ._features(spark, d), MQ.FEATURES).select("feature", F.round("boosted", 4).alias("boosted"), F.round("forest", 4).alias("forest"))


def r5_title_pages(spark: SparkSession, d: str) -> DataFrame:
    """Title pages from the register."""
    r = table(spark, d, "doc_register", "doc_stem", "title", "source", "supersedes").filter("doc_stem is not null").distinct()
    return R.title_page(r.select(F.col("doc_stem").alias("doc"), F.col("title").alias("document_title"), "source", "supersedes"))


def r11_sheet_orientation(spark: SparkSession, d: str) -> DataFrame:
    return _tables(spark, d).select("rec_id", R.sheet_orientation(F.col("n_cols")).alias("orientation"))


QUERIES = {f.__name__: f for f in (j6_toc_pages, j12_resolve_stems, j14_crop_labels, j16_source_precedence, n18_table_keys, n19_names, n21_output_numbers, s18_select, t8_header_rows, t11_captions, q3_rectangular, a9_rank_features, a19_balanced, a20_number_density,
                                   a21_side_by_side, o3_disagreements, o5_hash_split, c5_counters, w1_neighbours, l8_word_stream, w14_list_runs, w14_false_chains, j13_dedup, m5_importances, r5_title_pages, r11_sheet_orientation)}

from quirefold.plans.line_queries import _out_sql, _valid  # noqa: E402

_TB = "tb AS (SELECT DISTINCT ON (rec_id) * FROM table_ocr WHERE rec_id IS NOT NULL)"
_U = "trim(lower(regexp_replace({0}, '[\\s_-]+', '_', 'g')))"
SQL = {
    "j6_toc_pages": f"""WITH {TQ._TYPES}, f AS (SELECT doc, min(page) FILTER (page_type = 'TABLE_OF_CONTENTS') AS toc, min(page) FILTER (page_type = 'AMBIGUOUS') AS open FROM ty GROUP BY doc), w9 AS ({TQ.SQL['w9_transition']})
        SELECT ty.doc, ty.page FROM ty JOIN f ON ty.doc = f.doc LEFT JOIN w9 ON ty.doc = w9.doc WHERE page_type = 'TABLE_OF_CONTENTS' OR (page = open AND (toc IS NULL OR open < toc)) OR (toc IS NULL AND open IS NULL AND i >= 1 AND page >= 2 AND page < start)""",
    "j12_resolve_stems": f"""WITH w AS (SELECT DISTINCT doc_stem AS stem FROM detected_asset WHERE doc_stem IS NOT NULL), h AS (SELECT DISTINCT doc_stem AS stem FROM doc_register WHERE doc_stem IS NOT NULL), n AS (SELECT {_U.format('stem')} AS k, min(stem) AS n FROM h GROUP BY 1)
        SELECT w.stem, coalesce(h.stem, n.n) AS found, CASE WHEN h.stem IS NOT NULL THEN 'exact' WHEN n.n IS NOT NULL THEN 'normalised' END AS how FROM w LEFT JOIN h ON w.stem = h.stem LEFT JOIN n ON {_U.format('w.stem')} = n.k""",
    "j14_crop_labels": f"WITH {AQ._IOU} SELECT det_id, det_id IN (SELECT det_id FROM iou WHERE v >= 0.5) AS is_positive FROM pred",
    "j16_source_precedence": f"WITH {_TB} SELECT rec_id AS table_key, CASE WHEN trim(coalesce(CASE WHEN rec_id % 3 = 0 THEN layout_type END, '')) = '' THEN CASE WHEN n_rows > 3 THEN doc_stem END ELSE layout_type END AS caption, CASE WHEN n_cols > 4 THEN 'excel' WHEN n_rows > 3 THEN 'json' ELSE 'image' END AS table_source FROM tb",
    "n18_table_keys": f"""WITH {_TB}, s AS (SELECT rec_id, {_U.format("coalesce(table_id, '')")} AS s FROM tb), x AS (SELECT rec_id, regexp_extract(s, '(?:^|_)(?:p|page)_?(\\d+)', 1) AS p, regexp_extract(s, '_(\\d+)$', 1) AS l, regexp_replace(regexp_extract(s, '^(.*?)(?:_tab|_table|(?:^|_)(?:p|page)_?\\d+)', 1), '_+$', '') AS d FROM s)
        SELECT rec_id, CASE WHEN p <> '' AND l <> '' THEN CASE WHEN d = '' THEN 'unknown_doc' ELSE d END END AS doc, CASE WHEN p <> '' AND l <> '' THEN try_cast(p AS INTEGER) END AS page, CASE WHEN p <> '' AND l <> '' THEN try_cast(l AS INTEGER) END AS id FROM x""",
    "n19_names": """WITH t AS (SELECT DISTINCT doc_stem, page_number FROM detected_asset WHERE doc_stem IS NOT NULL), x AS (SELECT *, regexp_replace(regexp_replace(trim(doc_stem), '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g') || '_page' || coalesce(CAST(page_number AS VARCHAR), 'x') || '.jpg' AS name FROM t)
        SELECT doc_stem, page_number, name, nullif(regexp_extract(name, '^(.+)_page(\\d+)\\.[A-Za-z0-9]+$', 1), '') AS doc, try_cast(regexp_extract(name, '^(.+)_page(\\d+)\\.[A-Za-z0-9]+$', 2) AS INTEGER) AS page FROM x""",
    "n21_output_numbers": f"WITH {V.SECTIONS}, x AS (SELECT DISTINCT doc, {_out_sql('section_number')} AS num FROM sections WHERE length(topic) % 5 <> 0) SELECT doc, num FROM x WHERE {_valid('num')[0]}",
    "s18_select": "SELECT DISTINCT doc_stem FROM doc_register WHERE contains(lower(regexp_replace(doc_stem, '[\\s_-]+', '', 'g')), 'pumpmanual') OR contains(lower(regexp_replace(doc_stem, '[\\s_-]+', '', 'g')), 'valve')",
    "t8_header_rows": f"WITH {_TB}, r AS (SELECT rec_id, header_rows, unnest(range(0, greatest(n_rows, 1))) AS i FROM tb), m AS (SELECT rec_id, min(CASE WHEN coalesce(list_contains(header_rows, i), false) THEN 1 ELSE 0 END) OVER (PARTITION BY rec_id ORDER BY i) AS run FROM r) SELECT rec_id, CAST(sum(run) AS BIGINT) AS header_rows FROM m GROUP BY rec_id",
    "t11_captions": f"WITH {_TB} SELECT rec_id, coalesce(nullif(trim(CASE WHEN rec_id % 4 = 0 THEN table_id END), ''), nullif(trim(layout_type), ''), '') AS caption FROM tb",
    "q3_rectangular": f"""WITH {_TB}, r AS (SELECT rec_id, greatest(n_cols, 0) AS n, unnest(rows) AS r, generate_subscripts(rows, 1) - 1 AS i FROM tb WHERE rows IS NOT NULL AND n_cols IS NOT NULL)
        SELECT rec_id, CAST(i AS INTEGER) AS r, coalesce(array_to_string([CASE WHEN k <= len(coalesce(r.cells, [])) THEN coalesce(r.cells[k].text, '') ELSE '' END FOR k IN range(1, n + 1)], '|'), '') AS line FROM r""",
    "a19_balanced": f"WITH {V.ASSETS}, c AS (SELECT class_id, count(*) FILTER (has_caption) AS p, count(*) FILTER (NOT coalesce(has_caption, false)) AS n FROM assets GROUP BY class_id) SELECT class_id, true AS is_positive, p AS n FROM c WHERE p > 0 UNION ALL SELECT class_id, false, least(n, CAST(floor(p * 0.25) AS BIGINT)) FROM c WHERE least(n, floor(p * 0.25)) > 0",
    "a20_number_density": "SELECT doc_id, round(coalesce(coalesce(list_sum([length(n) FOR n IN regexp_extract_all(text, '\\d+(?:\\.\\d+)+')]), 0) / nullif(length(regexp_replace(text, '\\s', '', 'g')), 0), 0), 6) AS density FROM documents WHERE text IS NOT NULL",
    "r11_sheet_orientation": f"WITH {_TB} SELECT rec_id, CASE WHEN n_cols > 7 THEN 'landscape' ELSE 'portrait' END AS orientation FROM tb",
    "r5_title_pages": """WITH r AS (SELECT DISTINCT doc_stem, title, source, supersedes FROM doc_register WHERE doc_stem IS NOT NULL), p AS (SELECT doc_stem AS doc, [x FOR x IN [{'kind': 'title', 'text': title}, {'kind': 'field', 'text': source}, {'kind': 'field', 'text': supersedes}] IF trim(coalesce(x.text, '')) <> ''] AS a FROM r),
        u AS (SELECT doc, unnest(a) AS x, CAST(generate_subscripts(a, 1) - 1 AS INTEGER) AS place FROM p) SELECT doc, place, x.kind AS kind, x.text AS text FROM u""",
    "w14_false_chains": f"""WITH {V.SECTIONS}, n AS (SELECT doc, seq, regexp_replace(regexp_replace(regexp_replace(section_number, ',', '.', 'g'), '(\\d)-(\\d)', '\\1.\\2', 'g'), '(\\d)-(\\d)', '\\1.\\2', 'g') AS s FROM sections), k AS (SELECT doc, seq, CAST(string_split(s, '.')[1] AS INTEGER) AS m, contains(s, '.') AS deep FROM n),
        x AS (SELECT *, last_value(CASE WHEN deep THEN m END IGNORE NULLS) OVER (PARTITION BY doc ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS p, first_value(CASE WHEN deep THEN m END IGNORE NULLS) OVER (PARTITION BY doc ORDER BY seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS q FROM k)
        SELECT doc, seq FROM x WHERE NOT deep AND m > p AND p = q""",
    "c5_counters": rf"""WITH {TQ._TYPES}, x AS (SELECT doc, page, coalesce(page_text, '') AS t FROM pgs), w AS (SELECT *, [w FOR w IN regexp_split_to_array(t, '\s+') IF w <> ''] AS ws,
            [regexp_extract(r, '(\d{{1,2}}(?:\.\d{{1,2}}){{1,5}})$', 1) FOR r IN [rtrim(r, '') FOR r IN regexp_extract_all(t, '[0-9.]+')] IF regexp_full_match(r, '\d{{1,2}}(?:\.\d{{1,2}}){{1,5}}')] AS ns FROM x)
        SELECT doc, page, len(ws) AS n_words, len(list_distinct([n FOR n IN ns IF NOT (len(string_split(n, '.')) = 2 AND ((length(string_split(n, '.')[2]) >= 2 AND string_split(n, '.')[2][1] = '0') OR CAST(string_split(n, '.')[2] AS INTEGER) > 30))])) AS n_numbers,
            length(regexp_replace(t, '\s', '', 'g')) AS n_ink, length(regexp_replace(t, '[^.]', '', 'g')) AS n_periods, len(regexp_extract_all(t, '(?i)\b(?:Figure|Table|Fig\.?)\s*\d+')) AS n_captions, regexp_matches(t, '{P.TOC_HEADER}') AS toc_header,
            len(ws) >= 150 AND len([w FOR w IN ws IF lower(w) IN ({TQ._STOP})]) > 0.15 * len(ws) AND length(regexp_replace(t, '[^\p{{L}}]', '', 'g')) > 0 AND length(regexp_replace(t, '[^\p{{Ll}}]', '', 'g')) > 0.70 * length(regexp_replace(t, '[^\p{{L}}]', '', 'g')) AND length(regexp_replace(t, '[^.]', '', 'g')) < 40 AS is_prose FROM w""",
    "w1_neighbours": f"WITH {V.PARSED} SELECT doc, seq, lag(num) OVER w AS before, lead(num) OVER w AS after FROM parsed WINDOW w AS (PARTITION BY doc ORDER BY seq)",
}
