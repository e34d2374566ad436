"""Queries of problem 3: nested OCR and table records as flat, linked tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirefold.operators import nested as N
from quirefold.sources.tables import table

BLANK = r"^[\s  -​　]*$"


def _pages(spark: SparkSession, d: str, **kw) -> DataFrame:
    return N.read_pages(N.once(table(spark, d, "raw_ocr", "rec_id", "raw_json"), "rec_id"), **kw)


def _tables(spark: SparkSession, d: str, name: str) -> DataFrame:
    return N.shred(N.once(table(spark, d, "table_ocr"), "rec_id"), "rec_id", "table", [name])[name]


def p3_pages(spark: SparkSession, d: str) -> DataFrame:
    """One row per page of a readable raw OCR record."""
    return N.pages_of_records(_pages(spark, d, fields=(), meta=False))


def p3_words(spark: SparkSession, d: str) -> DataFrame:
    """One row per position of the parallel arrays, pointing to its page."""
    return N.words_of(_pages(spark, d, meta=False))


def p3_stages(spark: SparkSession, d: str) -> DataFrame:
    """The shared image-stage element, pointing to its page."""
    return N.stages_of(_pages(spark, d, fields=()))


def p3_tables(spark: SparkSession, d: str) -> DataFrame:
    """The root table of table_ocr: all columns that don't repeat."""
    return _tables(spark, d, "table")


def p3_rows(spark: SparkSession, d: str) -> DataFrame:
    """One row per row element, pointing to its table."""
    return _tables(spark, d, "table_rows")


def p3_cells(spark: SparkSession, d: str) -> DataFrame:
    """One row per cell element, pointing to its row and table."""
    return _tables(spark, d, "table_rows_cells")


def p3_cell_boxes(spark: SparkSession, d: str) -> DataFrame:
    """One row per coordinate of a cell's box, pointing to its cell."""
    return _tables(spark, d, "table_rows_cells_bbox")


def p3_warnings(spark: SparkSession, d: str) -> DataFrame:
    """One row per warning, pointing to its table."""
    return _tables(spark, d, "table_warnings")


def p3_header_rows(spark: SparkSession, d: str) -> DataFrame:
    """One row per header row, pointing to its table."""
    return _tables(spark, d, "table_header_rows")


def p3_column_types(spark: SparkSession, d: str) -> DataFrame:
    """One row per entry of column_types, pointing to its table."""
    return _tables(spark, d, "table_column_types")


def p3_column_alignment(spark: SparkSession, d: str) -> DataFrame:
    """One row per entry of column_alignment, pointing to its table."""
    return _tables(spark, d, "table_column_alignment")


def p3_column_semantics(spark: SparkSession, d: str) -> DataFrame:
    """One row per entry of column_semantics, pointing to its table."""
    return _tables(spark, d, "table_column_semantics")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Cells with text and words with a confidence and text, by their parent."""
    cells = _tables(spark, d, "table_rows_cells")
    a = cells.filter(F.col("text").isNotNull() & ~F.col("text").rlike(BLANK)).select(
        F.lit("table").alias("src"), "rec_id", F.col("rows_pos").cast("string").alias("parent"), F.col("cells_pos").alias("child")
    )
    words = N.words_of(_pages(spark, d, fields=("conf", "text"), meta=False))
    b = words.filter((F.col("conf") >= 0) & F.col("text").isNotNull() & ~F.col("text").rlike(BLANK)).select(
        F.lit("page").alias("src"), "rec_id", F.col("page_key").alias("parent"), F.col("word_pos").alias("child")
    )
    return a.unionByName(b)


QUERIES = {f.__name__: f for f in (p3_found, p3_pages, p3_words, p3_stages, p3_tables, p3_rows, p3_cells, p3_cell_boxes, p3_warnings, p3_header_rows, p3_column_types, p3_column_alignment, p3_column_semantics)}

_ONCE = "(SELECT DISTINCT ON (rec_id) * FROM table_ocr WHERE rec_id IS NOT NULL)"
_CELLS = f"""(SELECT rec_id, rows_pos, CAST(j - 1 AS INTEGER) AS cells_pos, c
              FROM (SELECT rec_id, CAST(i - 1 AS INTEGER) AS rows_pos, unnest(r.cells) AS c, generate_subscripts(r.cells, 1) AS j
                    FROM (SELECT rec_id, unnest(rows) AS r, generate_subscripts(rows, 1) AS i FROM {_ONCE}) WHERE r IS NOT NULL) WHERE c IS NOT NULL)"""


def _list(field: str) -> str:
    return f"""
        SELECT rec_id, CAST(i - 1 AS INTEGER) AS {field}_pos, v AS value
        FROM (SELECT rec_id, unnest({field}) AS v, generate_subscripts({field}, 1) AS i FROM {_ONCE}) WHERE v IS NOT NULL"""


def _map(field: str) -> str:
    return f"""
        SELECT rec_id, e.key AS {field}_key, e.value AS value
        FROM (SELECT rec_id, unnest(map_entries({field})) AS e FROM {_ONCE}) WHERE e.value IS NOT NULL"""


# slips inside the JSON put right: stray commas, quotes between characters that neither open nor close a string
_REPAIRED = r"""regexp_replace(regexp_replace(raw_json, ',(\s*[\]}])', '\1', 'g'), '([^\[{,:\s\\])"([^\s,:\]}])', '\1\\"\2', 'g')"""
_PAGES = f"""
    one AS MATERIALIZED (SELECT DISTINCT ON (rec_id) rec_id, {_REPAIRED} AS t FROM raw_ocr WHERE rec_id IS NOT NULL AND raw_json IS NOT NULL),
    rec AS MATERIALIZED (SELECT rec_id, CAST(t AS JSON) AS j FROM one WHERE json_valid(t)),
    dicts AS (SELECT rec_id, unnest(json_keys(j)) AS k, generate_subscripts(json_keys(j), 1) AS i, j FROM rec
              WHERE json_type(j) = 'OBJECT' AND NOT list_contains(json_keys(j), 'page_dict') AND NOT (list_contains(json_keys(j), 'conf') AND list_contains(json_keys(j), 'text'))),
    found AS (SELECT rec_id, k, i, json_extract(j, '/' || replace(replace(k, '~', '~0'), '/', '~1')) AS p FROM dicts
              UNION ALL
              SELECT rec_id, NULL, generate_subscripts(CAST(j AS JSON[]), 1), unnest(CAST(j AS JSON[])) FROM rec WHERE json_type(j) = 'ARRAY'
              UNION ALL
              SELECT rec_id, NULL, 1, j FROM rec WHERE json_type(j) = 'OBJECT' AND (list_contains(json_keys(j), 'page_dict') OR list_contains(json_keys(j), 'conf') AND list_contains(json_keys(j), 'text'))),
    page AS MATERIALIZED (
        SELECT rec_id, CAST(row_number() OVER (PARTITION BY rec_id ORDER BY i) - 1 AS INTEGER) AS page_pos,
               coalesce(k, p->>'page_Id', CASE WHEN json_type(p->'page_num') = 'ARRAY' THEN p->'page_num'->>0 ELSE p->>'page_num' END, p->'page_dict'->'page_num'->>0) AS page_key,
               TRY_CAST(p->>'page_Id' AS INTEGER) AS page_id, CASE WHEN json_type(p->'page_dict') = 'OBJECT' THEN p->'page_dict' ELSE p END AS w, p->'image_meta' AS m
        FROM found WHERE json_type(p) = 'OBJECT')"""
_FIELD = {f: f"TRY_CAST(w->'{f}' AS {'VARCHAR' if f == 'text' else 'DOUBLE' if f == 'conf' else 'INTEGER'}[])" for f in N.WORD_FIELDS}


def _words(fields: tuple[str, ...]) -> str:
    arrays = ", ".join(f'{_FIELD[f]} AS "{f}"' for f in fields)
    longest = "greatest(" + ", ".join(f'coalesce(len("{f}"), 0)' for f in fields) + ")"
    return f"""{_PAGES}, arrays AS (SELECT rec_id, page_pos, page_key, {arrays} FROM page),
        word AS (SELECT *, unnest(range(CAST({longest} AS BIGINT))) AS n FROM arrays)"""


_STAGE = {f.name: "VARCHAR" if f.name in ("stage", "dtype", "dpi_source") else "INTEGER" for f in N.STAGE_TYPE.fields}
_NOT_BLANK = r"NOT regexp_full_match({0}, '[\s\x{{0B}}\x{{1C}}-\x{{1F}}\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200B}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]*')"
SQL = {
    "p3_pages": f"WITH {_PAGES} SELECT rec_id, page_pos, page_key, page_id FROM page",
    "p3_words": f"""WITH {_words(N.WORD_FIELDS)}
        SELECT rec_id, page_pos, page_key, CAST(n AS INTEGER) AS word_pos, {", ".join(f'"{f}"[n + 1] AS "{f}"' for f in N.WORD_FIELDS)} FROM word""",
    "p3_stages": f"""WITH {_PAGES}, s AS (SELECT rec_id, page_pos, unnest(['render_raw', 'canonical', 'render_full']) AS slot, m FROM page), t AS (SELECT rec_id, page_pos, slot, m->slot AS v FROM s)
        SELECT rec_id, page_pos, slot, {", ".join(f"TRY_CAST(v->>'{n}' AS {t}) AS {n}" for n, t in _STAGE.items())} FROM t WHERE json_type(v) = 'OBJECT'""",
    "p3_tables": f"SELECT * EXCLUDE (rows, warnings, header_rows, column_types, column_alignment, column_semantics) FROM {_ONCE}",
    "p3_rows": f"""
        SELECT rec_id, CAST(i - 1 AS INTEGER) AS rows_pos, r.row_index AS row_index
        FROM (SELECT rec_id, unnest(rows) AS r, generate_subscripts(rows, 1) AS i FROM {_ONCE}) WHERE r IS NOT NULL""",
    "p3_cells": f"""
        SELECT rec_id, rows_pos, cells_pos, c."row" AS "row", c.col AS col, c.row_span AS row_span, c.col_span AS col_span, c.text AS text,
               c.confidence AS confidence, c.alignment AS alignment, c.low_confidence AS low_confidence FROM {_CELLS}""",
    "p3_cell_boxes": f"""
        SELECT rec_id, rows_pos, cells_pos, CAST(b - 1 AS INTEGER) AS bbox_pos, v AS value
        FROM (SELECT rec_id, rows_pos, cells_pos, unnest(c.bbox) AS v, generate_subscripts(c.bbox, 1) AS b FROM {_CELLS}) WHERE v IS NOT NULL""",
    "p3_warnings": _list("warnings"),
    "p3_header_rows": _list("header_rows"),
    "p3_column_types": _map("column_types"),
    "p3_column_alignment": _map("column_alignment"),
    "p3_column_semantics": _map("column_semantics"),
    "p3_found": f"""WITH {_words(("conf", "text"))}
        SELECT 'table' AS src, rec_id, CAST(rows_pos AS VARCHAR) AS parent, cells_pos AS child FROM {_CELLS} WHERE c.text IS NOT NULL AND {_NOT_BLANK.format("c.text")}
        UNION ALL SELECT 'page', rec_id, page_key, CAST(n AS INTEGER) FROM word WHERE conf[n + 1] >= 0 AND text[n + 1] IS NOT NULL AND {_NOT_BLANK.format("text[n + 1]")}""",
}
