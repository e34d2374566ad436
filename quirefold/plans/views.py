"""Derived views that bind the test tables to the operators' inputs, in Spark and as SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirefold.sources.tables import table

PAGE_W, PAGE_H = 2550.0, 3300.0


def words(spark: SparkSession, d: str) -> DataFrame:
    """OCR words of page_text: one page each, geometry and confidence from their places."""
    p = table(spark, d, "page_text", "page_id", "doc_stem", "page_number", "page_text").filter("page_id is not null").dropDuplicates(["page_id"])
    l = p.select(F.coalesce("doc_stem", F.lit("?")).alias("doc"), F.col("page_id").alias("page"), F.posexplode(F.split("page_text", "\n", -1)).alias("ln", "line"))
    w = l.select("doc", "page", "ln", F.posexplode(F.split("line", " ", -1)).alias("wn", "text"))
    return w.select(
        "doc", "page", (F.col("ln") * 100000 + F.col("wn")).alias("word_idx"), F.floor(F.col("ln") / 8).cast("int").alias("block_num"), F.floor(F.col("ln") / 4).cast("int").alias("par_num"),
        F.col("ln").alias("line_num"), (100 + 60 * F.col("wn")).alias("left"), (60 + 130 * F.col("ln")).alias("top"), (10 * F.length("text")).alias("width"),
        (30 + 10 * F.pmod(F.col("page") + F.col("ln"), F.lit(3))).alias("height"), F.when(F.col("text") == "", -1).otherwise(F.pmod(F.col("page") * 31 + F.col("ln") * 17 + F.col("wn") * 7, F.lit(101))).alias("conf"), "text",
    )


WORDS = """
    pg AS (SELECT DISTINCT page_id, doc_stem, page_text FROM page_text WHERE page_id IS NOT NULL),
    ln0 AS (SELECT coalesce(doc_stem, '?') AS doc, page_id AS page, unnest(string_split(page_text, chr(10))) AS line, generate_subscripts(string_split(page_text, chr(10)), 1) - 1 AS ln FROM pg),
    wd0 AS (SELECT doc, page, ln, unnest(string_split(line, ' ')) AS text, generate_subscripts(string_split(line, ' '), 1) - 1 AS wn FROM ln0),
    words AS (SELECT doc, page, ln * 100000 + wn AS word_idx, ln // 8 AS block_num, ln // 4 AS par_num, ln AS line_num, 100 + 60 * wn AS "left", 60 + 130 * ln AS top, 10 * length(text) AS width,
        30 + 10 * ((page + ln) % 3) AS height, CASE WHEN text = '' THEN -1 ELSE (page * 31 + ln * 17 + wn * 7) % 101 END AS conf, text FROM wd0)"""
LINES = WORDS + """,
    cm AS (SELECT doc, page, line_num, round_even(avg(conf) FILTER (conf >= 0), 1) AS m FROM words GROUP BY ALL),
    lines AS (SELECT w.doc, w.page, w.line_num AS line_seq, string_agg(text, ' ' ORDER BY word_idx) AS text, min(block_num) AS block_num, min(par_num) AS par_num, w.line_num AS line_num,
        min("left") AS "left", min(top) AS top, max("left" + width) AS "right", max(top + height) AS bottom, count(*) AS n_words, max(m) AS conf_mean,
        min(conf) FILTER (conf >= 0) AS conf_min, max(conf) FILTER (conf >= 0) AS conf_max,
        round_even(CASE WHEN count(*) FILTER (conf >= 0) > 1 THEN sqrt(avg((conf - m) ** 2) FILTER (conf >= 0)) ELSE 0.0 END, 1) AS conf_std,
        count(*) FILTER (conf >= 0 AND conf < 50) AS n_low
        FROM words w JOIN cm ON w.doc = cm.doc AND w.page = cm.page AND w.line_num = cm.line_num GROUP BY w.doc, w.page, w.line_num)"""


#: Parts whose names are sent to all workers; if there are more, it's left to the planner.
MAX_PARTS = 2_000_000


def sections(spark: SparkSession, d: str, rows_a_task: int | None = None) -> DataFrame:
    """Numbered sections of documents, made from lineitem and part: doc, seq, section_number, topic, page, box.

    rows_a_task: documents go to so many tasks that each has about so many rows to sort; else to as many as the session says.
    Names are then looked up behind that shuffle, which carries keys and numbers alone."""
    from pyspark.sql import Window

    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    l = table(spark, d, "lineitem", *order)
    part, known = table(spark, d, "part", "p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey")
    k, n, s, p = F.col("l_orderkey"), F.col("l_linenumber").cast("string"), F.col("l_suppkey"), F.col("l_partkey")
    two = F.concat(n, F.lit("."), (s % 12 + 1).cast("string"))
    number = (
        F.when(p % 4 == 0, n).when(p % 4 == 1, two).when(p % 4 == 2, F.concat(two, F.lit("."), (p % 60).cast("string")))
        .otherwise(F.concat(n, F.lit(","), (s % 12 + 1).cast("string"), F.lit("-"), (p % 9 + 1).cast("string")))
    )
    if rows_a_task:
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), l.count() // rows_a_task)
        keys = part.agg(F.count("*").alias("all"), F.count("p_partkey").alias("given"), F.count_distinct("p_partkey").alias("distinct")).first()
        if keys["given"] == keys["distinct"]:
            # one name a part: lines that are equal up to the quantity make equal sections, whichever comes first
            order = order[:5]
        few = keys["all"] <= MAX_PARTS
        x = l.select(*order) if few else l.select(*order).join(part, known)
        # within a document the key's rest orders as the key does
        x = x.withColumn("doc", F.floor(k / 16)).withColumn("l_orderkey", k - F.col("doc") * 16).repartition(tasks, "doc")
        x = x.join(F.broadcast(part), known) if few else x
    else:
        x = l.join(part, known).withColumn("doc", F.floor(k / 16))
    w = Window.partitionBy("doc").orderBy(*order)
    return x.select(
        "doc", (F.row_number().over(w) - 1).alias("seq"), number.alias("section_number"), F.col("p_name").alias("topic"), (1 + F.floor("l_quantity") % 10).cast("int").alias("page"),
        (100 + (p % 5) * 40).alias("x_left"), (60 + (s % 30) * 100).alias("y_top"), (200 + (p % 50) * 10).alias("w"), (30 + (p % 4) * 10).alias("h"),
    )


SECTIONS = """
    sections AS (SELECT l_orderkey // 16 AS doc,
        row_number() OVER (PARTITION BY l_orderkey // 16 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) - 1 AS seq,
        CASE l_partkey % 4 WHEN 0 THEN CAST(l_linenumber AS VARCHAR) WHEN 1 THEN l_linenumber || '.' || (l_suppkey % 12 + 1) WHEN 2 THEN l_linenumber || '.' || (l_suppkey % 12 + 1) || '.' || (l_partkey % 60)
            ELSE l_linenumber || ',' || (l_suppkey % 12 + 1) || '-' || (l_partkey % 9 + 1) END AS section_number,
        p_name AS topic, CAST(1 + CAST(floor(l_quantity) AS INTEGER) % 10 AS INTEGER) AS page, 100 + (l_partkey % 5) * 40 AS x_left, 60 + (l_suppkey % 30) * 100 AS y_top,
        200 + (l_partkey % 50) * 10 AS w, 30 + (l_partkey % 4) * 10 AS h FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def norm_sql(x: str) -> str:
    """SQL of functions.numbers.normalise, without lookarounds: hyphens between digits are replaced twice, as matches may share a digit."""
    one = f"replace({x}, ',', '.')"
    for _ in range(2):
        one = rf"regexp_replace({one}, '(\d)-(\d)', '\1.\2', 'g')"
    return rf"regexp_replace({one}, '\.{{2,}}', '.', 'g')"


PARSED = SECTIONS + rf""",
    pn AS (SELECT *, regexp_replace({norm_sql('trim(section_number)')}, '^\.+|\.+$', '', 'g') AS num FROM sections),
    parsed AS (SELECT *, string_split(num, '.') AS parts, len(string_split(num, '.')) AS depth, try_cast(string_split(num, '.')[1] AS INTEGER) AS major FROM pn)"""


def assets(spark: SparkSession, d: str) -> DataFrame:
    """Detected assets, once each, with their box as corners in pixels and as parts of the page."""
    a = table(spark, d, "detected_asset").filter("asset_key is not null").dropDuplicates(["asset_key"])
    box = [F.get("bbox_pixels", F.lit(i)).cast("double") for i in range(4)]
    return a.select("asset_key", "asset_id", F.coalesce("doc_stem", F.lit("?")).alias("doc"), "page_number", "asset_type", "confidence", "class_id", *[b.alias(n) for b, n in zip(box, ("x1", "y1", "x2", "y2"))],
                    F.col("image_width").cast("double").alias("iw"), F.col("image_height").cast("double").alias("ih"), "has_caption", "caption_text", "caption_bbox", "validated_by")


ASSETS = """
    assets AS (SELECT DISTINCT asset_key, asset_id, coalesce(doc_stem, '?') AS doc, page_number, asset_type, confidence, class_id, CAST(bbox_pixels[1] AS DOUBLE) AS x1, CAST(bbox_pixels[2] AS DOUBLE) AS y1,
        CAST(bbox_pixels[3] AS DOUBLE) AS x2, CAST(bbox_pixels[4] AS DOUBLE) AS y2, CAST(image_width AS DOUBLE) AS iw, CAST(image_height AS DOUBLE) AS ih, has_caption, caption_text, caption_bbox, validated_by
        FROM detected_asset WHERE asset_key IS NOT NULL)"""


def cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells of table_ocr with their table's declared size; ord is the order they were listed in."""
    t = table(spark, d, "table_ocr", "rec_id", "n_rows", "n_cols", "rows").filter("rec_id is not null").dropDuplicates(["rec_id"])
    r = t.select("rec_id", "n_rows", "n_cols", F.posexplode("rows").alias("rp", "r")).filter("r is not null")
    c = r.select("rec_id", "n_rows", "n_cols", "rp", F.posexplode("r.cells").alias("cp", "c")).filter("c is not null")
    return c.select("rec_id", "n_rows", "n_cols", (F.col("rp") * 1000 + F.col("cp")).alias("ord"), F.col("c.row").alias("row"), F.col("c.col").alias("col"),
                    F.greatest(F.coalesce("c.row_span", F.lit(1)), F.lit(1)).alias("row_span"), F.greatest(F.coalesce("c.col_span", F.lit(1)), F.lit(1)).alias("col_span"), F.col("c.text").alias("text"), F.col("c.alignment").alias("alignment"), F.col("c.confidence").alias("confidence"))


CELLS = """
    tb AS (SELECT DISTINCT ON (rec_id) rec_id, n_rows, n_cols, rows FROM table_ocr WHERE rec_id IS NOT NULL),
    rw AS (SELECT rec_id, n_rows, n_cols, generate_subscripts(rows, 1) - 1 AS rp, unnest(rows) AS r FROM tb),
    ce AS (SELECT rec_id, n_rows, n_cols, rp, generate_subscripts(r.cells, 1) - 1 AS cp, unnest(r.cells) AS c FROM rw WHERE r IS NOT NULL),
    cells AS (SELECT rec_id, n_rows, n_cols, rp * 1000 + cp AS ord, c."row" AS "row", c.col AS col, greatest(coalesce(c.row_span, 1), 1) AS row_span, greatest(coalesce(c.col_span, 1), 1) AS col_span,
        c.text AS text, c.alignment AS alignment, c.confidence AS confidence FROM ce WHERE c IS NOT NULL)"""
