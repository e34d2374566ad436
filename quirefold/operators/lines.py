"""Lines, paragraphs and page furniture from positioned words.

Words come as rows (doc, page, word_idx, block_num, par_num, line_num, left, top, width, height, conf, text);
`word_idx` is the order they were read in. Nulls in a geometry column leave that word out of boxes, a
confidence below 0 marks no word. Empty tables give empty tables; extra columns are ignored. A hot document is no problem:
words are keyed by (doc, page), lines by (doc, signature).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirefold.functions.text import heading, repeat_signature

PAGE = ("doc", "page")


def _run_id(w, *cols: str) -> Column:
    """1 where any column differs from the row before."""
    changed = F.lit(False)
    for c in cols:
        changed = changed | ~F.col(c).eqNullSafe(F.lag(c).over(w))
    return F.when(F.row_number().over(w) == 1, 1).when(changed, 1).otherwise(0)


def lines(words: DataFrame) -> DataFrame:
    """Runs of words of one (block, par, line), in reading order: line_seq, text, box, confidence and counts.

    A key that comes up again later starts a line of its own. Texts join with one blank, empty tokens included. The
    deviation is taken around the mean already rounded to one decimal."""
    w = Window.partitionBy(*PAGE).orderBy("word_idx")
    x = words.withColumn("line_seq", F.sum(_run_id(w, "block_num", "par_num", "line_num")).over(w) - 1)
    own = Window.partitionBy(*PAGE, "line_seq")
    good = F.when(F.col("conf") >= 0, F.col("conf").cast("double"))
    x = x.withColumn("c", good).withColumn("m", F.bround(F.avg(good).over(own), 1))
    right, bottom = F.col("left") + F.col("width"), F.col("top") + F.col("height")
    return x.groupBy(*PAGE, "line_seq").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word_idx", "text"))), lambda s: F.coalesce(s["text"], F.lit(""))), " ").alias("text"),
        F.min("block_num").alias("block_num"), F.min("par_num").alias("par_num"), F.min("line_num").alias("line_num"),
        F.min("left").alias("left"), F.min("top").alias("top"), F.max(right).alias("right"), F.max(bottom).alias("bottom"),
        F.count("*").alias("n_words"), F.max("m").alias("conf_mean"), F.min("c").alias("conf_min"), F.max("c").alias("conf_max"),
        F.bround(F.when(F.count("c") > 1, F.sqrt(F.avg((F.col("c") - F.col("m")) ** 2))).otherwise(0.0), 1).alias("conf_std"),
        F.count(F.when(F.col("c") < 50, 1)).alias("n_low"),
    )


def median_height(lines_: DataFrame) -> DataFrame:
    """Median height of a page's lines; 10 where none has a height."""
    h = F.col("bottom") - F.col("top")
    return lines_.groupBy(*PAGE).agg(F.coalesce(F.median(F.when(h > 0, h)), F.lit(10.0)).alias("median_h"))


def paragraphs(lines_: DataFrame) -> DataFrame:
    """Runs of lines of one (block, par) of a page, blank ones skipped: par_seq, text, box."""
    x = lines_.filter(F.trim("text") != "")
    w = Window.partitionBy(*PAGE).orderBy("line_seq")
    x = x.withColumn("par_seq", F.sum(_run_id(w, "block_num", "par_num")).over(w) - 1)
    return x.groupBy(*PAGE, "par_seq").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_seq", "text"))), lambda s: F.trim(s["text"])), " ").alias("text"),
        F.count("*").alias("n_lines"), F.min("left").alias("left"), F.min("top").alias("top"), F.max("right").alias("right"), F.max("bottom").alias("bottom"),
    )


def page_metadata(words: DataFrame) -> DataFrame:
    c = F.when(F.col("conf") >= 0, F.col("conf").cast("double"))
    return words.groupBy(*PAGE).agg(
        F.count("*").alias("n_words"), F.countDistinct("block_num").alias("n_blocks"), F.countDistinct("block_num", "par_num").alias("n_pars"),
        F.countDistinct("block_num", "par_num", "line_num").alias("n_lines"), F.round(F.avg(c), 4).alias("conf_avg"), F.min(c).alias("conf_min"), F.max(c).alias("conf_max"),
    )


def running_lines(lines_: DataFrame, page_height: float, top: float = 0.12, bottom: float = 0.88) -> DataFrame:
    """(doc, signature, band, n_pages) of lines repeated at the top or bottom of at least three pages and half of
    a document's pages; numbered headings are never such lines."""
    n = lines_.groupBy("doc").agg(F.countDistinct("page").alias("doc_pages"))
    y = F.col("top") / page_height
    x = lines_.withColumn("band", F.when(y <= top, "top").when(y >= bottom, "bottom")).filter("band is not null and trim(text) <> ''")
    x = x.filter(~heading(F.trim("text"))["ok"]).withColumn("signature", repeat_signature(F.col("text"))).filter("signature <> ''")
    g = x.groupBy("doc", "signature", "band").agg(F.countDistinct("page").alias("n_pages")).join(n, "doc")
    return g.filter((F.col("doc_pages") >= 3) & (F.col("n_pages") >= F.greatest(F.lit(3), F.floor(F.col("doc_pages") / 2)))).select("doc", "signature", "band", "n_pages")


def drop_reasons(lines_: DataFrame, running: DataFrame, assets: DataFrame, page_width: float, page_height: float, top: float = 0.07, bottom: float = 0.93, share: float = 0.6) -> DataFrame:
    """Each line with its first reason to be dropped: running, header_band, footer_band, asset, or null.

    Headings are only dropped for assets. assets: doc, page, left, top, right, bottom as parts of the page."""
    y = F.col("top") / page_height
    x = lines_.withColumn("signature", repeat_signature(F.col("text"))).withColumn("band", F.when(y <= 0.12, "top").when(y >= 0.88, "bottom"))
    x = x.join(running.select("doc", "signature", "band", F.lit(True).alias("is_running")), ["doc", "signature", "band"], "left")
    x = x.withColumn("h", heading(F.trim("text"))["ok"])
    hit = overlapped(lines_, assets, page_width, page_height, share).withColumn("is_asset", F.lit(True))
    x = x.join(hit, [*PAGE, "line_seq"], "left")
    reason = (
        F.when(F.col("is_running") & ~F.col("h"), "running").when((y < top) & ~F.col("h"), "header_band").when((y > bottom) & ~F.col("h"), "footer_band").when(F.col("is_asset"), "asset")
    )
    return x.select(*PAGE, "line_seq", "text", reason.alias("reason"))


def overlapped(lines_: DataFrame, assets: DataFrame, page_width: float, page_height: float, share: float = 0.6) -> DataFrame:
    """Lines covered by an asset of their page to at least `share` of their area; lines without area never are."""
    l = lines_.select(*PAGE, "line_seq", *[(F.col(c) / s).alias(f"l_{c}") for c, s in (("left", page_width), ("right", page_width), ("top", page_height), ("bottom", page_height))])
    a = assets.select(*PAGE, *[F.col(c).alias(f"a_{c}") for c in ("left", "top", "right", "bottom")])
    w = F.greatest(F.least("l_right", "a_right") - F.greatest("l_left", "a_left"), F.lit(0.0))
    h = F.greatest(F.least("l_bottom", "a_bottom") - F.greatest("l_top", "a_top"), F.lit(0.0))
    area = (F.col("l_right") - F.col("l_left")) * (F.col("l_bottom") - F.col("l_top"))
    return l.join(a, list(PAGE)).filter((area > 0) & (w * h >= share * area)).select(*PAGE, "line_seq").distinct()


def elements(lines_: DataFrame) -> DataFrame:
    """Headings and text blocks in order (doc, seq): the element stream before text is attached."""
    w = Window.partitionBy("doc").orderBy("page", "line_seq")
    h = heading(F.trim("text"))
    x = lines_.filter("trim(text) <> ''").withColumn("seq", F.row_number().over(w) - 1).withColumn("h", h)
    return x.select("doc", "seq", "page", "block_num", "par_num", F.when(F.col("h.ok"), "section").otherwise("unassigned_text_block").alias("type"), "text", F.col("h.number").alias("section_number"), F.col("h.topic").alias("topic"), "left", "top", "right", "bottom")


def attach_content(elements_: DataFrame) -> DataFrame:
    """Sections with the text behind them as `content` (lines joined by line breaks), and the text before the first."""
    w = Window.partitionBy("doc").orderBy("seq")
    x = elements_.withColumn("ord", F.sum(F.when(F.col("type") == "section", 1).otherwise(0)).over(w))
    body = F.when(F.col("type") != "section", F.struct("seq", "text"))
    g = x.groupBy("doc", "ord").agg(F.min("seq").alias("seq"), F.max("section_number").alias("section_number"), F.max("topic").alias("topic"), F.min("page").alias("page"),
                                    F.array_join(F.transform(F.array_sort(F.collect_list(body)), lambda s: s["text"]), "\n").alias("content"))
    return g.select("doc", "ord", "seq", "page", "section_number", "topic", "content")
