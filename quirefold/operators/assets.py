"""Figures, tables, equations and captions: normalising, validating, linking and reading order.

Assets come as rows (asset_key, asset_id, doc, page_number, asset_type, confidence, x1, y1, x2, y2, iw, ih, ...).
Null boxes overlap nothing. Joins of boxes carry (doc, page) as keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirefold.functions import geometry as G

#: Detector names and the kinds they stand for; anything else is a figure.
KINDS = {"fig": "figure", "figure": "figure", "tab": "table", "table": "table", "eq": "equation", "equation": "equation"}
UNKNOWN_PAGE = 9999


def kinds(assets: DataFrame) -> DataFrame:
    """Abandoned detections dropped, kinds and pages normalised, boxes as parts of the page."""
    t = F.lower(F.trim("asset_type"))
    m = F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv])
    a = assets.filter(~F.coalesce(t == "abandon", F.lit(False))).withColumn("kind", F.coalesce(F.try_element_at(m, t), F.lit("figure"))).withColumn("page", F.coalesce("page_number", F.lit(UNKNOWN_PAGE)))
    part = lambda c, s: F.round(F.coalesce(F.try_divide(F.col(c), F.col(s)), F.lit(1.0)), 6)
    return a.withColumn("n_left", part("x1", "iw")).withColumn("n_top", part("y1", "ih")).withColumn("n_right", part("x2", "iw")).withColumn("n_bottom", part("y2", "ih"))


def hole_punch(assets: DataFrame) -> DataFrame:
    """Whether a box is like a punched hole: tiny, near square and near a side edge."""
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    aspect = F.greatest(F.try_divide(w, h), F.try_divide(h, w))
    small = w * h <= 0.005 * F.col("iw") * F.col("ih")
    edge = (F.col("x1") <= 0.08 * F.col("iw")) | (F.col("x2") >= 0.92 * F.col("iw"))
    return assets.withColumn("is_hole", F.coalesce(small & (aspect <= 2.5) & edge, F.lit(False)))


def validation(assets: DataFrame) -> DataFrame:
    """How a detection is backed: by its caption, by a keyword in the page's text, by standing alone (formulas),
    by its layout (tables), or not at all. Needs has_caption, keyword, kind."""
    how = (
        F.when(F.col("has_caption"), "caption").when(F.col("keyword"), "ocr_keyword").when(F.col("kind") == "equation", "standalone").when(F.col("kind") == "table", "layout_only").otherwise("rejected")
    )
    return assets.withColumn("backed_by", how)


def numbered(assets: DataFrame) -> DataFrame:
    """Running number of each kind in its document, and place among the page's tables."""
    by = Window.partitionBy("doc", "kind").orderBy("page", "y1", "x1", "asset_key")
    on_page = Window.partitionBy("doc", "page", "kind").orderBy("y1", "x1", "asset_key")
    return assets.withColumn("number", F.row_number().over(by)).withColumn("ordinal", F.row_number().over(on_page) - 1)


def nearest_caption(assets: DataFrame, captions: DataFrame, least_share: float = 0.3, reach: float = 0.1) -> DataFrame:
    """Each asset with its nearest caption of the same page and kind: at least `least_share` of its width in
    common, at most `reach` of the page height away; the lowest caption_key wins ties."""
    c = captions.select("doc", "page", "kind", "caption_key", *[F.col(k).alias(f"c_{k}") for k in ("x1", "y1", "x2", "y2")])
    x = assets.join(c, ["doc", "page", "kind"])
    common = F.least("x2", "c_x2") - F.greatest("x1", "c_x1")
    dist = F.greatest(F.col("c_y1") - F.col("y2"), F.col("y1") - F.col("c_y2"), F.lit(0.0))
    x = x.withColumn("dist", dist).filter((common >= least_share * (F.col("x2") - F.col("x1"))) & (F.col("x2") > F.col("x1")) & (dist < reach * F.col("ih")))
    return x.groupBy("asset_key").agg(F.min(F.struct("dist", "caption_key")).alias("m")).select("asset_key", F.col("m.caption_key").alias("caption_key"), F.col("m.dist").alias("dist"))


def reading_order(elements: DataFrame, assets: DataFrame) -> DataFrame:
    """Text elements and assets in one stream: (page, top, input order), unplaced text first and unplaced assets last.

    elements: doc, page, n_top, seq, kind. A document without assets keeps its order."""
    e = elements.select("doc", "page", F.coalesce("n_top", F.lit(0.0)).alias("top"), F.col("seq").cast("long").alias("seq"), "kind", F.lit(None).cast("long").alias("asset_key"))
    a = assets.select("doc", "page", F.coalesce("n_top", F.lit(1.0)).alias("top"), (F.lit(1 << 40) + F.col("asset_key")).alias("seq"), "kind", F.col("asset_key").cast("long").alias("asset_key"))
    w = Window.partitionBy("doc").orderBy("page", "top", "seq")
    return e.unionByName(a).withColumn("place", F.row_number().over(w) - 1)


def type_counts(assets: DataFrame) -> DataFrame:
    return assets.groupBy("asset_type", "validated_by").agg(F.count("*").alias("n"), F.count(F.when(F.col("has_caption"), 1)).alias("captioned"))


def three_tier(wanted: DataFrame, have: DataFrame) -> DataFrame:
    """Priority lookup of deliverables: by (doc, page, id), else by place among the page's tables, else by the normalised name.

    wanted: doc, page, asset_id, ordinal, stem. have: d_key and the same columns. Of several, the lowest d_key."""
    low = lambda *k: have.groupBy(*k).agg(F.min("d_key").alias("found"))
    x = wanted.join(low("doc", "page", "asset_id").withColumnRenamed("found", "k1"), ["doc", "page", "asset_id"], "left")
    x = x.join(low("doc", "page", "ordinal").withColumnRenamed("found", "k2"), ["doc", "page", "ordinal"], "left")
    x = x.join(low("stem").withColumnRenamed("found", "k3"), "stem", "left")
    return x.withColumn("d_key", F.coalesce("k1", "k2", "k3")).withColumn("tier", F.when(F.col("k1").isNotNull(), 1).when(F.col("k2").isNotNull(), 2).when(F.col("k3").isNotNull(), 3))


def words_in_box(words: DataFrame, boxes: DataFrame, share: float = 0.3) -> DataFrame:
    """Text of the words that lie in a box to `share` of their area, by top and left: box_key, text.

    words: doc, page, word_idx, x1..y2, text in the box's units. Words without area, empty ones and '-1' are left out."""
    b = boxes.select("doc", "page", "box_key", *[F.col(c).alias(f"b_{c}") for c in ("x1", "y1", "x2", "y2")])
    w = words.filter((F.col("text") != "") & (F.col("text") != "-1") & (F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1")))
    x = w.join(b, ["doc", "page"]).filter(G.overlap(G.box(), G.box("b_")) >= share * G.area(G.box()))
    return x.groupBy("box_key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("y1", "x1", "word_idx", "text"))), lambda s: s["text"]), " ").alias("text"), F.count("*").alias("n_words"))
