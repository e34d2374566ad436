"""Queries of assets, captions, reading order and detection scoring (S6, G, J1-J5, J9-J15, O1, O4, P10-P14, W10, W11, A13-A21)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirefold.functions import geometry as G
from quirefold.operators import assets as A
from quirefold.operators import evaluation as E
from quirefold.plans import views as V
from quirefold.sources.tables import table


def _assets(spark: SparkSession, d: str) -> DataFrame:
    return A.kinds(V.assets(spark, d))


def s6_asset_scan(spark: SparkSession, d: str) -> DataFrame:
    return _assets(spark, d).select("asset_key", "doc", "page", "kind")


def g1_normalized_boxes(spark: SparkSession, d: str) -> DataFrame:
    return _assets(spark, d).select("asset_key", "n_left", "n_top", "n_right", "n_bottom")


def p10_hole_punch(spark: SparkSession, d: str) -> DataFrame:
    return A.hole_punch(V.assets(spark, d)).select("asset_key", "is_hole")


def p11_validation_cascade(spark: SparkSession, d: str) -> DataFrame:
    """With P12: the keyword is looked for in the text of the asset's page."""
    a = _assets(spark, d)
    p = table(spark, d, "page_text", "doc_stem", "page_number", "page_text").filter("doc_stem is not null and page_number is not null").groupBy(F.col("doc_stem").alias("doc"), F.col("page_number").alias("page"))
    t = F.lower(F.col("page_text"))
    hit = lambda p: F.max(F.coalesce(t.rlike(p), F.lit(False)))
    k = p.agg(hit(r"\b(?:figure|fig\.?)\s*\d").alias("k_figure"), hit(r"\b(?:table|tab\.?)\s*\d").alias("k_table"), hit(r"\b(?:equation|eq\.?)\s*\(?\d").alias("k_equation"))
    x = a.join(k, ["doc", "page"], "left")
    key = F.when(F.col("kind") == "figure", F.col("k_figure")).when(F.col("kind") == "table", F.col("k_table")).otherwise(F.col("k_equation"))
    return A.validation(x.withColumn("keyword", F.coalesce(key, F.lit(False)))).select("asset_key", "kind", "keyword", "backed_by")


def w11_asset_numbers(spark: SparkSession, d: str) -> DataFrame:
    return A.numbered(_assets(spark, d)).select("asset_key", "number", "ordinal")


def _captions(a: DataFrame) -> DataFrame:
    return a.filter("caption_bbox is not null").select("doc", "page", "kind", F.col("asset_key").alias("caption_key"), *[F.get("caption_bbox", F.lit(i)).cast("double").alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))])


def j3_nearest_caption(spark: SparkSession, d: str) -> DataFrame:
    a = _assets(spark, d)
    return A.nearest_caption(a, _captions(a))


def j4_three_tier_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Tables against table_ocr by id, place on the page, or name."""
    a = A.numbered(_assets(spark, d)).filter("kind = 'table'").withColumn("stem", F.lower(F.regexp_replace("doc", r"[\s_-]+", "")))
    t = table(spark, d, "table_ocr", "rec_id", "table_id", "doc_stem", "page_number").filter("rec_id is not null").dropDuplicates(["rec_id"])
    from pyspark.sql import Window

    t = t.withColumn("ordinal", F.row_number().over(Window.partitionBy("doc_stem", "page_number").orderBy("rec_id")) - 1)
    t = t.select(F.col("rec_id").alias("d_key"), F.col("doc_stem").alias("doc"), F.col("page_number").alias("page"), F.col("table_id").alias("asset_id"), "ordinal", F.lower(F.regexp_replace("doc_stem", r"[\s_-]+", "")).alias("stem"))
    return A.three_tier(a.select("asset_key", "doc", "page", "asset_id", "ordinal", "stem"), t).select("asset_key", "d_key", "tier")


def o1_reading_order(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "page_text", "page_id", "doc_stem", "page_number").filter("page_id is not null").dropDuplicates(["page_id"])
    e = p.select(F.coalesce("doc_stem", F.lit("?")).alias("doc"), F.coalesce("page_number", F.lit(A.UNKNOWN_PAGE)).alias("page"), F.lit(0.1).alias("n_top"), F.col("page_id").alias("seq"), F.lit("text").alias("kind"))
    return A.reading_order(e, _assets(spark, d)).select("doc", "place", "page", "kind", "asset_key")


def a16_type_counts(spark: SparkSession, d: str) -> DataFrame:
    return A.type_counts(V.assets(spark, d))


def j2_caption_words(spark: SparkSession, d: str) -> DataFrame:
    """Words of a page that lie in a fixed band of it, as those of a caption box would."""
    w = V.words(spark, d).withColumnRenamed("left", "x1").withColumnRenamed("top", "y1").withColumn("x2", F.col("x1") + F.col("width")).withColumn("y2", F.col("y1") + F.col("height"))
    b = w.select("doc", "page").distinct().select("doc", "page", F.col("page").alias("box_key"), F.lit(100.0).alias("x1"), (60 + 130 * F.pmod("page", F.lit(9))).cast("double").alias("y1"), F.lit(420.0).alias("x2"), (300 + 130 * F.pmod("page", F.lit(9))).cast("double").alias("y2"))
    return A.words_in_box(w.select("doc", "page", "word_idx", "x1", "y1", "x2", "y2", "text"), b)


def _truth(spark: SparkSession, d: str) -> DataFrame:
    a = V.assets(spark, d).filter("page_number is not null")
    return a.select(F.concat_ws("#", "doc", F.col("page_number").cast("string")).alias("image"), "class_id", F.col("asset_key").alias("gt_id"), "x1", "y1", "x2", "y2")


def _pred(spark: SparkSession, d: str, models: int = 1) -> DataFrame:
    """Truths shifted a little, by model and key, with a confidence of their own."""
    t = _truth(spark, d).withColumn("m", F.explode(F.sequence(F.lit(0), F.lit(models - 1))))
    s = (F.col("m") * 6 + F.pmod("gt_id", F.lit(5)) * 8).cast("double")
    return t.select("image", "class_id", (F.col("gt_id") * 4 + F.col("m")).alias("det_id"), *[(F.col(c) + s).alias(c) for c in ("x1", "y1", "x2", "y2")], (F.pmod(F.col("gt_id") * 37 + F.col("m") * 11, F.lit(100)) / 100).alias("conf"))


def g3_iou_pairs(spark: SparkSession, d: str) -> DataFrame:
    return E.pair_iou(_pred(spark, d), _truth(spark, d))


def j9_greedy_match(spark: SparkSession, d: str) -> DataFrame:
    return E.greedy_match(_pred(spark, d), _truth(spark, d))


def a13_prf_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Scores where a prediction counts as a hit if it meets its own truth at 0.5."""
    p, t = _pred(spark, d), _truth(spark, d)
    hit = E.pair_iou(p, t, 0.5).filter(F.floor(F.col("det_id") / 4) == F.col("gt_id")).select("det_id", F.lit(True).alias("tp"))
    return E.precision_recall(p.join(hit, "det_id", "left").withColumn("tp", F.coalesce("tp", F.lit(False))), t)


def a15_wbf(spark: SparkSession, d: str) -> DataFrame:
    return E.fuse(_pred(spark, d, 3), 3)


def g7_suppress(spark: SparkSession, d: str) -> DataFrame:
    return E.suppress(_pred(spark, d, 2))


def j10_containment(spark: SparkSession, d: str) -> DataFrame:
    return E.contained(_pred(spark, d), 5, 3, 0.2)


def j10_with_parent(spark: SparkSession, d: str) -> DataFrame:
    """Boxes of class 5 that touch one of class 3 made taller."""
    return E.with_parent(_pred(spark, d), [5], [3])


def g4_near_captions(spark: SparkSession, d: str) -> DataFrame:
    """How far each asset's caption lies from it, and whether that is near."""
    a = V.assets(spark, d).filter("caption_bbox is not null")
    cap = [F.get("caption_bbox", F.lit(i)).cast("double") for i in range(4)]
    return a.select("asset_key", F.round(G.distance(G.box(), cap, F.col("ih")), 6).alias("distance"), G.near(G.box(), cap, F.col("ih")).alias("near"))


def g2_page_sizes(spark: SparkSession, d: str) -> DataFrame:
    """The page size of each asset: its image's, else the largest of its document's, else a page that holds the box."""
    a = V.assets(spark, d)
    of_doc = a.groupBy("doc").agg(F.max("iw").alias("dw"), F.max("ih").alias("dh"))
    w, h = G.page_size(F.when(F.col("asset_key") % 3 != 0, F.col("iw")), F.col("ih"), G.box(), (V.PAGE_W, V.PAGE_H), (F.when(F.col("asset_key") % 2 == 0, F.col("dw")), F.col("dh")))
    return a.join(of_doc, "doc").select("asset_key", w.alias("width"), h.alias("height"))


def p14_threshold(spark: SparkSession, d: str) -> DataFrame:
    """Detections that reach their class's threshold, 0.25 where none is set."""
    th = F.when(F.col("class_id") == 3, 0.5).when(F.col("class_id") == 5, 0.35).otherwise(0.25)
    return _pred(spark, d).filter(F.col("conf") >= th).groupBy("class_id").agg(F.count("*").alias("n"))


def a14_rarity(spark: SparkSession, d: str) -> DataFrame:
    return E.rarity(_truth(spark, d).select("image", "class_id"))


def o4_stratified_split(spark: SparkSession, d: str) -> DataFrame:
    s = E.stratified_split(a14_rarity(spark, d), 5)
    return s.groupBy("split").agg(F.count("*").alias("n"))


def j15_compare_runs(spark: SparkSession, d: str) -> DataFrame:
    """Two settings against each other, image by image."""
    p, t = _pred(spark, d), _truth(spark, d)
    own = E.pair_iou(p, t).filter(F.floor(F.col("det_id") / 4) == F.col("gt_id"))
    n = t.groupBy("image").agg(F.count("*").alias("gt"))

    def run(least: float) -> DataFrame:
        h = n.join(own.filter(F.col("iou") >= least).groupBy("image").agg(F.count("*").alias("tp")), "image", "left").withColumn("tp", F.coalesce("tp", F.lit(0)))
        return h.select("image", "tp", (F.col("gt") - F.col("tp")).alias("fp"), (F.col("gt") - F.col("tp")).alias("fn"))

    return E.compare_runs(run(0.7), run(0.5)).groupBy("verdict").agg(F.count("*").alias("n"), F.sum("delta").alias("gain"))


def a17_confusion(spark: SparkSession, d: str) -> DataFrame:
    a = V.assets(spark, d).filter("confidence is not null")
    return E.confusion(a.select(F.coalesce("has_caption", F.lit(False)).alias("label"), (F.col("confidence") >= 0.8).alias("pred")))


def a5_corr(spark: SparkSession, d: str) -> DataFrame:
    a = V.assets(spark, d).filter("confidence is not null and has_caption is not null")
    x = a.select(F.col("has_caption").cast("int").alias("label"), F.col("confidence"), (F.col("x2") - F.col("x1")).alias("w"), (F.col("y2") - F.col("y1")).alias("h"), F.lit(1.0).alias("flat"))
    return E.correlations(x, "label", ["confidence", "w", "h", "flat"])


def a10_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    a = V.assets(spark, d).filter("caption_text is not null").withColumn("kind", F.coalesce("asset_type", F.lit("?")))
    return E.vocabulary(a, "caption_text", "kind", 20, ("the", "and", "for"))


def k9_presence(spark: SparkSession, d: str) -> DataFrame:
    """Which documents are there as pages, assets and register entries, by their bare name."""
    name = F.lower(F.regexp_replace("doc_stem", r"[\s_-]+", ""))
    have = lambda t, c: table(spark, d, t, "doc_stem").filter("doc_stem is not null").select(name.alias("stem")).distinct().withColumn(c, F.lit(True))
    x = have("page_text", "p").join(have("detected_asset", "a"), "stem", "full").join(have("doc_register", "r"), "stem", "full")
    b = lambda c: F.coalesce(F.col(c), F.lit(False))
    return x.select("stem", b("p").alias("has_pages"), b("a").alias("has_assets"), b("r").alias("in_register"))


def r4_caption_seq(spark: SparkSession, d: str) -> DataFrame:
    """Running caption numbers of each kind in reading order, for captioned assets."""
    a = _assets(spark, d).filter("has_caption")
    n = A.numbered(a)
    return n.select("asset_key", F.concat(F.initcap("kind"), F.lit(" "), F.col("number").cast("string"), F.when(F.col("caption_text").isNotNull(), F.concat(F.lit(". "), F.col("caption_text"))).otherwise("")).alias("caption"))


QUERIES = {f.__name__: f for f in (s6_asset_scan, g1_normalized_boxes, p10_hole_punch, p11_validation_cascade, w11_asset_numbers, j2_caption_words, j3_nearest_caption, j4_three_tier_lookup, o1_reading_order, a16_type_counts, g3_iou_pairs,
                                   j9_greedy_match, a13_prf_rollup, a15_wbf, g7_suppress, j10_containment, j10_with_parent, g4_near_captions, g2_page_sizes, p14_threshold, a14_rarity, o4_stratified_split, j15_compare_runs, a17_confusion, a5_corr, a10_vocabulary, k9_presence, r4_caption_seq)}
# p<number>_ names are those of the training-data problems; the inventory's P10, P11 and P14 go by their own words
for _old, _new in (("p10_hole_punch", "hole_punch"), ("p11_validation_cascade", "validation_cascade"), ("p14_threshold", "class_threshold")):
    QUERIES[_new] = QUERIES.pop(_old)

_KINDS = V.ASSETS + """,
    ak AS (SELECT *, CASE WHEN lower(trim(asset_type)) IN ('tab', 'table') THEN 'table' WHEN lower(trim(asset_type)) IN ('eq', 'equation') THEN 'equation' ELSE 'figure' END AS kind, coalesce(page_number, 9999) AS page FROM assets WHERE coalesce(lower(trim(asset_type)), '') <> 'abandon'),
    num AS (SELECT *, row_number() OVER (PARTITION BY doc, kind ORDER BY page, y1, x1, asset_key) AS number, row_number() OVER (PARTITION BY doc, page, kind ORDER BY y1, x1, asset_key) - 1 AS ordinal FROM ak)"""
_TRUTH = V.ASSETS + ", truth AS (SELECT doc || '#' || page_number AS image, class_id, asset_key AS gt_id, x1, y1, x2, y2 FROM assets WHERE page_number IS NOT NULL)"
_PRED = _TRUTH + ", pred AS (SELECT image, class_id, gt_id * 4 AS det_id, x1 + s AS x1, y1 + s AS y1, x2 + s AS x2, y2 + s AS y2, ((gt_id * 37) % 100) / 100 AS conf FROM (SELECT *, (gt_id % 5) * 8.0 AS s FROM truth))"
_IOU = _PRED + """, ov AS (SELECT p.image, p.class_id, det_id, gt_id, greatest(least(p.x2, t.x2) - greatest(p.x1, t.x1), 0) * greatest(least(p.y2, t.y2) - greatest(p.y1, t.y1), 0) AS i,
        greatest(p.x2 - p.x1, 0) * greatest(p.y2 - p.y1, 0) + greatest(t.x2 - t.x1, 0) * greatest(t.y2 - t.y1, 0) AS s FROM pred p JOIN truth t ON p.image = t.image AND p.class_id = t.class_id),
    iou AS (SELECT image, class_id, det_id, gt_id, i / (s - i) AS v FROM ov WHERE i > 0)"""
_HIT = _IOU + ", own AS (SELECT image, class_id, det_id, gt_id, v FROM iou WHERE det_id // 4 = gt_id)"
_NAME = "lower(regexp_replace({0}, '[\\s_-]+', '', 'g'))"
SQL = {
    "s6_asset_scan": f"WITH {_KINDS} SELECT asset_key, doc, page, kind FROM ak",
    "g1_normalized_boxes": f"WITH {_KINDS} SELECT asset_key, round(coalesce(x1 / nullif(iw, 0), 1), 6) AS n_left, round(coalesce(y1 / nullif(ih, 0), 1), 6) AS n_top, round(coalesce(x2 / nullif(iw, 0), 1), 6) AS n_right, round(coalesce(y2 / nullif(ih, 0), 1), 6) AS n_bottom FROM ak",
    "hole_punch": f"WITH {V.ASSETS} SELECT asset_key, coalesce((x2 - x1) * (y2 - y1) <= 0.005 * iw * ih AND greatest((x2 - x1) / nullif(y2 - y1, 0), (y2 - y1) / nullif(x2 - x1, 0)) <= 2.5 AND (x1 <= 0.08 * iw OR x2 >= 0.92 * iw), false) AS is_hole FROM assets",
    "validation_cascade": rf"""WITH {_KINDS}, kw AS (SELECT doc_stem AS doc, page_number AS page, bool_or(coalesce(regexp_matches(lower(page_text), '\b(?:figure|fig\.?)\s*\d'), false)) AS kf, bool_or(coalesce(regexp_matches(lower(page_text), '\b(?:table|tab\.?)\s*\d'), false)) AS kt,
            bool_or(coalesce(regexp_matches(lower(page_text), '\b(?:equation|eq\.?)\s*\(?\d'), false)) AS ke FROM page_text WHERE doc_stem IS NOT NULL AND page_number IS NOT NULL GROUP BY ALL),
        x AS (SELECT a.asset_key, kind, has_caption, coalesce(CASE kind WHEN 'figure' THEN kf WHEN 'table' THEN kt ELSE ke END, false) AS keyword FROM ak a LEFT JOIN kw ON a.doc = kw.doc AND a.page = kw.page)
        SELECT asset_key, kind, keyword, CASE WHEN has_caption THEN 'caption' WHEN keyword THEN 'ocr_keyword' WHEN kind = 'equation' THEN 'standalone' WHEN kind = 'table' THEN 'layout_only' ELSE 'rejected' END AS backed_by FROM x""",
    "w11_asset_numbers": f"WITH {_KINDS} SELECT asset_key, number, ordinal FROM num",
    "j3_nearest_caption": f"""WITH {_KINDS}, cp AS (SELECT doc, page, kind, asset_key AS caption_key, CAST(caption_bbox[1] AS DOUBLE) AS c1, CAST(caption_bbox[2] AS DOUBLE) AS c2, CAST(caption_bbox[3] AS DOUBLE) AS c3, CAST(caption_bbox[4] AS DOUBLE) AS c4 FROM ak WHERE caption_bbox IS NOT NULL),
        x AS (SELECT a.asset_key, caption_key, greatest(c2 - y2, y1 - c4, 0) AS dist FROM ak a JOIN cp ON a.doc = cp.doc AND a.page = cp.page AND a.kind = cp.kind WHERE least(x2, c3) - greatest(x1, c1) >= 0.3 * (x2 - x1) AND x2 > x1 AND greatest(c2 - y2, y1 - c4, 0) < 0.1 * ih)
        SELECT DISTINCT ON (asset_key) asset_key, caption_key, dist FROM x ORDER BY asset_key, dist, caption_key""",
    "j4_three_tier_lookup": rf"""WITH {_KINDS}, w AS (SELECT asset_key, doc, page, asset_id, ordinal, {_NAME.format('doc')} AS stem FROM num WHERE kind = 'table'),
        t0 AS (SELECT DISTINCT rec_id, table_id, doc_stem, page_number FROM table_ocr WHERE rec_id IS NOT NULL), t AS (SELECT rec_id, table_id, doc_stem, page_number, row_number() OVER (PARTITION BY doc_stem, page_number ORDER BY rec_id) - 1 AS ordinal, {_NAME.format('doc_stem')} AS stem FROM t0),
        x AS (SELECT asset_key, (SELECT min(rec_id) FROM t WHERE t.doc_stem = w.doc AND t.page_number = w.page AND t.table_id = w.asset_id) AS k1, (SELECT min(rec_id) FROM t WHERE t.doc_stem = w.doc AND t.page_number = w.page AND t.ordinal = w.ordinal) AS k2, (SELECT min(rec_id) FROM t WHERE t.stem = w.stem) AS k3 FROM w)
        SELECT asset_key, coalesce(k1, k2, k3) AS d_key, CASE WHEN k1 IS NOT NULL THEN 1 WHEN k2 IS NOT NULL THEN 2 WHEN k3 IS NOT NULL THEN 3 END AS tier FROM x""",
    "o1_reading_order": f"""WITH {_KINDS}, pt AS (SELECT DISTINCT page_id, doc_stem, page_number FROM page_text WHERE page_id IS NOT NULL), s AS (SELECT coalesce(doc_stem, '?') AS doc, coalesce(page_number, 9999) AS page, 0.1 AS top, page_id AS seq, 'text' AS kind, NULL AS asset_key FROM pt
        UNION ALL SELECT doc, page, round(coalesce(y1 / nullif(ih, 0), 1), 6), (1::BIGINT << 40) + asset_key, kind, asset_key FROM ak) SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY page, top, seq) - 1 AS place, page, kind, asset_key FROM s""",
    "a16_type_counts": f"WITH {V.ASSETS} SELECT asset_type, validated_by, count(*) AS n, count(*) FILTER (has_caption) AS captioned FROM assets GROUP BY ALL",
    "j2_caption_words": f"""WITH {V.WORDS}, b AS (SELECT DISTINCT doc, page, 60 + 130 * (page % 9) AS b1, 300 + 130 * (page % 9) AS b2 FROM words)
        SELECT w.page AS box_key, string_agg(text, ' ' ORDER BY top, "left", word_idx) AS text, count(*) AS n_words FROM words w JOIN b ON w.doc = b.doc AND w.page = b.page
        WHERE text <> '' AND text <> '-1' AND width > 0 AND height > 0 AND greatest(least("left" + width, 420) - greatest("left", 100), 0) * greatest(least(top + height, b2) - greatest(top, b1), 0) >= 0.3 * width * height GROUP BY w.page""",
    "g3_iou_pairs": f"WITH {_IOU} SELECT image, class_id, det_id, gt_id, round(v, 6) AS iou FROM iou",
    "a13_prf_rollup": f"""WITH {_HIT}, u AS (SELECT p.class_id, CASE WHEN o.v >= 0.5 THEN 1 ELSE 0 END AS tp, CASE WHEN o.v >= 0.5 THEN 0 ELSE 1 END AS fp, 0 AS gt FROM pred p LEFT JOIN own o ON p.det_id = o.det_id UNION ALL SELECT class_id, 0, 0, 1 FROM truth),
        g AS (SELECT class_id, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(gt) - sum(tp) AS BIGINT) AS fn FROM u GROUP BY ROLLUP (class_id)), r AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p, coalesce(tp / nullif(tp + fn, 0), 0) AS rc FROM g)
        SELECT class_id, tp, fp, fn, round(p, 6) AS precision, round(rc, 6) AS recall, round(coalesce(2 * p * rc / nullif(p + rc, 0), 0), 6) AS f1 FROM r""",
    "j10_containment": f"WITH {_PRED} SELECT DISTINCT i.image, i.class_id, i.det_id FROM pred i JOIN pred o ON i.image = o.image AND o.class_id = 3 WHERE i.class_id = 5 AND greatest(least(i.x2, o.x2) - greatest(i.x1, o.x1), 0) * greatest(least(i.y2, o.y2) - greatest(i.y1, o.y1), 0) > 0.2 * (i.x2 - i.x1) * (i.y2 - i.y1)",
    "j10_with_parent": f"""WITH {_PRED} SELECT DISTINCT i.image, i.class_id, i.det_id FROM pred i JOIN pred o ON i.image = o.image AND o.class_id = 3 WHERE i.class_id = 5
        AND least(i.x2, o.x2) > greatest(i.x1, o.x1) AND least(i.y2, o.y2 + 0.15 * (o.y2 - o.y1)) > greatest(i.y1, o.y1 - 0.15 * (o.y2 - o.y1))""",
    "g4_near_captions": f"""WITH {V.ASSETS}, c AS (SELECT asset_key, CASE WHEN ih > 0 AND least(x2, caption_bbox[3]) - greatest(x1, caption_bbox[1]) >= 0.3 * (x2 - x1) THEN
        CASE WHEN caption_bbox[4] <= y1 THEN y1 - caption_bbox[4] WHEN caption_bbox[2] >= y2 THEN caption_bbox[2] - y2 ELSE 0 END / ih END AS v FROM assets WHERE caption_bbox IS NOT NULL)
        SELECT asset_key, CAST(round(v, 6) AS DOUBLE) AS distance, coalesce(v < 0.1, false) AS near FROM c""",
    "g2_page_sizes": f"""WITH {V.ASSETS}, o AS (SELECT doc, max(iw) AS dw, max(ih) AS dh FROM assets GROUP BY doc), x AS (SELECT asset_key, CASE WHEN asset_key % 3 <> 0 AND iw > 0 AND ih > 0 THEN 1 WHEN asset_key % 2 = 0 AND dw > 0 AND dh > 0 THEN 2 ELSE 3 END AS k, * EXCLUDE (asset_key) FROM assets JOIN o USING (doc))
        SELECT asset_key, CAST(CASE k WHEN 1 THEN iw WHEN 2 THEN dw ELSE greatest({V.PAGE_W}, coalesce(x2, 0)) END AS DOUBLE) AS width, CAST(CASE k WHEN 1 THEN ih WHEN 2 THEN dh ELSE greatest({V.PAGE_H}, coalesce(y2, 0)) END AS DOUBLE) AS height FROM x""",
    "class_threshold": f"WITH {_PRED} SELECT class_id, count(*) AS n FROM pred WHERE conf >= CASE class_id WHEN 3 THEN 0.5 WHEN 5 THEN 0.35 ELSE 0.25 END GROUP BY class_id",
    "a14_rarity": f"WITH {_TRUTH}, n AS (SELECT class_id, count(*) AS c FROM truth GROUP BY class_id) SELECT image, round(max(1 / c), 9) AS score FROM truth JOIN n ON truth.class_id = n.class_id GROUP BY image",
    "o4_stratified_split": f"WITH {_TRUTH}, n AS (SELECT count(DISTINCT image) AS c FROM truth) SELECT 'val' AS split, (c + 4) // 5 AS n FROM n UNION ALL SELECT 'train', c - (c + 4) // 5 FROM n",
    "j15_compare_runs": f"""WITH {_HIT}, n AS (SELECT image, count(*) AS gt FROM truth GROUP BY image), h AS (SELECT n.image, gt, count(v) FILTER (v >= 0.7) AS a, count(v) FILTER (v >= 0.5) AS b FROM n LEFT JOIN own ON n.image = own.image GROUP BY n.image, gt)
        SELECT CASE WHEN b > a THEN 'improved' ELSE 'same' END AS verdict, count(*) AS n, CAST(sum(3 * (b - a)) AS BIGINT) AS gain FROM h GROUP BY 1""",
    "a17_confusion": f"WITH {V.ASSETS} SELECT coalesce(has_caption, false) AS label, confidence >= 0.8 AS pred, count(*) AS n FROM assets WHERE confidence IS NOT NULL GROUP BY ALL",
    "a5_corr": f"""WITH {V.ASSETS}, x AS (SELECT CAST(has_caption AS INTEGER) AS l, confidence AS c, x2 - x1 AS w, y2 - y1 AS h FROM assets WHERE confidence IS NOT NULL AND has_caption IS NOT NULL)
        SELECT 'confidence' AS feature, round(corr(c, l), 6) AS corr, round(var_samp(c), 6) AS variance, var_samp(c) < 0.01 AS low_variance FROM x UNION ALL SELECT 'w', round(corr(w, l), 6), round(var_samp(w), 6), var_samp(w) < 0.01 FROM x
        UNION ALL SELECT 'h', round(corr(h, l), 6), round(var_samp(h), 6), var_samp(h) < 0.01 FROM x UNION ALL SELECT 'flat', NULL, 0.0, true""",
    "a10_vocabulary": f"""WITH {V.ASSETS}, w AS (SELECT coalesce(asset_type, '?') AS kind, unnest(regexp_split_to_array(lower(caption_text), '[^\\p{{L}}\\p{{N}}_]+')) AS word FROM assets WHERE caption_text IS NOT NULL),
        g AS (SELECT kind, word, count(*) AS n FROM w WHERE length(word) > 2 AND NOT regexp_full_match(word, '\\d+') AND word NOT IN ('the', 'and', 'for') GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY n DESC, word) AS rank FROM g) SELECT kind, word, n, rank FROM r WHERE rank <= 20""",
    "k9_presence": f"""WITH p AS (SELECT DISTINCT {_NAME.format('doc_stem')} AS stem FROM page_text WHERE doc_stem IS NOT NULL), a AS (SELECT DISTINCT {_NAME.format('doc_stem')} AS stem FROM detected_asset WHERE doc_stem IS NOT NULL), r AS (SELECT DISTINCT {_NAME.format('doc_stem')} AS stem FROM doc_register WHERE doc_stem IS NOT NULL)
        SELECT stem, stem IN (SELECT stem FROM p) AS has_pages, stem IN (SELECT stem FROM a) AS has_assets, stem IN (SELECT stem FROM r) AS in_register FROM (SELECT stem FROM p UNION SELECT stem FROM a UNION SELECT stem FROM r)""",
    "r4_caption_seq": f"WITH {_KINDS}, c AS (SELECT *, row_number() OVER (PARTITION BY doc, kind ORDER BY page, y1, x1, asset_key) AS n FROM ak WHERE has_caption) SELECT asset_key, upper(kind[1]) || substr(kind, 2) || ' ' || n || CASE WHEN caption_text IS NOT NULL THEN '. ' || caption_text ELSE '' END AS caption FROM c",
}
