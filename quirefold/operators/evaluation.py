"""Detection scoring: matching, fusion, suppression, precision and recall.

Predictions and truths come as rows (image, class_id, x1..y2) with an id each. Greedy steps depend on their order
and run by (image, class) or image as folds over sorted rows; confidence ties are broken by the id.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirefold.functions import geometry as G
from quirefold.operators.grouped import fold_groups


def iou_matrix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    w = np.minimum(a[:, None, 2], b[None, :, 2]) - np.maximum(a[:, None, 0], b[None, :, 0])
    h = np.minimum(a[:, None, 3], b[None, :, 3]) - np.maximum(a[:, None, 1], b[None, :, 1])
    i = np.clip(w, 0, None) * np.clip(h, 0, None)
    s = lambda x: np.clip(x[:, 2] - x[:, 0], 0, None) * np.clip(x[:, 3] - x[:, 1], 0, None)
    u = s(a)[:, None] + s(b)[None, :] - i
    return np.divide(i, u, out=np.zeros_like(i), where=u > 0)


_BOX = ["x1", "y1", "x2", "y2"]


def pair_iou(pred: DataFrame, truth: DataFrame, least: float = 0.0) -> DataFrame:
    """IoU of every prediction and truth of one image and class that meet at all."""
    t = truth.select("image", "class_id", "gt_id", *[F.col(c).cast("double").alias(f"t_{c}") for c in _BOX])
    return pred.join(t, ["image", "class_id"]).withColumn("iou", G.iou(G.box(), G.box("t_"))).filter((F.col("iou") > 0) & (F.col("iou") >= least)).select("image", "class_id", "det_id", "gt_id", F.round("iou", 6).alias("iou"))


def greedy_match(pred: DataFrame, truth: DataFrame, least: float = 0.5) -> DataFrame:
    """Predictions by falling confidence, each to its best truth still free: image, class_id, det_id, gt_id, tp.

    Only pairs that reach `least` are brought together; a prediction without one is no hit."""
    pairs = pair_iou(pred, truth, least).join(pred.select("image", "class_id", "det_id", "conf"), ["image", "class_id", "det_id"])

    def match(key, rows):
        used, done, out = set(), set(), []
        for det, gt, _iou, _conf in rows:
            if det not in done and gt not in used:
                used.add(gt)
                done.add(det)
                out.append((*key, det, gt))
        return out

    hit = fold_groups(pairs.select("image", "class_id", "det_id", "gt_id", "iou", "conf"), ["image", "class_id"], [F.desc("conf"), "det_id", F.desc("iou"), "gt_id"], match, "image string, class_id int, det_id long, gt_id long")
    return pred.select("image", "class_id", "det_id").join(hit, ["image", "class_id", "det_id"], "left").withColumn("tp", F.col("gt_id").isNotNull())


def precision_recall(matched: DataFrame, truth: DataFrame) -> DataFrame:
    """tp, fp, fn, precision, recall and F1 by class, and overall (class_id null) by rollup."""
    p = matched.select("class_id", F.col("tp").cast("int").alias("tp"), (~F.col("tp")).cast("int").alias("fp"), F.lit(0).alias("gt"))
    t = truth.select("class_id", F.lit(0).alias("tp"), F.lit(0).alias("fp"), F.lit(1).alias("gt"))
    g = p.unionByName(t).rollup("class_id").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), (F.sum("gt") - F.sum("tp")).alias("fn"))
    div = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    pr, rc = div(F.col("tp"), F.col("tp") + F.col("fp")), div(F.col("tp"), F.col("tp") + F.col("fn"))
    return g.select("class_id", "tp", "fp", "fn", F.round(pr, 6).alias("precision"), F.round(rc, 6).alias("recall"), F.round(div(2 * pr * rc, pr + rc), 6).alias("f1"))


def fuse(pred: DataFrame, n_models: int, least: float = 0.55) -> DataFrame:
    """Weighted box fusion by image and class: boxes by falling confidence join the first cluster whose fused box
    they meet over `least`; coordinates are weighted by confidence, which is scaled by how many models agree."""

    def run(key, rows):
        clusters: list[list] = []
        fused: list[list[float]] = []
        for *b, conf, _det in rows:
            at = -1
            if fused:
                m = iou_matrix(np.array([b], float), np.array(fused))[0]
                k = int(m.argmax())
                at = k if m[k] > least else -1
            if at < 0:
                clusters.append([(conf, b)])
                fused.append(list(map(float, b)))
            else:
                clusters[at].append((conf, b))
                c = np.array([x[0] for x in clusters[at]])
                if c.sum():
                    fused[at] = ((c[:, None] * np.array([x[1] for x in clusters[at]])).sum(0) / c.sum()).tolist()
        return [(*key, i, *f, sum(x[0] for x in c) / len(c) * min(len(c), n_models) / n_models, len(c)) for i, (c, f) in enumerate(zip(clusters, fused))]

    x = pred.select("image", "class_id", *[F.col(c).cast("double").alias(c) for c in _BOX], "conf", "det_id")
    return fold_groups(x, ["image", "class_id"], [F.desc("conf"), "det_id"], run, "image string, class_id int, fused_id int, x1 double, y1 double, x2 double, y2 double, conf double, n_fused int")


def suppress(pred: DataFrame, least: float = 0.6, exempt: tuple[tuple[int, int], ...] = ()) -> DataFrame:
    """Across classes, by falling confidence: a box that meets a kept one at `least` is dropped, unless the two
    classes are an exempt pair."""
    pairs = {frozenset(p) for p in exempt}

    def run(key, rows):
        b = np.array([r[:4] for r in rows], float)
        kept: list[int] = []
        for i, r in enumerate(rows):
            if kept:
                m = iou_matrix(b[i : i + 1], b[kept])[0]
                if any(m[j] >= least and frozenset((r[4], rows[k][4])) not in pairs for j, k in enumerate(kept)):
                    continue
            kept.append(i)
        return [(key[0], rows[i][4], rows[i][6]) for i in kept]

    x = pred.select("image", *[F.col(c).cast("double").alias(c) for c in _BOX], "class_id", "conf", "det_id")
    return fold_groups(x, ["image"], [F.desc("conf"), "det_id"], run, "image string, class_id int, det_id long")


def dedup(pred: DataFrame, least: float = 0.8) -> DataFrame:
    """Boxes that meet no kept one of their class over `least`, by the order of their ids: image, class_id, det_id."""

    def run(key, rows):
        b = np.array([r[:4] for r in rows], float)
        kept: list[int] = []
        for i in range(len(rows)):
            if not kept or not (iou_matrix(b[i : i + 1], b[kept])[0] > least).any():
                kept.append(i)
        return [(*key, rows[i][4]) for i in kept]

    x = pred.select("image", "class_id", *[F.col(c).cast("double").alias(c) for c in _BOX], "det_id")
    return fold_groups(x, ["image", "class_id"], ["det_id"], run, "image string, class_id int, det_id long")


def contained(pred: DataFrame, inner: int, outer: int, share: float = 0.8) -> DataFrame:
    """Boxes of class `inner` that lie over `share` of their area in one of class `outer` of their image."""
    o = pred.filter(F.col("class_id") == outer).select("image", *[F.col(c).alias(f"o_{c}") for c in _BOX])
    i = pred.filter(F.col("class_id") == inner)
    return i.join(o, "image").filter(G.overlap(G.box(), G.box("o_")) > share * G.area(G.box())).select("image", "class_id", "det_id").distinct()


def with_parent(pred: DataFrame, captions: list[int], parents: list[int], reach: float = 0.15) -> DataFrame:
    """Boxes of the classes `captions` that touch one of the classes `parents` of their image, made taller by
    `reach` of its height both ways. The others are orphans."""
    tall = (F.col("y2") - F.col("y1")) * reach
    o = pred.filter(F.col("class_id").isin(parents)).select("image", F.col("x1").alias("o_x1"), (F.col("y1") - tall).alias("o_y1"), F.col("x2").alias("o_x2"), (F.col("y2") + tall).alias("o_y2"))
    i = pred.filter(F.col("class_id").isin(captions))
    return i.join(o, "image").filter(G.overlap(G.box(), G.box("o_")) > 0).select("image", "class_id", "det_id").distinct()


def rarity(labels: DataFrame) -> DataFrame:
    """Score of an image: that of its rarest class, one over the class's count."""
    n = labels.groupBy("class_id").agg(F.count("*").alias("class_n"))
    return labels.join(F.broadcast(n), "class_id").groupBy("image").agg(F.round(F.max(1 / F.col("class_n")), 9).alias("score"))


def stratified_split(scores: DataFrame, every: int, seed: int = 42) -> DataFrame:
    """Every n-th image by falling rarity goes to validation; equal scores in seeded order. Ranks are made by score
    groups, so no sort of all rows in one task is needed."""
    from pyspark.sql import Window

    h = F.xxhash64("image", F.lit(seed))
    groups = scores.groupBy("score").agg(F.count("*").alias("n"))
    heads = groups.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")  # one row a class count
    x = scores.join(F.broadcast(heads), "score").withColumn("rank", F.col("before") + F.row_number().over(Window.partitionBy("score").orderBy(h, "image")) - 1)
    return x.select("image", "score", F.when(F.pmod("rank", F.lit(every)) == 0, "val").otherwise("train").alias("split"))


def compare_runs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per image the gain of run b over run a: more hits, fewer false ones, fewer misses. Both: image, tp, fp, fn."""
    x = a.join(b.select("image", *[F.col(c).alias(f"b_{c}") for c in ("tp", "fp", "fn")]), "image")
    delta = (F.col("b_tp") - F.col("tp")) - (F.col("b_fp") - F.col("fp")) - (F.col("b_fn") - F.col("fn"))
    return x.select("image", delta.alias("delta"), F.when(delta > 0, "improved").when(delta < 0, "regressed").otherwise("same").alias("verdict"))


def confusion(df: DataFrame) -> DataFrame:
    """label, pred and their count."""
    return df.groupBy("label", "pred").agg(F.count("*").alias("n"))


def correlations(df: DataFrame, label: str, columns: list[str]) -> DataFrame:
    """Pearson correlation of the label with each column that varies, sample variance, and whether that is low."""
    y = F.col(label).cast("double")

    def pearson(x):
        # by co-variance and deviations, as a column that doesn't vary has none
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

    parts = [F.struct(F.lit(c).alias("feature"), pearson(F.col(c).cast("double")).alias("corr"), F.var_samp(c).alias("variance")) for c in columns]
    one = df.agg(F.array(*parts).alias("a")).select(F.explode("a").alias("x"))
    return one.select("x.feature", F.round("x.corr", 6).alias("corr"), F.round("x.variance", 6).alias("variance"), (F.col("x.variance") < 0.01).alias("low_variance"))


def vocabulary(df: DataFrame, text: str, label: str, top: int = 20, stop: tuple[str, ...] = ()) -> DataFrame:
    """The most frequent words (over two letters, no numbers) of each label; ties by the word."""
    from pyspark.sql import Window

    w = df.select(label, F.explode(F.split(F.lower(text), r"[^\p{L}\p{N}_]+")).alias("word")).filter((F.length("word") > 2) & ~F.col("word").rlike(r"^\d+$") & ~F.col("word").isin(*stop))
    g = w.groupBy(label, "word").agg(F.count("*").alias("n"))
    return g.withColumn("rank", F.row_number().over(Window.partitionBy(label).orderBy(F.desc("n"), "word"))).filter(F.col("rank") <= top)
