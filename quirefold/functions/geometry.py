"""Boxes as column expressions. A box is four columns: left, top, right, bottom (x1, y1, x2, y2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = Sequence[Column]


def area(b: Box) -> Column:
    return F.greatest(b[2] - b[0], F.lit(0.0)) * F.greatest(b[3] - b[1], F.lit(0.0))


def overlap(a: Box, b: Box) -> Column:
    return F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0)) * F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0.0))


def iou(a: Box, b: Box) -> Column:
    """Intersection over union; 0 where there is no area at all or a coordinate is null."""
    i = overlap(a, b)
    return F.coalesce(F.try_divide(i, area(a) + area(b) - i), F.lit(0.0))


#: How much of an asset's width a caption must share, and how far from it, in parts of the page, it may be.
SHARED_WIDTH, NEAR_HEIGHT = 0.3, 0.10


def distance(asset: Box, caption: Box, page_height: Column) -> Column:
    """How far a caption lies above or below an asset, in parts of the page's height (0 where they overlap); null where it
    shares too little of the asset's width, or without a page height."""
    beside = F.least(asset[2], caption[2]) - F.greatest(asset[0], caption[0]) < SHARED_WIDTH * (asset[2] - asset[0])
    gap = F.greatest(asset[1] - caption[3], caption[1] - asset[3], F.lit(0.0))
    return F.when(~beside & (page_height > 0), gap / page_height)


def near(asset: Box, caption: Box, page_height: Column) -> Column:
    """Whether a caption is near enough to an asset to belong to it; false where a coordinate is null."""
    return F.coalesce(distance(asset, caption, page_height) < NEAR_HEIGHT, F.lit(False))


def page_size(width: Column, height: Column, boxes: Box, default: tuple[float, float], *sources: tuple[Column, Column]) -> tuple[Column, Column]:
    """A page's width and height: its own, else those of the first further source that has both above 0, else a default
    that holds its boxes."""
    w, h = default
    both = [(width, height), *sources]
    pick = lambda i, least, edge: F.coalesce(*[F.when((s[0] > 0) & (s[1] > 0), s[i].cast("double")) for s in both], F.greatest(F.lit(float(least)), F.coalesce(edge.cast("double"), F.lit(0.0))))
    return pick(0, w, boxes[2]), pick(1, h, boxes[3])


def corners(cx: Column, cy: Column, w: Column, h: Column) -> list[Column]:
    return [cx - w / 2, cy - h / 2, cx + w / 2, cy + h / 2]


def box(prefix: str = "") -> list[Column]:
    return [F.col(f"{prefix}{c}") for c in ("x1", "y1", "x2", "y2")]
