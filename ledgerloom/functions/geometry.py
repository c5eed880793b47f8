"""Boxes with a top-left origin, as columns: structs of l, t, r, b."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(left: Column, top: Column, right: Column, bottom: Column) -> Column:
    return F.struct(left.alias("l"), top.alias("t"), right.alias("r"), bottom.alias("b"))


def area(b: Column) -> Column:
    """The area of a box, 1 at least."""
    return F.greatest(F.lit(1.0), (b["r"] - b["l"]) * (b["b"] - b["t"]))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union (OP-V2): 0 unless the boxes overlap, areas floored at 1; null if one is null."""
    w = F.least(a["r"], b["r"]) - F.greatest(a["l"], b["l"])
    h = F.least(a["b"], b["b"]) - F.greatest(a["t"], b["t"])
    inter = w * h
    whole = a["l"]  # a sum is null if a side is; least and greatest would pass over it
    for c in (a["t"], a["r"], a["b"], b["l"], b["t"], b["r"], b["b"]):
        whole = whole + c
    return F.when(whole.isNotNull(), F.when((w > 0) & (h > 0), inter / (area(a) + area(b) - inter)).otherwise(0.0))


def merged(c: str) -> Column:
    """Aggregate: the box around all boxes (OP-V3)."""
    return F.struct(F.min(f"{c}.l").alias("l"), F.min(f"{c}.t").alias("t"), F.max(f"{c}.r").alias("r"), F.max(f"{c}.b").alias("b"))


def polygon_box(points: Column) -> Column:
    """The box of an array of [x, y] points, cut to whole numbers (OP-O8, OP-O9)."""
    x, y = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    cut = lambda c: c.cast("int").cast("double")
    return box(cut(F.array_min(x)), cut(F.array_min(y)), cut(F.array_max(x)), cut(F.array_max(y)))


def crop_box(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column, left: Column, top: Column) -> Column:
    """A box in shares of a crop as a box on the page, whole numbers within the crop (OP-O7)."""
    cut = lambda share, size, offset: (share * size).cast("int") + offset
    return box(cut(x0, width, left), cut(y0, height, top), cut(x1, width, left), cut(y1, height, top))


def scaled(b: Column, factor: float) -> Column:
    """A box at another scale (OP-C7)."""
    return box(*(b[k] * F.lit(float(factor)) for k in ("l", "t", "r", "b")))
