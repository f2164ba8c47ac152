"""Box arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), w.alias("w"), h.alias("h"))


def to_xywh(points: Column) -> Column:
    """Smallest box around an ``array<struct<x,y>>``."""
    xs = F.transform(points, lambda p: p["x"].cast("int"))
    ys = F.transform(points, lambda p: p["y"].cast("int"))
    left, top = F.array_min(xs), F.array_min(ys)
    return box(left, top, F.array_max(xs) - left, F.array_max(ys) - top)


def corners(b: Column) -> Column:
    """The four corner points of a box, clockwise from the top left."""
    right, bottom = b["x"] + b["w"], b["y"] + b["h"]
    return F.array(*[
        F.struct(x.alias("x"), y.alias("y"))
        for x, y in ((b["x"], b["y"]), (right, b["y"]), (right, bottom), (b["x"], bottom))
    ])


def center(b: Column) -> Column:
    return F.struct((b["x"] + b["w"] / 2).alias("cx"), (b["y"] + b["h"] / 2).alias("cy"))


def merge_boxes(x: Column, y: Column, w: Column, h: Column) -> Column:
    """A4, as an aggregate: the box around all boxes of a group."""
    left, top = F.min(x), F.min(y)
    return box(left, top, F.max(x + w) - left, F.max(y + h) - top)
