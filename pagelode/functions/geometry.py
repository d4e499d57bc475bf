"""Bounding-box functions over struct<x0, y0, x1, y1: double> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(x0.cast("double").alias("x0"), y0.cast("double").alias("y0"), x1.cast("double").alias("x1"), y1.cast("double").alias("y1"))


def union(a: Column, b: Column) -> Column:
    return box(F.least(a["x0"], b["x0"]), F.least(a["y0"], b["y0"]), F.greatest(a["x1"], b["x1"]), F.greatest(a["y1"], b["y1"]))


def area(a: Column) -> Column:
    return F.greatest(F.lit(0.0), a["x1"] - a["x0"]) * F.greatest(F.lit(0.0), a["y1"] - a["y0"])


def intersection_area(a: Column, b: Column) -> Column:
    w = F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"])
    h = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
    return F.greatest(F.lit(0.0), w) * F.greatest(F.lit(0.0), h)


def center_inside(inner: Column, outer: Column) -> Column:
    cx, cy = (inner["x0"] + inner["x1"]) / 2, (inner["y0"] + inner["y1"]) / 2
    return (cx >= outer["x0"]) & (cx <= outer["x1"]) & (cy >= outer["y0"]) & (cy <= outer["y1"])


def covered_by(inner: Column, outer: Column, share: float = 0.35) -> Column:
    """Centre inside and more than ``share`` of its own area shared."""
    own = area(inner)
    return center_inside(inner, outer) & (own > 0) & (intersection_area(inner, outer) / F.when(own > 0, own) > share)


def _ratio(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    shorter = F.least(a1 - a0, b1 - b0)
    shared = F.least(a1, b1) - F.greatest(a0, b0)
    return F.when((shorter <= 0) | (shared <= 0), 0.0).otherwise(shared / F.when(shorter > 0, shorter))


def width_overlap(a: Column, b: Column) -> Column:
    """Shared width over the narrower width."""
    return _ratio(a["x0"], a["x1"], b["x0"], b["x1"])


def height_overlap(a: Column, b: Column) -> Column:
    return _ratio(a["y0"], a["y1"], b["y0"], b["y1"])


def adjacent_vertically(a: Column, b: Column, gap: float, least_width: float) -> Column:
    apart = F.greatest(a["y0"], b["y0"]) - F.least(a["y1"], b["y1"])
    return (apart <= gap) & (width_overlap(a, b) >= least_width)


def adjacent_horizontally(a: Column, b: Column, gap: float, least_height: float) -> Column:
    apart = F.greatest(a["x0"], b["x0"]) - F.least(a["x1"], b["x1"])
    return (apart <= gap) & (height_overlap(a, b) >= least_height)


def rows_overlap(a: Column, b: Column) -> Column:
    """Closed vertical intervals meet; touching edges count."""
    return (a["y0"] <= b["y1"]) & (b["y0"] <= a["y1"])


def expand_to_page(a: Column, width: Column) -> Column:
    return box(F.lit(0.0), a["y0"], width, a["y1"])
