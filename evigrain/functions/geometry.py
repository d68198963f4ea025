"""Boxes struct<x0,y0,x1,y1> in page units 0 to 1."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(x0.cast("double").alias("x0"), y0.cast("double").alias("y0"), x1.cast("double").alias("x1"), y1.cast("double").alias("y1"))


def normalised(x: Column, y: Column, w: Column, h: Column, page_w: Column, page_h: Column) -> Column:
    """A box in points as shares of the page, clamped; null if nothing is left."""
    clamp = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    x0, y0, x1, y1 = clamp(x / page_w), clamp(y / page_h), clamp((x + w) / page_w), clamp((y + h) / page_h)
    return F.when((x1 > x0) & (y1 > y0), box(x0, y0, x1, y1))


def is_valid(b: Column) -> Column:
    return (b["x0"] >= 0) & (b["x0"] < b["x1"]) & (b["x1"] <= 1) & (b["y0"] >= 0) & (b["y0"] < b["y1"]) & (b["y1"] <= 1)


def area(b: Column) -> Column:
    return (b["x1"] - b["x0"]) * (b["y1"] - b["y0"])


def iou(a: Column, b: Column) -> Column:
    w = F.greatest(F.lit(0.0), F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]))
    h = F.greatest(F.lit(0.0), F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]))
    union = area(a) + area(b) - w * h
    return F.when(union > 0, w * h / F.when(union > 0, union)).otherwise(F.lit(0.0))


def intersect(a: Column, b: Column) -> Column:
    """Whether boxes share an area; touching edges do not count."""
    return (a["x0"] < b["x1"]) & (b["x0"] < a["x1"]) & (a["y0"] < b["y1"]) & (b["y0"] < a["y1"])


def union_of(boxes: Column) -> Column:
    low = lambda f: F.array_min(F.transform(boxes, lambda b: b[f]))
    high = lambda f: F.array_max(F.transform(boxes, lambda b: b[f]))
    return box(low("x0"), low("y0"), high("x1"), high("y1"))


def crop(b: Column, page_w_px: Column, page_h_px: Column, padding: float, least_px: int) -> Column:
    """A box centred on b, padded on each side, at least least_px wide and high, shifted into the page."""

    def side(lo: Column, hi: Column, px: Column):
        size = F.least(F.lit(1.0), F.greatest((hi - lo) * (1 + 2 * padding), F.lit(float(least_px)) / px))
        start = F.least(F.greatest((lo + hi) / 2 - size / 2, F.lit(0.0)), 1.0 - size)
        return start, start + size

    (x0, x1), (y0, y1) = side(b["x0"], b["x1"], page_w_px), side(b["y0"], b["y1"], page_h_px)
    return box(x0, y0, x1, y1)
