"""Column builders for boxes: struct<left, bottom, right, top>, where top grows down the page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def width(box: Column) -> Column:
    return F.greatest(F.lit(0.0), box["right"] - box["left"])


def height(box: Column) -> Column:
    return F.greatest(F.lit(0.0), box["top"] - box["bottom"])


def area(box: Column) -> Column:
    return width(box) * height(box)


def overlap(a: Column, b: Column) -> Column:
    """Area of the intersection."""
    across = F.least(a["right"], b["right"]) - F.greatest(a["left"], b["left"])
    down = F.least(a["top"], b["top"]) - F.greatest(a["bottom"], b["bottom"])
    return F.greatest(F.lit(0.0), across) * F.greatest(F.lit(0.0), down)


def iou(a: Column, b: Column) -> Column:
    both = overlap(a, b)
    total = area(a) + area(b) - both
    return F.when(total > 0, both / total).otherwise(0.0)


def contains(outer: Column, inner: Column, tolerance: float = 0.5) -> Column:
    return (
        (inner["left"] >= outer["left"] - tolerance)
        & (inner["bottom"] >= outer["bottom"] - tolerance)
        & (inner["right"] <= outer["right"] + tolerance)
        & (inner["top"] <= outer["top"] + tolerance)
    )


def same_row(label: Column, value: Column) -> Column:
    """The value shares at least half of the lower height with the label and starts no more than 8 px inside it.

    A box without height is on no row.
    """
    shared = F.least(label["top"], value["top"]) - F.greatest(label["bottom"], value["bottom"])
    lower = F.least(height(label), height(value))
    return (lower > 0) & (shared >= 0.5 * lower) & (value["left"] >= label["right"] - 8)


def aligned(a: Column, b: Column) -> Column:
    """Two views of one line: IoU and overlap of 0.8, like width, height and left edge."""
    smaller = F.least(area(a), area(b))
    return (
        (iou(a, b) >= 0.8)
        & (F.when(smaller > 0, overlap(a, b) / smaller).otherwise(0.0) >= 0.8)
        & (width(b) / width(a)).between(0.85, 1.15)
        & (height(b) / height(a)).between(0.75, 1.25)
        & (F.abs(a["left"] - b["left"]) <= F.greatest(F.lit(8.0), 0.25 * height(a)))
    )


def union_of(box: str) -> Column:
    """Aggregate: the smallest box around all boxes of a group."""
    return F.struct(F.min(f"{box}.left").alias("left"), F.min(f"{box}.bottom").alias("bottom"), F.max(f"{box}.right").alias("right"), F.max(f"{box}.top").alias("top"))


def render_scale(width_pt: Column, height_pt: Column, dpi: int, max_pixels: int) -> Column:
    """Pixels a point: dpi/72 unless the page would exceed the pixel budget."""
    plain = F.lit(dpi / 72)
    return F.when(width_pt * height_pt * plain * plain <= max_pixels, plain).otherwise(F.sqrt(F.lit(max_pixels) / (width_pt * height_pt)))
