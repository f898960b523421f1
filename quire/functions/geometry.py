"""Boxes struct(x1, y1, x2, y2) and their reading order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def clamp(value: Column, low: Column, high: Column) -> Column:
    return F.greatest(low, F.least(value, high))


def area(b: Column) -> Column:
    return (b["x2"] - b["x1"]) * (b["y2"] - b["y1"])


def overlap(a: Column, b: Column) -> Column:
    """Area that two boxes share."""
    side = lambda low, high: F.greatest(F.least(a[high], b[high]) - F.greatest(a[low], b[low]), F.lit(0))
    return side("x1", "x2") * side("y1", "y2")


def iou(a: Column, b: Column) -> Column:
    """Shared area over joint area; 0.0 for boxes without area."""
    both = overlap(a, b)
    joint = area(a) + area(b) - both
    return F.when(joint != 0, both / joint).otherwise(F.lit(0.0))


def covers(outer: Column, inner: Column, slack: int) -> Column:
    """Whether outer reaches inner's edges on every side, give or take slack."""
    return (outer["x1"] <= inner["x1"] + slack) & (outer["y1"] <= inner["y1"] + slack) & (outer["x2"] >= inner["x2"] - slack) & (outer["y2"] >= inner["y2"] - slack)


def contained(found: Column, inner: Column, outer: Column, slack_inner: int = 15, slack_outer: int = 55) -> Column:
    """struct(covers_min, within_max) of a found box against the least and the largest that is right."""
    return F.struct(covers(found, inner, slack_inner).alias("covers_min"), covers(outer, found, slack_outer).alias("within_max"))


def halves(width: Column, height: Column) -> Column:
    """Two columns with margins of 2 and 1 % and a gutter of 2 %; whole numbers."""
    mx, my = F.rint(width * 0.02).cast("long"), F.rint(height * 0.01).cast("long")
    mid, gap = F.floor(width / 2), F.floor(mx / 2)
    return F.array(box(mx, my, mid - gap, height - my), box(mid + gap, my, width - mx, height - my))


def region_types(count: Column) -> Column:
    """Two boxes are left and right; any other number are single ones."""
    return F.when(count == 2, F.array(F.lit("left"), F.lit("right"))).otherwise(F.array_repeat(F.lit("single"), count.cast("int")))


def reading_order(boxes: Column) -> Column:
    """Boxes (struct with x1, y1, y2) by band from above, within a band from the left.

    From above, a box joins the first band that it overlaps by more than half of the lower of both heights; others
    open a band. Ties keep their order."""
    none = F.filter(F.transform(boxes, lambda b: F.struct(b["y1"].alias("top"), b["y2"].alias("low"), F.array(b).alias("of"))), lambda b: F.lit(False))
    by_top = F.transform(F.array_sort(F.transform(boxes, lambda b, i: F.struct(b["y1"].alias("y"), i.alias("i"), b.alias("b")))), lambda x: x["b"])

    def place(bands: Column, b: Column) -> Column:
        meets = lambda x: F.least(b["y2"], x["low"]) - F.greatest(b["y1"], x["top"]) > 0.5 * F.least(b["y2"] - b["y1"], x["low"] - x["top"])
        at = F.array_position(F.transform(bands, meets), True)
        grown = F.transform(bands, lambda x, i: F.when(i + 1 == at, F.struct(F.least(x["top"], b["y1"]).alias("top"), F.greatest(x["low"], b["y2"]).alias("low"), F.concat(x["of"], F.array(b)).alias("of"))).otherwise(x))
        return F.when(at > 0, grown).otherwise(F.concat(bands, F.array(F.struct(b["y1"].alias("top"), b["y2"].alias("low"), F.array(b).alias("of")))))

    bands = F.aggregate(by_top, none, place)
    keyed = lambda items, key: F.transform(F.array_sort(F.transform(items, lambda x, i: F.struct(x[key].alias("k"), i.alias("i"), x.alias("x")))), lambda x: x["x"])
    return F.flatten(F.transform(keyed(bands, "top"), lambda band: keyed(band["of"], "x1")))
