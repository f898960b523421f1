"""Lines within a profile of darkness by row, on arrays; no Python workers.

Rows darker than a share of the darkest form runs. A run that is much taller than the median is cut at the troughs
of the smoothed profile near the places where lines of that height would meet.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

LEAST_HEIGHT, THRESHOLD, SMOOTH, TALL, TROUGH = 5, 0.02, 7, 1.6, 0.6


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _between(a: Column, low: Column, high: Column) -> Column:
    """The items from low up to high, high not included."""
    return F.slice(a, low + 1, F.greatest(high - low, F.lit(0)))


def smooth(profile: Column, width: int = SMOOTH) -> Column:
    """Centred moving average of the full width; places beyond the ends count as zero."""
    half = width // 2
    mean = lambda i: F.aggregate(_between(profile, F.greatest(i - half, F.lit(0)), i + half + 1), F.lit(0.0), lambda s, x: s + x) / width
    return F.transform(profile, lambda _, i: mean(i))


def runs(profile: Column, threshold: Column, least: int = LEAST_HEIGHT) -> Column:
    """array<struct(top, bottom)>: maximal runs above the threshold, least rows high or more; bottom is behind the last row."""
    n = F.size(profile)
    on = F.transform(profile, lambda x: x > threshold)
    starts = F.filter(F.transform(on, lambda x, i: F.when(x & ~F.coalesce(F.get(on, i - 1), F.lit(False)), i)), lambda x: x.isNotNull())
    ends = F.filter(F.transform(on, lambda x, i: F.when(x & ~F.coalesce(F.get(on, i + 1), F.lit(False)), i + 1)), lambda x: x.isNotNull())
    found = F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("top"), b.alias("bottom")))
    return F.when(n > 0, F.filter(found, lambda r: r["bottom"] - r["top"] >= least))


def median(values: Column) -> Column:
    s = F.array_sort(values)
    at = lambda i: F.get(s, F.floor(i).cast("int"))
    return (at((F.size(s) - 1) / 2) + at(F.size(s) / 2)) / 2


def trough_ratio(smoothed: Column, top: Column, cut: Column, bottom: Column) -> Column:
    """Depth of a cut: its value over the lower of the peaks on both sides; 1.0 without peaks."""
    own = F.get(smoothed, cut)
    flank = F.least(F.coalesce(F.array_max(_between(smoothed, top, cut)), own), F.coalesce(F.array_max(_between(smoothed, cut, bottom)), own))
    return F.when(flank > 0, own / flank).otherwise(1.0)


def _cuts(run: Column, smoothed: Column, height: Column) -> Column:
    """Deep enough troughs near the expected meetings, in order, each once."""
    tall = run["bottom"] - run["top"]
    pieces = F.greatest(F.lit(2), F.rint(tall / height).cast("int"))

    def cut(k: Column) -> Column:
        centre = run["top"] + F.rint(k * tall / pieces).cast("int")
        low, high = F.greatest(run["top"] + LEAST_HEIGHT, centre - LEAST_HEIGHT), F.least(run["bottom"] - LEAST_HEIGHT, centre + LEAST_HEIGHT)
        part = _between(smoothed, low, high)
        return F.when(low < high, low + F.array_position(part, F.array_min(part)).cast("int") - 1)

    found = F.transform(F.sequence(F.lit(1), pieces - 1), cut)
    return F.array_sort(F.array_distinct(F.filter(found, lambda c: c.isNotNull() & (trough_ratio(smoothed, run["top"], c, run["bottom"]) < TROUGH))))


def _pieces(run: Column, cuts: Column) -> Column:
    """The run cut apart; a cut that would leave a piece too low is left out."""
    start = F.array(run["top"])
    taken = F.aggregate(cuts, start, lambda a, c: F.when(c - F.element_at(a, -1) >= LEAST_HEIGHT, F.concat(a, F.array(c))).otherwise(a))
    kept = _let(taken, lambda a: F.when((F.size(a) > 1) & (run["bottom"] - F.element_at(a, -1) < LEAST_HEIGHT), F.slice(a, 1, F.size(a) - 1)).otherwise(a))
    return _let(kept, lambda a: F.transform(a, lambda top, i: F.struct(top.alias("top"), F.coalesce(F.get(a, i + 1), run["bottom"]).alias("bottom"))))


def line_boundaries(profile: Column) -> Column:
    """array<struct(top, bottom)> of the lines; empty for a profile that is empty or nowhere dark."""
    none = F.array().cast("array<struct<top:int,bottom:int>>")
    found = _let(runs(profile, F.array_max(profile) * THRESHOLD), lambda rs: _let(median(F.transform(rs, lambda r: (r["bottom"] - r["top"]).cast("double"))), lambda height: _let(smooth(profile), lambda s: F.flatten(F.transform(rs, lambda r: F.when((height > 0) & (r["bottom"] - r["top"] > TALL * height), _pieces(r, _cuts(r, s, height))).otherwise(F.array(r)))))))
    return F.coalesce(F.when(F.array_max(profile) > 0, found), none)
