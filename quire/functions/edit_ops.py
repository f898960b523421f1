"""Edit distances and alignments; the rows of their tables are whole numbers, a bit for each character."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

COUNTS = StructType([StructField(n, IntegerType()) for n in ("n_sub", "n_del", "n_ins")])


def _places(text: str) -> dict[str, int]:
    """The places of each character of a text, as bits."""
    at: dict[str, int] = {}
    for i, c in enumerate(text):
        at[c] = at.get(c, 0) | 1 << i
    return at


def _next(up: int, down: int, same: int, mask: int) -> tuple[int, int, int]:
    """(up, down, more) of the next row of the table: the places where a row rises and falls, as bits, and those where
    it exceeds the row above (Myers 1999, Hyyrö 2003). The places of the row's character are given as bits, too."""
    cross = ((same & up) + up ^ up) | same
    more, less = down | mask & ~(cross | up), up & cross
    shifted, level = more << 1 | 1, same | down
    return (less << 1 | ~(level | shifted)) & mask, shifted & level & mask, more & mask


def distance(ref: str, hyp: str) -> int:
    """Code-point edit distance."""
    if ref == hyp:
        return 0
    if len(ref) < len(hyp):
        ref, hyp = hyp, ref
    at, mask = _places(hyp), (1 << len(hyp)) - 1
    up, down, places = mask, 0, at.get
    for c in ref:
        up, down, _ = _next(up, down, places(c, 0), mask)
    return len(ref) + up.bit_count() - down.bit_count()


def count_edits(ref: str, hyp: str) -> tuple[int, int, int]:
    """(substitutions, deletions, insertions) of a shortest alignment, walked back with gaps before pairs.

    Every step-th row of the table is held and those between are computed again, so that long texts fit."""
    ref, hyp = ref.strip(), hyp.strip()
    if ref == hyp:
        return 0, 0, 0
    at, mask = _places(hyp), (1 << len(hyp)) - 1
    step = max(256, math.isqrt(len(ref)) + 1)

    def rows(low: int) -> list[tuple[int, int, int]]:
        """The rows behind a held one, up to the next."""
        up, down = held[low // step]
        out = []
        for c in ref[low : low + step]:
            up, down, more = _next(up, down, at.get(c, 0), mask)
            out.append((up, down, more))
        return out

    held, table, low = [(mask, 0)], [], 0
    for low in range(0, len(ref), step):
        table = rows(low)
        held.append(table[-1][:2])
    i, j, s, d, n = len(ref), len(hyp), 0, 0, 0
    while i and j:
        if i == low:
            low -= step
            table = rows(low)
        up, _, more = table[i - low - 1]
        if more >> j - 1 & 1:
            i, d = i - 1, d + 1
        elif up >> j - 1 & 1:
            j, n = j - 1, n + 1
        else:
            i, j, s = i - 1, j - 1, s + (ref[i - 1] != hyp[j - 1])
    return s, d + i, n + j


@F.pandas_udf(IntegerType())
def edit_distance(ref: pd.Series, hyp: pd.Series) -> pd.Series:
    return pd.Series([None if r is None or h is None else distance(r, h) for r, h in zip(ref, hyp)], dtype="Int32")


@F.pandas_udf(COUNTS)
def edit_counts(ref: pd.Series, hyp: pd.Series) -> pd.DataFrame:
    rows = [count_edits(r or "", h or "") for r, h in zip(ref, hyp)]
    return pd.DataFrame(rows, columns=["n_sub", "n_del", "n_ins"], dtype="int32")
