"""Substring dedup on bytes by a hash-compared suffix sort.

Suffixes are sorted by mergesort. A comparison finds the common extension of two suffixes by binary search
over prefix polynomial hashes, then compares the byte behind it: logarithmic in the window. Then the bytes of
all neighbours are compared: they tell which are equal, and whether a collision has misplaced any, in which
case the suffixes of that block are sorted by their bytes. Suffixes are those that share an anchor (windows.py).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import windows
from .common import small_batches

KGRAM = 16
BASE = 0x9E3779B97F4A7C15
#: Neighbours whose bytes are compared at a time.
COMPARED = 20_000


def parse(column: pa.Array) -> windows.Tokens:
    """The bytes of each text."""
    data, offsets = windows.texts_of(column)
    held = data.tobytes()
    return windows.Tokens(data, offsets, lambda first, last: [held[i : j + 1] for i, j in zip(first.tolist(), last.tolist())])


class HashedText:
    """A text of bytes and its prefix polynomial hashes modulo 2**64 (of mixed byte values)."""

    def __init__(self, data: bytes):
        self.data = np.frombuffer(data, np.uint8)
        n = len(self.data)
        powers = np.full(n + 1, BASE, np.uint64)
        powers[0] = 1
        self.powers = np.multiply.accumulate(powers)
        values = windows.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
        self.prefix = np.r_[np.uint64(0), np.cumsum(values[self.data] * self.powers[:n], dtype=np.uint64)]

    def same(self, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the hashes of length bytes at i and j agree; the earlier one is scaled up to the later."""
        a, b = np.minimum(i, j), np.maximum(i, j)
        return (self.prefix[a + length] - self.prefix[a]) * self.powers[b - a] == self.prefix[b + length] - self.prefix[b]

    def whole(self, i: np.ndarray, length: int) -> np.ndarray:
        """The hashes of length bytes at i, scaled up to the end of the text: equal where same() holds."""
        return (self.prefix[i + length] - self.prefix[i]) * self.powers[len(self.data) - i]

    def extension(self, i: np.ndarray, j: np.ndarray, most: int) -> np.ndarray:
        """Common bytes at i and j, up to most, by binary search; both have most bytes."""
        low, high = np.zeros(len(i), np.int64), np.full(len(i), most, np.int64)
        while (low < high).any():
            middle = (low + high + 1) // 2
            equal = self.same(i, j, middle)
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        return low

    def before(self, i: np.ndarray, j: np.ndarray, most: int, ties: np.ndarray) -> np.ndarray:
        """Whether suffix i sorts before suffix j by its first most bytes; ties says what equal ones count as."""
        common = self.extension(i, j, most)
        at = np.minimum(common, most - 1)
        return np.where(common == most, ties, self.data[i + at] < self.data[j + at])


def suffix_sort(text: HashedText, starts: np.ndarray, blocks: np.ndarray, most: int) -> np.ndarray:
    """Places of starts, sorted by block and then by suffix, stably: bottom-up mergesort, all merges of a level at once.

    blocks don't fall. A run's element moves to its own place plus its rank in the sibling run, found by
    binary search with hashed comparisons; runs never cross a block."""
    n = len(starts)
    order = np.arange(n)
    first = np.r_[0, np.flatnonzero(blocks[1:] != blocks[:-1]) + 1] if n else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[first, n])
    base, size = np.repeat(first, sizes), np.repeat(sizes, sizes)
    place = np.arange(n) - base
    run = 1
    while run < (sizes.max() if n else 0):
        pair = place // (2 * run) * (2 * run)
        left = place - pair < run
        low = np.where(left, np.minimum(pair + run, size), pair)
        begin, high = low.copy(), np.where(left, np.minimum(pair + 2 * run, size), pair + run)
        while len(open_ := np.flatnonzero(low < high)):
            middle = (low[open_] + high[open_]) // 2
            other, own = starts[order[base[open_] + middle]], starts[order[open_]]
            # elements of the left run precede equal ones of the right
            goes = text.before(other, own, most, ~left[open_])
            low[open_] = np.where(goes, middle + 1, low[open_])
            high[open_] = np.where(goes, high[open_], middle)
        target = base + np.where(left, place, pair + place - (pair + run)) + (low - begin)
        merged = np.empty_like(order)
        merged[target] = order
        order, run = merged, run * 2
    return order


def verified(text: HashedText, starts: np.ndarray, blocks: np.ndarray, order: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, equal): the order, mended where bytes say so, and whether each suffix equals the one before by its window."""
    view = np.lib.stride_tricks.sliding_window_view(text.data, window)
    equal, wrong = np.zeros(len(order), bool), set()
    for at in range(1, len(order), COMPARED):
        now = slice(at, at + COMPARED)
        a, b = order[at - 1 : at - 1 + len(order[now])], order[now]
        x, y = view[starts[a]], view[starts[b]]
        differs = x != y
        place = differs.argmax(axis=1)
        rows = np.arange(len(a))
        one = blocks[a] == blocks[b]
        equal[now] = one & ~differs[rows, place]
        wrong.update(blocks[b[one & (x[rows, place] > y[rows, place])]].tolist())
    for block in wrong:
        own = np.flatnonzero(blocks[order] == block)
        held = sorted(order[own].tolist(), key=lambda i: (view[starts[i]].tobytes(), i))
        order[own] = held
        for i, (j, k) in zip(own[1:], zip(held, held[1:])):
            equal[i] = bool((view[starts[j]] == view[starts[k]]).all())
    return order, equal


def repeated(rows: list[tuple], window: int) -> Iterator[tuple[int, int, int, int]]:
    """(doc, tag, s, e) of the windows in different segments (key, doc, tag, start, stop, seg, off, hot) that also start
    earlier, by block; rows are sorted by key."""
    # windows of one segment hold the anchor at different places, so they differ: one alone has no repeats
    rows = [r for i, r in enumerate(rows) if i and rows[i - 1][0] == r[0] or i + 1 < len(rows) and rows[i + 1][0] == r[0]]
    if not rows:
        return
    sizes = np.array([len(r[5]) for r in rows])
    counts, ends = sizes - window + 1, np.cumsum(sizes)
    text = HashedText(b"".join(r[5] for r in rows))
    owner = np.repeat(np.arange(len(rows)), counts)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = (ends - sizes)[owner] + offset
    keys = np.array([r[0] for r in rows])
    # the order of occurrences, by (doc, tag, start)
    rank = np.empty(len(rows), np.int64)
    rank[sorted(range(len(rows)), key=lambda i: (rows[i][1] is not None, rows[i][1] or 0, rows[i][2], rows[i][3]))] = np.arange(len(rows))
    age = rank[owner] * (1 << 32) + offset
    # equal windows have the anchor at equal places, so each place of a block is sorted for itself
    places = np.array([r[6] for r in rows])[owner] - offset
    blocks = np.cumsum(np.r_[0, keys[1:] != keys[:-1]])[owner] * window + places
    # a window whose hash no other of its block has equals none; of those with one hash, one is sorted for all
    hashes = text.whole(starts, window)
    marks = hashes + windows.mix((blocks + 1).astype(np.uint64) * np.uint64(BASE))
    twice = np.sort(marks)
    twice = twice[1:][twice[1:] == twice[:-1]]
    if not len(twice):
        return
    twice = twice[np.r_[True, twice[1:] != twice[:-1]]]
    busy = np.flatnonzero(twice[np.minimum(np.searchsorted(twice, marks), len(twice) - 1)] == marks)
    busy = busy[np.lexsort((hashes[busy], blocks[busy]))]
    starts, owner, offset, age, blocks, hashes = starts[busy], owner[busy], offset[busy], age[busy], blocks[busy], hashes[busy]
    first = np.flatnonzero(np.r_[True, (blocks[1:] != blocks[:-1]) | (hashes[1:] != hashes[:-1])])
    size = np.diff(np.r_[first, len(starts)])
    rank = suffix_sort(text, starts[first], blocks[first], window)
    order = np.repeat(first[rank] - np.r_[0, np.cumsum(size[rank])[:-1]], size[rank]) + np.arange(len(starts))
    order, equal = verified(text, starts, blocks, order, window)
    group = np.cumsum(~equal) - 1
    oldest = np.full(group[-1] + 1 if len(group) else 0, np.iinfo(np.int64).max)
    np.minimum.at(oldest, group, age[order])
    late = np.zeros(len(order), bool)
    late[order] = age[order] != oldest[group]
    where = np.flatnonzero(late)
    where = where[np.lexsort((offset[where], owner[where]))]
    if not len(where):
        return
    new = np.flatnonzero(np.r_[True, (owner[where[1:]] != owner[where[:-1]]) | (offset[where[1:]] != offset[where[:-1]] + 1)])
    for i, j in zip(where[new].tolist(), where[np.r_[new[1:], len(where)] - 1].tolist()):
        _, doc, tag, start, *_ = rows[owner[i]]
        yield doc, tag, start + int(offset[i]), start + int(offset[j]) + window


def dedup(docs: DataFrame, window: int = 100, id_col: str = "doc_id", text_col: str = "text", texts: bool = True) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept binary): bytes covered by a window that also starts earlier go.

    Null texts are empty; texts shorter than the window stay whole. Rows with equal id and text are one
    document and get the same result each; equal ids with different texts are ordered by a hash of the text.
    A null id comes first; ids are whole numbers. Other columns aren't read. Without texts, kept is left out.
    """
    rows, chunk = windows.chunked(docs, id_col, text_col)
    split = lambda seg: (seg, len(seg) - window + 1)
    spans = windows.repeats(rows, parse, lambda held: repeated(held, window), split, bytes, window, KGRAM)

    def run(doc, text, found):
        data, at, kept = text.encode(), 0, []
        for s, e in found:
            kept.append(data[at:s])
            at = e
        left = b"".join([*kept, data[at:]])
        return (doc, len(data), len(data) - len(left), len(found), hashlib.sha256(left).hexdigest(), *([left] if texts else []))

    small_batches(docs.sparkSession, 10_000, "2m")
    names, kinds = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"], [pa.int64()] * 4 + [pa.string(), pa.binary()]
    schema = f"`{id_col}` long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if texts else "")
    return windows.finish(rows, spans, chunk, run, names[: 5 + texts], kinds[: 5 + texts], schema)
