"""Substring dedup on words by relative Lempel-Ziv parsing.

The reference is cut into blocks by anchor (windows.py): the block of an anchor indexes every segment of text
around it, and a segment can only repeat what its own block holds. Segments of a block are taken in document
order. Each is parsed greedily against the index: a factor begins where a window of words is found, is
extended word by word along the reference that was found, and the next look-up is at its boundary, for the
first window that the factor doesn't hold. Factors become duplicate spans; what they don't cover is indexed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import windows
from .common import small_batches

KGRAM = 8
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes whose words are hashed at a time; a word is never cut.
PIECE = 1 << 20
BASE = 0x9E3779B97F4A7C15
VALUES = windows.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A polynomial hash of each word, from prefix sums; words that collide only share a hash, bytes are compared later."""
    out, at = np.zeros(len(starts), np.uint64), 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + PIECE, "right")))
        low, high = int(starts[at]), int(ends[to - 1])
        prefix = np.r_[np.uint64(0), np.cumsum(VALUES[data[low:high]] * _powers(BASE, high - low), dtype=np.uint64)]
        back = _powers(pow(BASE, -1, 1 << 64), high - low)
        i, j = starts[at:to] - low, ends[at:to] - low
        out[at:to] = (prefix[j] - prefix[i]) * back[i]
        at = to
    return windows.mix(out)


def parse(column: pa.Array) -> windows.Tokens:
    """The words of each text; cut() joins them by one space."""
    data, offsets = windows.texts_of(column)
    solid = ~SPACE[data]
    # texts end words
    opens, closes = solid.copy(), solid.copy()
    opens[1:] &= ~solid[:-1]
    closes[:-1] &= ~solid[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    opens[inner] = solid[inner]
    closes[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    hashes = word_hashes(data, starts, ends)
    # words joined by one space, so that equal words are equal bytes
    size = ends - starts
    end = np.cumsum(size + 1) - 1
    begin = end - size
    joined = np.full(int(end[-1]) + 1 if len(end) else 0, 32, np.uint8)
    inside = np.ones(len(joined), bool)
    inside[end] = False
    joined[inside] = data[solid]
    held = joined.tobytes()

    def cut(first, last):
        return [held[i:j] for i, j in zip(begin[first].tolist(), end[last].tolist())]

    return windows.Tokens(hashes, np.searchsorted(starts, offsets), cut)


def factors(words: list[bytes], index: dict[tuple, tuple[list[bytes], int]], window: int) -> Iterator[tuple[int, int]]:
    """(begin, end) of the factors of window words or more, left to right, against an index of reference windows.

    The index gives a reference and the place of a window in it. Windows that no factor holds are added, with
    these words as their reference, once the look-up has passed them: a text is a reference to its own rest."""
    at = 0
    while at + window <= len(words):
        first = tuple(words[at : at + window])
        found = index.get(first)
        if found is None:
            index[first] = (words, at)
            at += 1
            continue
        reference, place = found
        length = window
        while at + length < len(words) and place + length < len(reference) and words[at + length] == reference[place + length]:
            length += 1
        yield at, at + length
        at += length - window + 1  # the boundary: the first window that the factor doesn't hold


def factor(rows: list[tuple], window: int) -> Iterator[tuple[int, int, int, int]]:
    """(doc, tag, s, e) of the repeated spans of different segments (key, doc, tag, start, stop, seg, off, hot), sorted by key."""
    at = 0
    while at < len(rows):
        end = at + 1
        while end < len(rows) and rows[end][0] == rows[at][0]:
            end += 1
        if end - at > 1:  # windows of one segment hold the anchor at different places, so they differ
            index: dict = {}
            for _, doc, tag, start, _, seg, _, _ in sorted(rows[at:end], key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3])):
                for i, j in factors(seg.split(b" "), index, window):
                    yield doc, tag, start + i, start + j
        at = end


def dedup(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text", texts: bool = True) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, kept string): words covered by a window that also starts earlier go.

    Words are runs of anything but ASCII white space; kept words are joined by one space. Null texts have no
    words; texts of fewer words than the window stay whole. Rows with equal id and text are one document and
    get the same result each; equal ids with different texts are ordered by a hash of the text. A null id
    comes first; ids are whole numbers. Other columns aren't read. Without texts, kept is left out.
    """
    rows, chunk = windows.chunked(docs, id_col, text_col)

    def split(seg: bytes) -> tuple[list[bytes], int]:
        words = seg.split(b" ")
        return words, len(words) - window + 1

    spans = windows.repeats(rows, parse, lambda held: factor(held, window), split, b" ".join, window, KGRAM)

    def run(doc, text, found):
        words, at, kept = text.encode().split(), 0, []
        for s, e in found:
            kept += words[at:s]
            at = e
        kept += words[at:]
        joined = b" ".join(kept)
        return (doc, len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), *([joined.decode()] if texts else []))

    small_batches(docs.sparkSession, 10_000, "2m")
    names, kinds = [id_col, "n_words", "n_removed", "kept_sha256", "kept"], [pa.int64()] * 3 + [pa.string()] * 2
    schema = f"`{id_col}` long, n_words long, n_removed long, kept_sha256 string" + (", kept string" if texts else "")
    return windows.finish(rows, spans, chunk, run, names[: 4 + texts], kinds[: 4 + texts], schema)
