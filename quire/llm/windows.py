"""Repeated windows of documents, found among places that share an anchor.

Every window of W tokens has an anchor: its k-gram of smallest hash, leftmost among equals. Equal windows have
equal anchors, so windows are compared only where anchors agree. The steps:

1. keys: the hashes of all anchors, each with the chunk of documents that holds it. An anchor that occurs once
   in all documents repeats nothing, and its text is never sent anywhere.
2. segments: each chunk of texts meets its own repeated anchors. Consecutive windows of one document with
   one anchor travel together, as one segment; equal segments of a batch are one before the shuffle.
3. blocks: the segments of an anchor are compared. Those of a hot anchor are dealt out by a salt, where
   equal ones collapse to their first. Those left are cut into parts, which meet by the tokens that all of a
   part's windows share; parts that nothing meets go, hot ones are cut again, down to single windows.
4. finish: each chunk of texts meets the spans that were found in it.

Texts are shuffled twice, by a hash of id and text; all else is a fraction of them. No group is held whole:
chunks, hot anchors and hot windows are streams of sorted rows, other blocks have at most HOT segments.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, small_batches

#: Tokens whose anchors are computed at a time.
PIECE = 1 << 20
#: Bytes of text in a chunk, about.
CHUNK_BYTES = 256 << 10
#: Occurrences beyond which an anchor is hot, and the tasks that its equal segments, or equal windows, are dealt to first.
HOT, SALTS = 2_000, 64
#: Places of the anchor that windows of a hot anchor's segments share, level by level, as long as they are hot.
PARTS = (16, 4, 1)
#: Bytes of segments that are compared at a time, about; a block is never divided.
COMPARED = 1 << 20
#: Different segments of a task that wait for equal ones before they are sent.
WAITING = 50_000

BLOCK = "key long, doc long, tag long, start long, stop long, seg binary, off int, hot boolean"
SPAN = "doc long, tag long, s long, e long"


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


@dataclass
class Tokens:
    """The tokens of some texts, one text after another: a number for each, and where each text begins (and the end)."""

    numbers: np.ndarray
    bounds: np.ndarray
    cut: Callable[[np.ndarray, np.ndarray], list[bytes]]  # the bytes from each first token to each last


def anchors(t: Tokens, window: int, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, first windows, last windows, places of the anchor behind the first) of all runs of windows with one
    anchor, piece by piece; no window crosses the end of a text. k is a power of two."""
    n = len(t.numbers) - window + 1
    if n <= 0:
        return
    crossed, inner = np.zeros(n + 1, np.int32), t.bounds[1:-1]
    np.add.at(crossed, np.clip(inner - window + 1, 0, n), 1)
    np.add.at(crossed, np.clip(inner, 0, n), -1)
    whole = np.cumsum(crossed[:-1]) == 0
    for at in range(0, n, PIECE):
        h = t.numbers[at : at + PIECE + window - 1].astype(np.uint64)
        span, factor = 1, 0x9E3779B97F4A7C15
        while span < k:
            h = h[:-span] * np.uint64(factor) + h[span:]
            span, factor = span * 2, factor * factor % (1 << 64)
        h = mix(h)
        grams = window - k + 1
        low = (h & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(h), dtype=np.uint64)
        span = 1
        while span * 2 <= grams:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < grams:
            low = np.minimum(low[: len(low) - (grams - span)], low[grams - span :])
        place, own = (low & np.uint64(0xFFFFFF)).astype(np.int64), whole[at : at + PIECE]
        first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (own[1:] != own[:-1])])
        last = np.r_[first[1:], len(place)] - 1
        first, last = first[own[first]], last[own[first]]
        yield h[place[first]].view(np.int64), first + at, last + at, place[first] - first


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, their offsets) of a string column."""
    held = column.cast(pa.large_binary())
    offsets = np.frombuffer(held.buffers()[1], np.int64)[held.offset : held.offset + len(held) + 1]
    data = held.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunked(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, Column]:
    """(chunk, doc, tag, text), and the chunk's expression: a document is its id and a hash of its text; rows that agree in both are one."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    total = docs.select(F.sum(F.octet_length(text))).first()[0] or 0
    chunk = F.pmod(F.xxhash64("doc", "tag"), F.lit(total // CHUNK_BYTES + 1)).cast("int")
    named = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("tag"), text.alias("text"))
    return named.select(chunk.alias("chunk"), "doc", "tag", "text"), chunk


def batch_of(names: list[str], kinds: list, rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def _age(doc, tag: int, start: int) -> tuple:
    """The order of occurrences: by id, a null one first, then tag and place."""
    return doc is not None, doc or 0, tag, start


def repeated_keys(texts: DataFrame, parse, window: int, k: int) -> DataFrame:
    """(chunk, key, hot): the anchors of each chunk that occur more than once in all texts."""

    def run(batches):
        for b in batches:
            chunk, t = b.column(0).to_numpy(), parse(b.column(1))
            for keys, first, _, _ in anchors(t, window, k):
                owner = chunk[np.searchsorted(t.bounds, first, "right") - 1]
                order = np.lexsort((owner, keys))
                keys, owner = keys[order], owner[order]
                new = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])]) if len(keys) else order
                yield pa.record_batch([pa.array(keys[new]), pa.array(owner[new]), pa.array(np.diff(np.r_[new, len(keys)]).astype(np.int32))], ["key", "chunk", "n"])

    # dealt out by key once: counted there, and met by the counts there. Both sides use all three columns, so
    # that Spark sees one exchange in them
    found = texts.select("chunk", "text").mapInArrow(run, "key long, chunk int, n int").filter("key IS NOT NULL AND chunk IS NOT NULL").repartition("key")
    counts = found.groupBy("key").agg(F.sum("n").alias("total"), F.max("chunk").alias("last")).filter("total > 1")
    both = found.join(counts.hint("shuffle_hash"), "key").filter("chunk <= last")
    return both.select("chunk", "key", (F.greatest("n", "total") > HOT).alias("hot"))


def segments(texts: DataFrame, keys: DataFrame, parse, window: int, k: int) -> DataFrame:
    """BLOCK: the different segments of repeated anchors; rows without seg are spans (start, stop) that have an equal one elsewhere in their batch."""
    columns = ["chunk", "doc", "tag", "key", "hot", "text"]
    left = keys.select("chunk", F.lit(None).cast("long").alias("doc"), F.lit(None).cast("long").alias("tag"), "key", "hot", F.lit(None).cast("string").alias("text"))
    right = texts.select("chunk", "doc", "tag", F.lit(None).cast("long").alias("key"), F.lit(None).cast("boolean").alias("hot"), "text")
    both = left.unionByName(right).repartition("chunk").sortWithinPartitions("chunk", F.col("key").isNull())
    names, kinds = [c.split()[0] for c in BLOCK.split(", ")], [pa.int64()] * 5 + [pa.binary(), pa.int32(), pa.bool_()]

    def run(batches):
        now, known, hot = None, [], []
        waiting: dict[bytes, tuple] = {}  # segment: (age, key, doc, tag, start, stop, off, hot)
        spans: list[tuple] = []

        def flush():
            rows = [(key, doc, tag, start, stop, seg, off, is_hot) for seg, (_, key, doc, tag, start, stop, off, is_hot) in waiting.items()] + spans
            waiting.clear()
            spans.clear()
            for i in range(0, len(rows), 10_000):
                yield batch_of(names, kinds, rows[i : i + 10_000])

        for b in batches:
            chunk, is_key = b.column(0).to_numpy(zero_copy_only=False), np.asarray(b.column(3).is_valid())
            edges = np.flatnonzero(np.r_[True, (chunk[1:] != chunk[:-1]) | (is_key[1:] != is_key[:-1]), True]) if len(chunk) else []
            for i, j in zip(edges[:-1], edges[1:]):
                if chunk[i] != now:
                    now, known, hot = chunk[i], [], []
                rows = b.slice(i, j - i)
                if is_key[i]:
                    known.append(rows.column(3).to_numpy())
                    hot.append(rows.column(4).to_numpy(zero_copy_only=False))
                    continue
                if not len(known):
                    continue
                if isinstance(known, list):  # the first texts of a chunk: its keys are complete
                    known, hot = np.concatenate(known), np.concatenate(hot).astype(bool)
                    order = np.argsort(known)
                    known, hot = known[order], hot[order]
                t = parse(rows.column(5))
                docs, tags = rows.column(1).to_pylist(), rows.column(2).to_pylist()
                for keys_, first, last, off in anchors(t, window, k):
                    place = np.minimum(np.searchsorted(known, keys_), len(known) - 1)
                    keep = np.flatnonzero(known[place] == keys_)
                    first, last, off, keys_, is_hot = first[keep], last[keep], off[keep], keys_[keep], hot[place[keep]]
                    owner = np.searchsorted(t.bounds, first, "right") - 1
                    start = first - t.bounds[owner]
                    stop = start + last - first + window
                    for seg, key, d, s, e, o, h in zip(t.cut(first, last + window - 1), keys_.tolist(), owner.tolist(), start.tolist(), stop.tolist(), off.tolist(), is_hot.tolist()):
                        row = (_age(docs[d], tags[d], s), key, docs[d], tags[d], s, e, o, h)
                        other = waiting.setdefault(seg, row)
                        if other[0] != row[0]:
                            _, key, doc, tag, s, e, *_ = max(other, row, key=lambda x: x[0])
                            waiting[seg] = min(other, row, key=lambda x: x[0])
                            if spans and spans[-1][1:3] == (doc, tag) and spans[-1][3] <= s <= spans[-1][4] <= e:
                                key, doc, tag, s, *_ = spans.pop()
                            spans.append((key, doc, tag, s, e, None, None, None))
                    if len(waiting) > WAITING or len(spans) > WAITING:
                        yield from flush()
        yield from flush()

    return both.select(columns).mapInArrow(run, BLOCK)


def _firsts(rows: Iterator[tuple], spans: list[tuple]) -> Iterator[tuple]:
    """The first of equal segments, from rows sorted by (key, seg, age); the others become spans, a repeated row nothing."""
    key = seg = own = None
    for row in rows:
        if row[5] is None:
            spans.append(row[1:5])
        elif row[0] == key and row[5] == seg:
            if row[1:4] != own:
                spans.append(row[1:5])
            own = row[1:4]
        else:
            key, seg, own = row[0], row[5], row[1:4]
            yield row


def repeats(texts: DataFrame, parse, compare: Callable[[list[tuple]], Iterator[tuple[int, int, int, int]]], split: Callable[[bytes], tuple], joined: Callable, window: int, k: int) -> DataFrame:
    """(doc, tag, s, e): tokens covered by windows that also start earlier.

    compare() takes the different segments (key, doc, tag, start, stop, seg, off, hot) of whole blocks and yields
    spans; split() gives the tokens of a segment and how many windows it has, joined() the bytes of tokens. Order is by (doc, tag, start), a null id first."""
    small_batches(texts.sparkSession, 10_000, "2m")
    keys = saved(repeated_keys(texts, parse, window, k))
    found = segments(texts, keys, parse, window, k)
    names, kinds = [c.split()[0] for c in BLOCK.split(", ")], [pa.int64()] * 5 + [pa.binary(), pa.int32(), pa.bool_()]

    def rows_of(batches):
        for b in batches:
            yield from zip(*(c.to_pylist() for c in b.columns))

    def send(rows: list[tuple], spans: list[tuple]):
        out = rows + [(None, *s, None, None, None) for s in spans]
        rows.clear()
        spans.clear()
        for i in range(0, len(out), 10_000):
            yield batch_of(names, kinds, out[i : i + 10_000])

    def judge(batches):
        spans, held, size, hot = [], [], 0, []
        for row in _firsts(rows_of(batches), spans):
            if row[7]:
                hot.append(row)
            else:
                if size > COMPARED and held[-1][0] != row[0]:
                    spans += compare(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
            if len(hot) + len(spans) > 20_000:
                yield from send(hot, spans)
        spans += compare(held)
        yield from send(hot, spans)

    def apart(width: int):
        """Segments cut by the anchor's place within their windows, width places together. Windows of such a part share
        a core of tokens, by which the parts of equal windows meet; a single window is its core, and its digest stands for it."""

        def run(batches):
            out = []
            for key, doc, tag, start, _, seg, off, _ in rows_of(batches):
                tokens, n = split(seg)
                at = 0
                while at < n:
                    group = (off - at) // width
                    to = min(n, off - group * width + 1)  # behind the last window whose anchor has a place in the group
                    core = joined(tokens[off - group * width : off - group * width - width + 1 + window])
                    mark = hashlib.blake2b(core, digest_size=16, salt=group.to_bytes(4, "big"), key=key.to_bytes(8, "big", signed=True)).digest()
                    part = mark if width == 1 else joined(tokens[at : to - 1 + window])
                    out.append((int.from_bytes(mark[:8], "big", signed=True), doc, tag, start + at, start + to - 1 + window, part, off - at, True))
                    at = to
                if len(out) > 20_000:
                    yield from send(out, [])
            yield from send(out, [])

        return run

    def collapse(batches):
        spans, out = [], []
        for row in _firsts(rows_of(batches), spans):
            out.append(row)
            if len(out) + len(spans) > 20_000:
                yield from send(out, spans)
        yield from send(out, spans)

    order = ["key", "seg", "doc", "tag", "start"]
    salt = F.when(F.col("hot") | F.col("seg").isNull(), F.pmod(F.xxhash64("doc", "tag"), F.lit(SALTS))).otherwise(0)
    span = lambda rows: rows.filter("seg IS NULL").select("doc", "tag", F.col("start").alias("s"), F.col("stop").alias("e"))
    judged = saved(found.repartition("key", salt).sortWithinPartitions(*order).mapInArrow(judge, BLOCK), free=True)
    spans = span(judged)
    for width in PARTS:
        hot = judged.filter("seg IS NOT NULL")
        if hot.isEmpty():
            return spans
        parts = saved(hot.mapInArrow(apart(width), BLOCK))
        counts = parts.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key", (F.col("n") > HOT).alias("is_hot"))
        again = parts.join(counts, "key").withColumn("hot", F.col("is_hot")).select(names)
        judged = saved(again.repartition("key", salt).sortWithinPartitions(*order).mapInArrow(collapse if width == 1 else judge, BLOCK))
        spans = spans.unionByName(span(judged))
    # the first of each salt's equal windows
    late = judged.filter("seg IS NOT NULL").repartition("key").sortWithinPartitions(*order).mapInArrow(collapse, BLOCK)
    return spans.unionByName(span(late))


def finish(texts: DataFrame, spans: DataFrame, chunk: Column, run: Callable[[object, str, list[tuple[int, int]]], tuple], names: list[str], kinds: list, schema: str) -> DataFrame:
    """A row of run(doc, text, its merged spans) for each row of texts; texts meet their spans chunk by chunk, as a stream."""
    columns = ["chunk", "doc", "tag", "s", "e", "text"]
    left = spans.select(chunk.alias("chunk"), *columns[1:5], F.lit(None).cast("string").alias("text"))
    right = texts.select("chunk", "doc", "tag", F.lit(None).cast("long").alias("s"), F.lit(None).cast("long").alias("e"), "text")
    both = left.unionByName(right).repartition("chunk").sortWithinPartitions("chunk", "doc", "tag", F.col("s").isNull(), "s", "e")

    def go(batches):
        own, found = None, []
        for b in batches:
            out = []
            for _, doc, tag, s, e, text in zip(*(c.to_pylist() for c in b.columns)):
                if own != (doc, tag):
                    own, found = (doc, tag), []
                if text is not None:
                    out.append(run(doc, text, found))
                elif found and s <= found[-1][1]:
                    found[-1] = (found[-1][0], max(found[-1][1], e))
                else:
                    found.append((s, e))
            if out:
                yield batch_of(names, kinds, out)

    return both.select(columns).mapInArrow(go, schema)
