"""SimHash near-duplicates by multi-index hashing.

A 64-bit fingerprint is cut into two segments of 32 bits. Two fingerprints at 4 or fewer differing bits differ
by 2 or fewer in one segment at least, and then some value lies within one bit of both their segments. So each
fingerprint is entered in the table of a segment under the 33 values of the Hamming ball of radius 1, every
table match is fetched, and complete distances are verified. Equal fingerprints are one entry. A bucket that
many different fingerprints share is cut up again by the other segment in the same way, so that no task
compares all pairs of a large group; links leave a task as spanning trees, not as pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small_batches

#: Different fingerprints in a bucket that are compared in place; larger buckets are cut up.
BUCKET = 2048
#: Differing bits that two segments' enumeration covers.
MOST_RADIUS = 5
SEED = 42
#: Shingles whose bits are counted at a time.
COUNTED = 1 << 14
#: Pairs of fingerprints that are compared at a time in a large bucket.
COMPARED = 1 << 18


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """Bit i is set if it's set in over half of the XXH64 of all word shingles, repeats included."""
    words = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    total = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, total, COUNTED):
        # what a long text needs beside its words is bounded by the piece
        part = np.array(_shingle_hashes(words[at : at + COUNTED + shingle - 1], shingle), "<u8")
        counts += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def _shingle_hashes(words: list[bytes], shingle: int) -> list[int]:
    joined, n = b" ".join(words), len(words)
    if n <= shingle:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    sizes = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(sizes + 1) - 1
    starts, ends = (ends - sizes)[: n - shingle + 1].tolist(), ends[shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[i:j], SEED) for i, j in zip(starts, ends)]


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp long) of every whole text; null counts as empty, and texts without words have 0."""
    small_batches(docs.sparkSession, 500, "4m")

    def run(batches):
        for b in batches:
            found = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in b.column(1).cast(pa.binary())]
            yield pa.record_batch([b.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], ["id", "fp"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"id {kind}, fp long")


def _trees(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest reachable index for each of n nodes with links a-b."""
    root = np.arange(n)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        np.minimum.at(root, high, low)
        while (jump := root[root]).tolist() != root.tolist():
            root = jump
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root


def _close(x: np.ndarray, y: np.ndarray, radius: int) -> np.ndarray:
    return np.bitwise_count(x ^ y) <= radius


def _reached(x: np.ndarray, radius: int) -> np.ndarray:
    """For each fingerprint, the first from which it's reached by steps of radius bits at most.

    Breadth first: each is compared once with those not reached yet, at most COMPARED pairs at a time. A dense
    group is reached in a few steps, and the links themselves are never held."""
    root, left = np.full(len(x), -1), np.arange(len(x))
    while len(left):
        start, wave = left[0], left[:1]
        root[start], left = start, left[1:]
        while len(wave) and len(left):
            step = max(1, COMPARED // len(left))
            now, wave = wave[:step], wave[step:]
            near = _close(x[now, None], x[None, left], radius).any(axis=0)
            root[left[near]] = start
            wave, left = np.r_[wave, left[near]], left[~near]
    return root


def _links(keys: np.ndarray, fps: np.ndarray, radius: int, largest: int | None):
    """Spanning trees of the links within buckets, as (a, b); places of the rows in larger buckets than largest.

    keys are sorted. Small buckets are compared by their offset, all at once; larger ones breadth first."""
    bounds = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True])
    sizes = np.diff(bounds)
    size_of = np.repeat(sizes, sizes)
    nodes, ids = np.unique(fps, return_inverse=True)
    a, b = [], []
    small = np.flatnonzero((size_of > 1) & (size_of <= 64))
    offset = 1
    while len(small):
        small = small[(small + offset < len(keys))]
        small = small[keys[small + offset] == keys[small]]
        near = small[_close(fps[small], fps[small + offset], radius)]
        a.append(ids[near])
        b.append(ids[near + offset])
        offset += 1
    for start, size in zip(bounds[:-1][sizes > 64].tolist(), sizes[sizes > 64].tolist()):
        if largest and size > largest:
            continue
        own = slice(start, start + size)
        x, at = fps[own], ids[own]
        root = _reached(x, radius)
        a.append(at)
        b.append(at[root])
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
    root = _trees(len(nodes), a, b)
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    hot = np.flatnonzero(size_of > largest) if largest else np.zeros(0, np.int64)
    return nodes[moved], nodes[root[moved]], hot


def _bucket_links(entries: DataFrame, radius: int, largest: int | None) -> DataFrame:
    """(a, b, key): links from entries (key, fp), and with a null b the entries of buckets that are too large."""
    small_batches(entries.sparkSession, 20_000, "4m")
    sorted_ = entries.repartition("key").sortWithinPartitions("key", "fp")

    def out(keys, fps):
        a, b, hot = _links(keys, fps, radius, largest)
        signed = lambda x: pa.array(x.view(np.int64))
        if len(a):
            yield pa.record_batch([signed(a), signed(b), pa.nulls(len(a), pa.int64())], ["a", "b", "key"])
        if len(hot):
            yield pa.record_batch([signed(fps[hot]), pa.nulls(len(hot), pa.int64()), pa.array(keys[hot])], ["a", "b", "key"])

    def run(batches):
        # Buckets go on over batches: the last of what has come waits until its end, or until it's too large anyway.
        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        spilling = None  # the key of a bucket that is passed on as it comes
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy().view(np.uint64)])
            if spilling is not None:
                n = int(np.searchsorted(keys, spilling, "right"))
                if n:
                    yield pa.record_batch([pa.array(fps[:n].view(np.int64)), pa.nulls(n, pa.int64()), pa.array(keys[:n])], ["a", "b", "key"])
                keys, fps = keys[n:], fps[n:]
                if not len(keys):
                    continue
                spilling = None
            if len(keys) < 200_000:
                continue
            last = int(np.searchsorted(keys, keys[-1]))
            yield from out(keys[:last], fps[:last])
            keys, fps = keys[last:], fps[last:]
            if largest and len(keys) > largest:
                spilling = keys[0]
                yield pa.record_batch([pa.array(fps.view(np.int64)), pa.nulls(len(fps), pa.int64()), pa.array(keys)], ["a", "b", "key"])
                keys, fps = keys[:0], fps[:0]
        if len(keys):
            yield from out(keys, fps)

    return sorted_.mapInArrow(run, "a long, b long, key long")


def _ball(value: Column, bits: int) -> Column:
    """The values within one bit of value."""
    return F.transform(F.array(F.lit(0).cast("long"), *(F.lit(1 << i).cast("long") for i in range(bits))), lambda m: value.bitwiseXOR(m))


def near_links(fps: DataFrame, radius: int = 4) -> DataFrame:
    """(a, b) between different fingerprints: they connect all that are linked by steps of radius bits at most."""
    if not 0 <= radius <= MOST_RADIUS:
        raise ValueError(f"radius {radius}: two segments with balls of radius 1 find 0 to {MOST_RADIUS} differing bits")
    distinct = fps.select("fp").distinct()
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF).cast("long")), F.shiftrightunsigned("fp", 32)
    entries = distinct.select(F.explode(F.concat(_ball(low, 32), F.transform(_ball(high, 32), lambda v: v + F.lit(1 << 32).cast("long")))).alias("key"), "fp")
    first = cut(_bucket_links(entries, radius, BUCKET))
    # The members of a large bucket are near in one segment; they're dealt out again by the halves of the other.
    hot = first.filter("b is null").select("a", "key").distinct()
    other = F.when(F.col("key") >= F.lit(1 << 32), F.col("a").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))).otherwise(F.shiftrightunsigned("a", 32))
    left, right = other.bitwiseAND(F.lit(0xFFFF).cast("long")), F.shiftrightunsigned(other, 16)
    again = hot.select(F.explode(F.concat(F.transform(_ball(left, 16), lambda v: F.xxhash64("key", F.lit(0), v)), F.transform(_ball(right, 16), lambda v: F.xxhash64("key", F.lit(1), v)))).alias("key"), F.col("a").alias("fp"))
    second = _bucket_links(again, radius, None)
    return first.filter("b is not null").select("a", "b").unionByName(second.select("a", "b")).distinct()


def connect(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for nodes that have links (a, b).

    Alternating large and small stars; each round is a shuffle of the links that are left, written to the
    shared folder. The rounds grow with the logarithm of the longest chain."""
    edges = cut(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        edges = cut(small.filter("u <> v").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint string, component_id): the smallest id reachable over links of radius bits at most.

    Null and empty texts have fingerprint zero and are linked like others. Rows with equal ids each have a row.
    A null id never names a component unless all ids in it are null. Columns other than the two aren't read.
    """
    kind = dict(docs.dtypes)[id_col]
    fps = cut(fingerprints(docs, shingle, id_col, text_col))
    first = cut(fps.groupBy("fp").agg(F.min("id").alias("first_id")))
    roots = cut(connect(near_links(first, radius)))
    rooted = first.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(names, "root").select("fp", "component_id")
    return fps.join(classes, "fp").select(F.col("id").cast(kind).alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
