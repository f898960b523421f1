"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from .common import small_batches

#: A place between a character that isn't white space and one space with such a character behind it. Every
#: match of the pattern ends before white space that follows other characters, and none looks back, so the
#: parts on both sides are split by the pattern as they'd be within the whole text.
SAFE_BOUNDARY = re.compile(r"(?<=\S)(?= \S)")
#: Characters that are encoded at a time, at least; the next safe boundary ends the block.
BLOCK_CHARS = 1 << 16


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


class Codec:
    """encode_ordinary() and decode_bytes() of tiktoken, long texts block by block."""

    def __init__(self, rank_file: str, pattern: str):
        self.encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=read_ranks(rank_file), special_tokens={})

    def blocks(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > BLOCK_CHARS:
            end = SAFE_BOUNDARY.search(text, at + BLOCK_CHARS)
            if end is None:
                break
            yield text[at : end.start()]
            at = end.start()
        yield text[at:]

    def encode(self, text: str) -> list[int]:
        if len(text) <= BLOCK_CHARS:
            return self.encoding.encode_ordinary(text)
        return [i for block in self.blocks(text) for i in self.encoding.encode_ordinary(block)]

    def decode(self, ids: list[int]) -> bytes:
        return self.encoding.decode_bytes(ids)


@lru_cache(maxsize=4)
def codec(rank_file: str, pattern: str) -> Codec:
    """One for each worker process."""
    return Codec(rank_file, pattern)


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every text; null counts as the empty text, which has no ids.

    The rank file must be at the same place on every executor. Repeated rows give repeated rows.
    """
    small_batches(docs.sparkSession, 500, "4m")

    def run(batches):
        c = codec(rank_file, pattern)
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([c.encode(t or "") for t in b.column(1).to_pylist()], pa.list_(pa.int32()))], [id_col, "ids"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def decode(encoded: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """(id, raw binary): the bytes of the ids, whether or not they are whole characters; null ids give no bytes."""
    small_batches(encoded.sparkSession, 500, "4m")

    def run(batches):
        c = codec(rank_file, pattern)
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([c.decode(ids or []) for ids in b.column(1).to_pylist()], pa.binary())], [id_col, "raw"])

    kind = dict(encoded.dtypes)[id_col]
    return encoded.select(id_col, "ids").mapInArrow(run, f"`{id_col}` {kind}, raw binary")


def round_trip(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every text and decodes the ids: (id, n_tokens, ids_sha256, decoded_sha256).

    No shuffle: each batch is encoded, decoded and digested where it was read. Null texts are empty, empty
    texts have no ids; rows with equal ids stay apart, other columns are not read.
    """
    small_batches(docs.sparkSession, 500, "4m")

    def run(batches):
        c = codec(rank_file, pattern)
        name = [str(i) for i in range(c.encoding.n_vocab)].__getitem__
        for b in batches:
            counts, ids_sha, raw_sha = [], [], []
            for text in b.column(1).to_pylist():
                ids = c.encode(text or "")
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(" ".join(map(name, ids)).encode()).hexdigest())
                raw_sha.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.record_batch([b.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(raw_sha)], [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = dict(docs.dtypes)[id_col]
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
