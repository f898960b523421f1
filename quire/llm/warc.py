"""WARC archives with revisit records, and their capture index by an external merge.

write_archives() puts a record for each page into archives, a gzip member for each record, so that an index's
offset is a place to read from. read_archives() parses them and gives, archive by archive, locally sorted runs
of captures, with sizes and digests of the payloads that were read. merge_index() merges the runs of a range of URL
keys with a loser tree into one globally ordered capture history; runs wait in temporary files, not in memory.
"""

from __future__ import annotations

import base64
import hashlib
import tempfile
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, forget_at_exit, shared_dir, small_batches

#: WARC-Date of page 0, in seconds since 1970; each page is captured a second after the one before.
FIRST_CAPTURE = 1_577_836_800
DAY_SECONDS = 86_400 * 365 * 50
#: Runs that are merged at a time, rows of a block of a run, and bytes of a run that stay in memory.
FAN_IN, RUN_ROWS, RUN_BYTES = 64, 1000, 1 << 20

CAPTURE = "url_key string, captured string, page_id long, record_type string, payload_digest string, payload_bytes long, refers_to long, archive string, offset long"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1: 160 bits are four times 40, which are eight digits each."""
    hexed = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(hexed, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def plan_records(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(page_id, url, payload, digest, refers_to): which record each page gets; refers_to is null for a response.

    Of pages with equal payloads of min_bytes or more, that with the largest id is the response; should rows
    repeat this id, each is a response. A null id counts below every other. Digests and ids are aggregated,
    partially before their shuffle, and what a digest's pages refer to meets them by digest and id: payloads are
    shuffled once, and by a key that no payload's many copies share.
    """
    named = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    named = named.withColumn("digest", base32_sha1(F.encode("payload", "UTF-8")))
    ids = named.filter(F.octet_length("payload") >= min_bytes).select("page_id", "digest")
    copies = cut(ids.groupBy("digest").agg(F.max("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1 and first_id is not null").select("digest", "first_id"))
    # rows of a null id and one digest are alike; the rest are told apart by the pair
    revisits = ids.join(copies, "digest").filter(~F.col("page_id").eqNullSafe(F.col("first_id"))).select(F.col("page_id").alias("id"), F.col("digest").alias("of"), F.col("first_id").alias("refers_to")).distinct()
    found = named.join(revisits, F.col("page_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("of")), "left")
    return found.select("page_id", "url", "payload", "digest", "refers_to")


def record_text() -> Column:
    """One record without the two line ends that follow it, from the columns of plan_records()."""
    end = "\r\n"
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{end}Content-Type: text/html; charset=utf-8{end}Content-Length: "), F.octet_length("payload").cast("string"), F.lit(end + end))
    block = F.when(F.col("refers_to").isNull(), F.concat(http, F.col("payload"))).otherwise(http)
    when = F.date_format(F.timestamp_seconds(F.lit(FIRST_CAPTURE) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(DAY_SECONDS))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.concat_ws(
        end,
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")),
        F.concat(F.lit("WARC-Record-ID: "), F.coalesce(urn(F.col("page_id")), F.lit("<urn:page:>"))),
        F.concat(F.lit("WARC-Date: "), when),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("url", r"[\r\n]", "%0A")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(F.col("refers_to").isNotNull(), F.concat(F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{end}WARC-Refers-To: "), urn(F.col("refers_to")))),
        F.concat(F.lit(f"Content-Type: application/http; msgtype=response{end}Content-Length: "), F.octet_length(block).cast("string")),
        F.concat(F.lit(end), block),
    )


def member(record: bytes) -> bytes:
    """The record as a gzip member without its last byte, which is zero: the writer's line end gives it back.

    A member ends in the highest byte of the record's size; where that isn't zero, an empty member follows."""
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    out = packer.compress(record) + packer.flush()
    if out[-1]:
        packer = zlib.compressobj(4, zlib.DEFLATED, 31)
        out += packer.flush()
    return out[:-1]


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, **columns: str) -> None:
    """Writes archives under path, one for each partition of the session's advisory size, by Spark's own committer: a lost or repeated
    task leaves no half archive, and any store that Spark writes to will do. An empty table writes an empty archive."""
    small_batches(pages.sparkSession, 500, "4m")
    planned = plan_records(pages, min_bytes, **columns)

    def pack(batches):
        for b in batches:
            yield pa.record_batch([pa.array([member(r.as_buffer().to_pybytes() + b"\r\n\r\n") for r in b.column(0).cast(pa.large_binary())], pa.binary())], ["member"])

    members = planned.select(record_text().alias("record")).mapInArrow(pack, "member binary")
    # the bytes go through as they are; the line end is the zero byte that they lack
    members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", "\0").mode("overwrite").text(path)


def parse_archive(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, block) of each record, in order; a reader can begin at any offset."""
    view, at = memoryview(data), 0
    while at < len(data):
        start, parts, unpacker = at, [], zlib.decompressobj(31)
        while not unpacker.eof:
            piece = view[at : at + (1 << 16)]
            if not len(piece):
                raise ValueError(f"the record at {start} is cut off")
            parts.append(unpacker.decompress(piece))
            at += len(piece) - len(unpacker.unused_data)
        record = b"".join(parts)
        if not record:
            continue
        head, _, rest = record.partition(b"\r\n\r\n")
        first, *lines = head.decode().split("\r\n")
        if first != "WARC/1.1":
            raise ValueError(f"no record at {start}")
        headers = {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        length = int(headers["content-length"])
        if len(rest) != length + 4:
            raise ValueError(f"the record at {start} is cut off")
        yield start, headers, rest[:length]


def url_key(url: str) -> str:
    """Sort-friendly key: host labels reversed, no scheme, lower case; the empty key for no URL."""
    rest = url.split("://", 1)[-1].lower()
    host, slash, path = rest.partition("/")
    return ",".join(reversed(host.split("@")[-1].split(":")[0].split("."))) + ")/" + path if host else ""


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives; those of an archive are one run, sorted by URL key, time and page."""
    small_batches(spark, 1, "1m")

    def number(urn: str | None):
        digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return int(digits) if digits else None

    def run(batches):
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1)):
                rows = []
                for offset, h, block in parse_archive(data.as_py()):
                    http, _, payload = block.partition(b"\r\n\r\n")
                    digest, length = h["warc-payload-digest"].removeprefix("sha1:"), int(http.rpartition(b"Content-Length: ")[2])
                    if h["warc-type"] == "response":  # a revisit has no payload of its own
                        read = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if (read, len(payload)) != (digest, length):
                            raise ValueError(f"{name}: the payload at {offset} isn't the one that its headers tell")
                        digest, length = read, len(payload)
                    rows.append((url_key(h.get("warc-target-uri", "")), h["warc-date"], number(h["warc-record-id"]), h["warc-type"], digest, length, number(h.get("warc-refers-to")), name.rpartition("/")[2], offset))
                rows.sort(key=order)
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(run, CAPTURE)


NAMES = [part.split()[0] for part in CAPTURE.split(", ")]
KINDS = [pa.int64() if part.endswith("long") else pa.string() for part in CAPTURE.split(", ")]


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), KINDS)], NAMES)


def order(row: tuple):
    """The order of captures; a null id comes first."""
    return row[0], row[1], row[2] is not None, row[2] or 0, row[7], row[8]


class LoserTree:
    """Merges k sorted runs; each step replays the matches on one path from a leaf to the root."""

    def __init__(self, runs: list, key):
        self.runs, self.key = [iter(r) for r in runs], key
        self.k = len(self.runs)
        self.heads = [next(r, None) for r in self.runs]
        self.losers = [-1] * max(1, self.k)
        for leaf in range(self.k):
            self.replay(leaf)

    def beats(self, a: int, b: int) -> bool:
        """Whether the head of run a goes before that of run b; a run that has ended loses, equal heads go by run."""
        if self.heads[a] is None or self.heads[b] is None:
            return self.heads[a] is not None
        x, y = self.key(self.heads[a]), self.key(self.heads[b])
        return x < y or x == y and a < b

    def replay(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0:  # while the tree is built, the first to come waits here
                self.losers[node] = winner
                return
            if self.beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self):
        while self.k and self.heads[top := self.losers[0]] is not None:
            yield self.heads[top]
            self.heads[top] = next(self.runs[top], None)
            self.replay(top)


class Run:
    """A sorted run that is written once and then read once, block by block; small ones stay in memory, larger ones go to a
    temporary file of the task, which is gone when it's closed."""

    def __init__(self, rows: Iterator[tuple] = ()):
        self.file, self.rows = tempfile.SpooledTemporaryFile(RUN_BYTES), []
        self.writer = pa.ipc.new_stream(self.file, pa.schema(list(zip(NAMES, KINDS))))
        for row in rows:
            self.add(row)

    def add(self, row: tuple) -> None:
        self.rows.append(row)
        if len(self.rows) == RUN_ROWS:
            self.writer.write_batch(batch_of(self.rows))
            self.rows = []

    def __iter__(self):
        if self.rows:
            self.writer.write_batch(batch_of(self.rows))
            self.rows = []
        self.writer.close()
        self.file.seek(0)
        with self.file, pa.ipc.open_stream(self.file) as blocks:
            for block in blocks:
                yield from zip(*(c.to_pylist() for c in block.columns))


def merged(runs: Iterator[Run]) -> Iterator[tuple]:
    """All rows of the runs in order; FAN_IN runs at most are open, so that many are merged to longer runs first."""
    held: list[list[Run]] = [[]]  # by how often they have been merged
    for run in runs:
        held[0].append(run)
        for level in range(len(held)):
            if len(held[level]) == FAN_IN:
                longer = Run(LoserTree(held[level], order))
                held[level] = []
                if level + 1 == len(held):
                    held.append([])
                held[level + 1].append(longer)
    left = [run for level in reversed(held) for run in level]
    while len(left) > FAN_IN:
        left = [*left[FAN_IN:], Run(LoserTree(left[:FAN_IN], order))]
    return iter(LoserTree(left, order))


def merge_index(captures: DataFrame, partitions: int | None = None) -> DataFrame:
    """The captures in global order: columns of CAPTURE, with (index_part int, position long): position counts from 0 over
    all parts.

    Ranges of (URL key, time, page) are dealt out, so a URL or host with very many captures takes several
    parts; within each, the pieces of the runs are merged by a loser tree.
    """
    small_batches(captures.sparkSession, 10_000, "4m")
    # equal keys that repeat without end still spread: archive and offset are part of the range
    keys = [F.col("url_key"), F.col("captured"), F.col("page_id").asc_nulls_first(), F.col("archive"), F.col("offset")]
    dealt = captures.repartitionByRange(partitions, *keys) if partitions else captures.repartitionByRange(*keys)

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()

        def runs():
            now = last = piece = None
            for b in batches:
                for row in zip(*(c.to_pylist() for c in b.columns)):
                    if row[7] != now:
                        if piece:
                            yield piece
                        now, piece, last = row[7], Run(), None
                    if last is not None and order(row) < last:
                        raise ValueError(f"the run of {now} isn't sorted")
                    last = order(row)
                    piece.add(row)
            if piece:
                yield piece

        out = []
        for position, row in enumerate(merged(runs())):
            out.append((*row, part, position))
            if len(out) == 10_000:
                yield batch(out)
                out = []
        if out:
            yield batch(out)

    def batch(rows):
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), [*KINDS, pa.int32(), pa.int64()])], [*NAMES, "index_part", "position"])

    # a run's rows come one after another, in the run's own order
    pieces = dealt.sortWithinPartitions("archive", *keys[:3], "offset")
    index = cut(pieces.mapInArrow(run, f"{CAPTURE}, index_part int, position long"))
    # a row for each part
    counts = index.groupBy("index_part").agg(F.count("*").alias("n"))
    earlier = counts.select("index_part", (F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("index_part")) - F.col("n")).alias("shift"))
    return index.join(F.broadcast(earlier), "index_part").withColumn("position", F.col("position") + F.col("shift")).drop("shift")


def archive_round_trip(pages: DataFrame, min_bytes: int = 0, **columns: str) -> DataFrame:
    """Writes the archives to the shared folder, reads them back and merges their index; one row for each page row.

    Null payloads are empty, null URLs have no target and the empty key, null ids stay null. Repeated rows
    have a record each. Ids are whole numbers. The archives are deleted when the driver ends.
    """
    spark = pages.sparkSession
    path = forget_at_exit(spark, f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}")
    write_archives(pages, path, min_bytes, **columns)
    return merge_index(cut(read_archives(spark, path)))
