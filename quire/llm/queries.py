"""The queries of the training-data operators, with their production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bm25, bpe, crf, mixing, pii, quality_rules, rlz_dedup, simhash, suffix_dedup, warc
from .common import table

#: The key of a production run comes from its secret store; this one makes the query repeatable.
SURROGATE_KEY = "registered query"
RANKS = "byte_bpe_50k.tiktoken"


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), SURROGATE_KEY)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), total_share=1.5, most=2.0)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op5_rlz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlz_dedup.dedup(table(spark, sf_dir, "documents"), window=20, texts=False)


def op6_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), cutoff=0.3)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.archive_round_trip(table(spark, sf_dir, "pages"), min_bytes=0)
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "position")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return bm25.search(docs, docs.filter("doc_id % 20 = 0"), k=10)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"), window=100, texts=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_pii": op2_pii,
    "op3_simhash": op3_simhash,
    "op4_mixing": op4_mixing,
    "op5_rlz_dedup": op5_rlz_dedup,
    "op6_crf": op6_crf,
    "op7_warc": op7_warc,
    "op8_quality_rules": op8_quality_rules,
    "op9_bm25": op9_bm25,
    "op10_suffix_dedup": op10_suffix_dedup,
}

ORACLE: dict[str, str] = {
    "op7_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h,
                          lower(CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE coalesce(url, '') END) AS rest FROM pages),
        q AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS last_id, split_part(split_part(rest, '/', 1), '@', -1) AS host,
                     CASE WHEN contains(rest, '/') THEN substr(rest, instr(rest, '/') + 1) ELSE '' END AS path FROM p),
        k AS (SELECT *, CASE WHEN split_part(rest, '/', 1) <> '' THEN array_to_string(list_reverse(string_split(split_part(host, ':', 1), '.')), ',') || ')/' || path ELSE '' END AS url_key,
                     strftime(make_timestamp((1577836800 + page_id % 1576800000) * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS captured FROM q)
        SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
               list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, (i // 8)::INT * 10 + 1, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31) + 1)::INT, 1)), 'string_agg', '') AS payload_digest,
               CASE WHEN page_id = last_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> last_id THEN last_id END AS refers_to,
               url_key, captured, row_number() OVER (ORDER BY url_key, captured, page_id) - 1 AS position
        FROM k""",
}
