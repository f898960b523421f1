"""Each stage of the pipeline on all its predecessor kept, against plain versions; null and repeated ids, empty tables."""

import base64
import collections
import hashlib

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline as pipeline
from quire.llm import crf, pii

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def rows(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_quality_keeps_what_the_model_scores_enough(spark, documents):
    model = crf.train(documents, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    kept = pipeline.quality(spark, documents, FOLDER)
    assert kept.columns == documents.columns
    wanted = collections.Counter({r: n for r, n in rows(documents).items() if model.score(r[1] or "") >= 0.3})
    assert rows(kept) == wanted and 0 < len(wanted) < documents.count()


def test_personal_data_changes_texts_with_entities_only(spark, documents):
    out = pipeline.personal_data(spark, documents, FOLDER)
    before, after = {r.doc_id: r.text for r in documents.collect()}, {r.doc_id: r for r in out.collect()}
    assert out.columns == documents.columns and set(before) == set(after)
    for i, text in before.items():
        found = pii.entities(text or "")
        assert (after[i].text == text) == (not found)
        assert after[i].n_chars == len(after[i].text)
        assert not {form for *_, form in found} & {form for *_, form in pii.entities(after[i].text)}


def test_mix_gives_whole_copies(spark, documents):
    out = rows(pipeline.mix(spark, documents, FOLDER))
    size = collections.Counter()
    for r, n in out.items():
        size[r[3]] += n * len((r[1] or "").encode().split())
        assert 1 <= n <= 2
    total = sum(len((r.text or "").encode().split()) for r in documents.collect())
    assert 1.45 * total <= sum(size.values()) <= 1.5 * total


def test_encode_equals_tiktoken(spark, documents):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    for r in pipeline.encode(spark, documents, FOLDER).collect():
        ids = plain.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(texts[r.doc_id].encode()).hexdigest())


def test_run_applies_all_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
    assert rows(pipeline.run(spark, FOLDER)) == rows(docs)
    assert [name for name, _ in pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "mix", "encode"]


def test_odd_rows_and_empty_tables(spark):
    odd = spark.createDataFrame([(None, "a b c " * 30, None, None, 1), (None, None, "en", "s", 0), (1, "", "en", "s", 0), (1, "d e f " * 30, "en", "s", 1), (1, "d e f " * 30, "en", "s", 1)], SCHEMA)
    none = odd.limit(0)
    for name, stage in pipeline.STAGES[1:]:
        assert stage(spark, none, FOLDER).count() == 0, name
    assert rows(pipeline.personal_data(spark, odd, FOLDER)).total() == 5
    mixed = rows(pipeline.mix(spark, odd, FOLDER))
    assert all(r[1] for r in mixed)  # what has no words isn't taken
    assert pipeline.encode(spark, odd, FOLDER).count() == 5
