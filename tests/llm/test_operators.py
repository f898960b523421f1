"""Each operator against a plain version, and on nulls, empty and long texts, ties, repeats, empty tables and extra columns."""

import base64
import collections
import hashlib
import math

import public_tokenizers
import pytest
import tiktoken

from quire.llm import bm25, bpe, crf, mixing, pii, quality_rules, rlz_dedup, simhash, suffix_dedup, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, seg string, size long"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
TEXTS = ["the cat sat on the mat " * 8, "the cat sat on the mat " * 8, "", None, "  \n ", LONG, LONG + " tail", "é" * 400, "mail a.b@mail.example.com or 10.1.2.3\n" * 3, "aaaa " * 60]
ROWS = [(i, t, "en", None if i % 3 == 0 else f"s{i % 2}", 0, 1, "x", 2) for i, t in enumerate(TEXTS)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(0, 1), (1, 1), (5, 0), (7, 0), (None, 1), (8, None)], "doc_id long, quality int")


def covered(sequences, window):
    seen, out = set(), {}
    for i, x in sequences:
        marks = bytearray(len(x))
        for p in range(len(x) - window + 1):
            w = tuple(x[p : p + window])
            if w in seen:
                marks[p : p + window] = b"\1" * window
            seen.add(w)
        out[i] = marks
    return out


def test_bpe(docs, none):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for row in bpe.round_trip(docs, path, public_tokenizers.PATTERN).collect():
        text = TEXTS[row.doc_id] or ""
        ids = plain.encode_ordinary(text)
        assert (row.n_tokens, row.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.round_trip(none, path, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("name", ["rlz", "suffix"])
def test_substring_dedup(docs, none, name):
    if name == "rlz":
        found, parts, joiner = rlz_dedup.dedup(docs, 20), [(i, (t or "").encode().split()) for i, t in enumerate(TEXTS)], b" "
        assert rlz_dedup.dedup(none, 20).count() == 0
    else:
        found, parts, joiner = suffix_dedup.dedup(docs, 100), [(i, [bytes([b]) for b in (t or "").encode()]) for i, t in enumerate(TEXTS)], b""
        assert suffix_dedup.dedup(none, 100).count() == 0
    marks = covered(parts, 20 if name == "rlz" else 100)
    rows = {r.doc_id: r for r in found.collect()}
    assert len(rows) == len(TEXTS)
    for i, x in parts:
        kept = joiner.join(w for w, m in zip(x, marks[i]) if not m)
        assert (rows[i].n_removed, rows[i].kept_sha256) == (sum(marks[i]), hashlib.sha256(kept).hexdigest())


def test_suffix_sort_is_lexicographic():
    import numpy as np

    data = b"mississippi banana mississippi ananas" * 3
    text, starts = suffix_dedup.HashedText(data), np.arange(len(data) - 20)
    order = suffix_dedup.suffix_sort(text, starts, np.zeros(len(starts), np.int64), 20)
    assert [data[i : i + 20] for i in starts[order]] == sorted(data[i : i + 20] for i in starts)


def test_simhash(spark, docs, none):
    rows = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    prints = {i: simhash.fingerprint((t or "").encode()) for i, t in enumerate(TEXTS)}
    root = {i: i for i in prints}
    for _ in prints:
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 4:
                    root[a] = root[b] = min(root[a], root[b])
    assert {i: r.component_id for i, r in rows.items()} == root
    assert simhash.near_duplicates(none).count() == 0


def test_pii(docs, none):
    rows = {r.doc_id: r for r in pii.pseudonymize(docs, "key").collect()}
    assert rows[3].text is None and rows[3].n_entities == 0 and rows[2].text == ""
    assert rows[8].n_entities == 6 and "a.b@mail" not in rows[8].text and "10.1.2.3" not in rows[8].text
    assert len(set(rows[8].text.strip().split("\n"))) == 1  # coreference
    assert rows[8].text.split("or 10.")[1]  # stays in its private range
    assert pii.pseudonymize(none, "key").count() == 0


def test_pii_formats_and_distinct_surrogates(spark):
    number = pii.draw(b"k", "card", "4532015112830366", 0)
    assert pii.luhn(number) and number[0] == "4"
    assert pii.render("19995550000", "+1 (499) 555-6503", "phone") == "+1 (999) 555-0000"
    assert pii.draw(b"k", "name.given.f.cyrillic", "анна", 0)[-1] == "а"
    found = spark.createDataFrame([("email", f"{a}{b}@x.io") for a in "abcdefghij" for b in "klmnopqrst"], "kind string, form string")
    again = {(r["kind"], r["form"]): r["attempt"] for r in pii.attempts(found, b"k").collect()}
    drawn = [pii.draw(b"k", r.kind, r.form, again.get((r.kind, r.form), 0)) for r in found.collect()]
    assert len(set(drawn)) == 100 and not set(drawn) & {r.form for r in found.collect()}


def test_mixing(docs, none):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(TEXTS) and all(r.taken <= 2 * r.size for r in rows)
    taken = collections.Counter()
    for r in rows:
        taken[r.source] += r.taken
    assert all(taken[r.source] <= r.target + 1e-6 for r in rows)
    assert mixing.mix(none).count() == 0
    assert mixing.subset_sum([5, 3], [1, 2], 9) == [1, 1]


def test_crf(docs, none, labels):
    rows = {r.doc_id: r for r in crf.score(docs, labels).collect()}
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows.values())
    assert rows[2].score == rows[3].score == rows[4].score
    assert crf.score(none, labels).count() == 0
    assert crf.score(docs, labels.limit(0)).count() == len(TEXTS)


def test_crf_marginals_match_enumeration():
    import itertools

    import numpy as np

    scores, moves = np.array([0.5, -1.0, 2.0]), np.array([[0.3, -0.2], [0.1, 0.4]])
    weight = {s: math.exp(sum(scores[i] * s[i] for i in range(3)) + sum(moves[s[i], s[i + 1]] for i in range(2))) for s in itertools.product((0, 1), repeat=3)}
    want = [sum(w for s, w in weight.items() if s[i]) / sum(weight.values()) for i in range(3)]
    assert np.allclose(crf.forward_backward([scores], moves)[0][0], want)


def test_warc(spark):
    pages = spark.createDataFrame([(1, "http://a.b/x", "<p>"), (2, "http://a.b/y", "<p>"), (3, None, None), (4, "http://a.b/x", "q\r\n\r\nz")], "page_id long, url string, html string")
    rows = {r.page_id: r for r in warc.archive_round_trip(pages).collect()}
    assert (rows[1].record_type, rows[1].refers_to, rows[2].record_type) == ("revisit", 2, "response")
    assert rows[4].payload_digest == base64.b32encode(hashlib.sha1(b"q\r\n\r\nz").digest()).decode()
    assert rows[3].payload_bytes == 0
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_loser_tree_merges():
    runs = [[1, 4, 9], [], [2, 2], [0, 10]]
    assert list(warc.LoserTree(runs, key=lambda x: x)) == [0, 1, 2, 2, 4, 9, 10]


def test_quality_rules(docs, none, labels):
    rows = {r.doc_id: r for r in quality_rules.judge(docs, labels).collect()}
    for i, t in enumerate(TEXTS):
        words = (t or "").encode().split()
        triples = collections.Counter(zip(words, words[1:], words[2:]))
        marks = {j + k for j in range(len(words) - 2) if triples[tuple(words[j : j + 3])] > 1 for k in range(3)}
        assert (rows[i].n_words, rows[i].n_repeat_words) == (len(words), len(marks))
        assert rows[i].base_failed == (len(words) < 50 or 100 * len(marks) > 50 * len(words))
    assert quality_rules.judge(none, labels).count() == 0


def test_bm25(docs, none):
    rows = collections.defaultdict(list)
    for r in bm25.search(docs, docs.filter("doc_id in (0, 2, 5, 8)"), k=3).collect():
        rows[r.query_id].append((r["rank"], r.doc_id, r.score))
    counts = [collections.Counter((t or "").encode().lower().split()) for t in TEXTS]
    df = collections.Counter(w for c in counts for w in c)
    mean = sum(sum(c.values()) for c in counts) / len(counts)
    idf = {w: math.log(1 + (len(counts) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    for q in (0, 2, 5, 8):
        score = lambda c: sum(n * idf[w] * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)) for w, n in counts[q].items() if w in c)
        want = sorted(((-s, i) for i, c in enumerate(counts) if (s := score(c)) > 0))[:3]
        assert [i for _, i, _ in sorted(rows[q])] == [i for _, i in want]
        assert all(abs(s + w) < 1e-6 for (_, _, s), (w, _) in zip(sorted(rows[q]), want))
    assert bm25.search(none, none, k=3).count() == 0
