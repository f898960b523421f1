"""Substring dedup: factors, hot anchors, chunks, long periodic texts and hash collisions, against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from quire.llm import rlz_dedup, suffix_dedup, windows


def removed(parts, window):
    """How many tokens of each (id, tokens) are covered by a window that also starts earlier, and the kept ones."""
    seen, out = set(), {}
    for i, x in sorted(parts, key=lambda p: (p[0] is not None, p[0] or 0)):
        marks = bytearray(len(x))
        for p in range(len(x) - window + 1):
            w = tuple(x[p : p + window])
            if w in seen:
                marks[p : p + window] = b"\1" * window
            seen.add(w)
        out[i] = sum(marks), [t for t, m in zip(x, marks) if not m]
    return out


def passages(seed, docs):
    """Texts that share passages in changing surroundings, at changing places, with odd white space."""
    pick = random.Random(seed)
    word = lambda: f"{pick.choice('abcdefgh')}{pick.randrange(400)}"
    shared = [[word() for _ in range(pick.randrange(25, 80))] for _ in range(6)]
    out = []
    for _ in range(docs):
        words = []
        for _ in range(pick.randrange(0, 6)):
            words += [word() for _ in range(pick.randrange(0, 40))]
            passage = pick.choice(shared)
            i = pick.randrange(0, 15)
            words += passage[i : len(passage) - pick.randrange(0, 15)]
        out.append("".join(w + pick.choice([" ", "\n", "  ", "\t "]) for w in words))
    return out


TEXTS = [*passages(1, 60), "", None, "a " * 900, "a" * 5000, "ab" * 3000, "é \u3000x " * 300, " ".join(map(str, range(3000)))]


def check(spark, dedup, window, cut, join):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, key long, chunk string").repartition(5)
    wanted = removed([(i, cut((t or "").encode())) for i, t in enumerate(TEXTS)], window)
    rows = dedup(docs, window).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        n, kept = wanted[r.doc_id]
        assert (r.n_removed, r.kept_sha256) == (n, hashlib.sha256(join.join(kept)).hexdigest()), r.doc_id
    assert sum(n for n, _ in wanted.values()) > 1000


@pytest.mark.parametrize("hot, chunk", [(windows.HOT, windows.CHUNK_BYTES), (2, 1000), (10, 4000)])
def test_words_equal_brute_force(spark, monkeypatch, hot, chunk):
    monkeypatch.setattr(windows, "HOT", hot)
    monkeypatch.setattr(windows, "CHUNK_BYTES", chunk)
    check(spark, rlz_dedup.dedup, 20, bytes.split, b" ")


@pytest.mark.parametrize("hot, chunk", [(windows.HOT, windows.CHUNK_BYTES), (2, 1000), (10, 4000)])
def test_bytes_equal_brute_force(spark, monkeypatch, hot, chunk):
    monkeypatch.setattr(windows, "HOT", hot)
    monkeypatch.setattr(windows, "CHUNK_BYTES", chunk)
    check(spark, suffix_dedup.dedup, 100, lambda t: [bytes([b]) for b in t], b"")


def test_factors_are_greedy_and_looked_up_at_their_boundaries():
    index = {}
    assert list(rlz_dedup.factors(b"a b c d e f g".split(), index, 3)) == []
    # one factor along the reference, though it holds five windows
    assert list(rlz_dedup.factors(b"x a b c d e f g y".split(), index, 3)) == [(1, 8)]
    # two references that overlap: the boundary's window is found in the second
    index = {}
    list(rlz_dedup.factors(b"a b c d".split(), index, 3))
    list(rlz_dedup.factors(b"c d e f".split(), index, 3))
    assert list(rlz_dedup.factors(b"a b c d e f".split(), index, 3)) == [(0, 4), (2, 6)]
    # a text is a reference to its own rest
    assert list(rlz_dedup.factors(b"a b c x a b c y".split(), {}, 3)) == [(4, 7)]


def test_pieces_give_the_same_anchors(monkeypatch):
    texts = pa.array([t or "" for t in TEXTS])
    for parse, window, k in ((rlz_dedup.parse, 20, 8), (suffix_dedup.parse, 100, 16)):
        found = []
        for piece in (1 << 20, 300):
            monkeypatch.setattr(windows, "PIECE", piece)
            monkeypatch.setattr(rlz_dedup, "PIECE", piece)
            t, each = parse(texts), {}
            for keys, first, last, off in windows.anchors(t, window, k):
                for key, i, j, o in zip(keys, first, last, off):
                    each.update({p: (key, i + o) for p in range(i, j + 1)})
            found.append(each)
        assert found[0] == found[1]
        assert len(found[0]) == sum(max(0, n - window + 1) for n in np.diff(t.bounds))


def test_words_of_a_column():
    t = rlz_dedup.parse(pa.array(["x", " ab  c\n", "", "d", "\t"]).slice(1))
    assert t.cut(np.array([0, 0, 2]), np.array([1, 0, 2])) == [b"ab c", b"ab", b"d"]
    assert t.bounds.tolist() == [0, 2, 2, 3, 3]


def test_a_collision_is_mended(monkeypatch):
    rows = [(7, doc, 0, 0, 0, seg, 0, False) for doc, seg in ((1, b"abcdeabc"), (2, b"zbcdeabc"), (3, b"abcdeabc"[:7] + b"x"), (4, b"zbcdeabd"))]
    wanted = sorted(suffix_dedup.repeated(rows, 6))
    assert wanted == [(2, 0, 1, 8), (3, 0, 0, 7), (4, 0, 0, 7)]
    monkeypatch.setattr(suffix_dedup, "suffix_sort", lambda text, starts, blocks, most: np.lexsort((-starts, blocks)))
    assert sorted(suffix_dedup.repeated(rows, 6)) == wanted


def test_only_windows_that_repeat_are_sorted(monkeypatch):
    # equal windows: the middle of the first two rows; the others share the anchor alone
    anchor = b"0123456789"
    rows = [(7, d, 0, 0, 30, own[:10] + anchor + own[10:], 10, False) for d, own in enumerate((b"abcdefghijABCDEFGHIJ", b"vwxdefghijABCDEFGXYZ", b"zyxwvutsrqZYXWVUTSRQ", b"mnopqrstuvMNOPQRSTUV"))]
    asked, sort = [], suffix_dedup.suffix_sort

    def counted(text, starts, blocks, most):
        asked.append(len(starts))
        return sort(text, starts, blocks, most)

    monkeypatch.setattr(suffix_dedup, "suffix_sort", counted)
    assert sorted(suffix_dedup.repeated(rows, 16)) == [(1, 0, 3, 27)]
    assert asked == [9]
    assert list(suffix_dedup.repeated(rows[2:], 16)) == []
