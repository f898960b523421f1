"""The fit of subset sums against exhaustive search, long documents, targets of sources, and reruns."""

import collections
import itertools
import random

import pytest

from quire.llm import mixing


def best(sizes, counts, budget):
    return max(t for picks in itertools.product(*(range(c + 1) for c in counts)) if (t := sum(s * p for s, p in zip(sizes, picks))) <= budget)


def total(sizes, picks):
    return sum(s * p for s, p in zip(sizes, picks))


def test_subset_sum_is_exhaustive():
    pick = random.Random(1)
    for _ in range(200):
        sizes = pick.sample(range(1, 60), pick.randrange(1, 5))
        counts = [pick.randrange(0, 4) for _ in sizes]
        budget = pick.randrange(0, 200)
        picks = mixing.subset_sum(sizes, counts, budget)
        assert all(p <= c for p, c in zip(picks, counts))
        assert total(sizes, picks) == best(sizes, counts, budget)


@pytest.mark.parametrize("sizes, counts, budget, least", [([300_000, 290_000], [1, 1], 350_625, 300_000), ([200_000, 201_000, 202_000], [1, 1, 1], 230_000, 202_000), ([140_000, 139_000, 10], [1, 1, 3], 200_000, 140_030), ([500_000, 70], [3, 9], 1_000_140, 1_000_140), ([100_000], [1], 99_999, 0)])
def test_long_documents_fit(sizes, counts, budget, least):
    assert total(sizes, mixing.fit(sizes, counts, budget)) == least


def test_fit_comes_near_for_any_unit(monkeypatch):
    pick = random.Random(7)
    for unit in (40, 1000, 1 << 16):
        monkeypatch.setattr(mixing, "FIT_WORDS", unit)
        for _ in range(60):
            sizes = sorted(pick.sample(range(1, 5000), pick.randrange(1, 7)), reverse=True)
            counts = [pick.randrange(1, 4) for _ in sizes]
            budget = pick.randrange(0, total(sizes, counts) + 1)
            picks = mixing.fit(sizes, counts, budget)
            assert all(0 <= p <= c for p, c in zip(picks, counts)) and total(sizes, picks) <= budget
            # nothing that is left would still fit
            assert all(s > budget - total(sizes, picks) for s, c, p in zip(sizes, counts, picks) if p < c)


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """The excess of sources above their limit goes to the others by weight, again and again."""
    names = sorted((x for x in sizes if x is not None), key=lambda x: [ord(c) for c in x]) + ([None] if None in sizes else [])
    weight, budget, out = {x: weights[i % len(weights)] for i, x in enumerate(names)}, share * sum(sizes.values()), {}
    while True:
        open_ = [x for x in names if x not in out]
        rest = budget - sum(out.values())
        now = {x: rest * weight[x] / sum(weight[y] for y in open_) for x in open_}
        above = [x for x in open_ if now[x] >= most * sizes[x]]
        if not above:
            return out | now
        out |= {x: most * sizes[x] for x in above}


def test_mix_meets_its_targets_and_reruns_agree(spark):
    pick = random.Random(3)
    rows = [(i, " ".join(["w"] * pick.randrange(0, 90)), None if i % 11 == 0 else "zebra" if i % 50 == 1 else f"s{i % 5}", "x") for i in range(1200)]
    rows += [(2000, "w " * 300_000, "long", "x"), (2001, "w " * 290_000, "long", "x"), (2002, None, "empty", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size string")
    found = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, again), key=str)
    words, taken, wanted = collections.Counter(), collections.Counter(), {}
    for r in found:
        words[r.source] += r.size
        taken[r.source] += r.taken
        wanted[r.source] = r.target
        assert r.taken <= 2 * r.size and (not r.size or r.taken % r.size == 0)
    expected = targets(dict(words))
    for source, target in expected.items():
        assert abs(wanted[source] - target) < 1e-6 * max(1, target)
        shortest = min(r.size for r in found if r.source == source and r.size) if words[source] else 1
        assert target - max(shortest, 1 if source != "long" else 290_000) <= taken[source] <= target + 1e-6
