"""The pieces of SimHash that need no session: long texts, and groups linked within large buckets."""

import numpy as np
import pytest
import xxhash

from quire.llm import simhash


@pytest.mark.parametrize("n", [1, 4, 5, simhash.COUNTED + 3, simhash.COUNTED + 4, 2 * simhash.COUNTED + 9])
def test_fingerprint_of_pieces_is_that_of_the_whole(n):
    words = [b"w%d" % (i * i % 97) for i in range(n)]
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, n - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    expected = sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(b"\t".join(words)) == expected


@pytest.mark.parametrize("size", [1, 70, 900])
def test_groups_of_a_large_bucket(size):
    random = np.random.default_rng(size)
    one = lambda: np.uint64(1) << random.integers(0, 64, size, dtype=np.uint64)
    x = np.unique(random.integers(0, 2**63, 6, dtype=np.uint64)[random.integers(0, 6, size)] ^ one() ^ one() ^ one())
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= 3
    expected = np.arange(len(x))
    while True:  # the smallest place among neighbours, until nothing moves
        now = np.where(near, expected[None, :], len(x)).min(axis=1)
        if (now == expected).all():
            break
        expected = now
    assert simhash._reached(x, 3).tolist() == expected.tolist()
