"""edit_breakdown compares whole lines, however long."""

import random

import pytest

from quire.functions.edit_ops import count_edits
from quire.plans import catalog


def plain(ref, hyp):
    """Substitutions, deletions and insertions from the whole table, walked back with gaps before pairs."""
    table = [list(range(len(hyp) + 1))]
    for i, c in enumerate(ref, 1):
        row = [i]
        for j, h in enumerate(hyp, 1):
            row.append(min(table[-1][j] + 1, row[-1] + 1, table[-1][j - 1] + (c != h)))
        table.append(row)
    i, j, out = len(ref), len(hyp), [0, 0, 0]
    while i or j:
        if i and table[i - 1][j] + 1 == table[i][j]:
            i, out[1] = i - 1, out[1] + 1
        elif j and table[i][j - 1] + 1 == table[i][j]:
            j, out[2] = j - 1, out[2] + 1
        else:
            i, j = i - 1, j - 1
            out[0] += ref[i] != hyp[j]
    return tuple(out)


@pytest.mark.parametrize("n", [0, 1, 64, 255, 256, 257, 512, 700])
def test_counts_of_long_texts(n):
    pick = random.Random(n)
    ref = "".join(pick.choice("abet") for _ in range(n))
    hyp = "".join(c for c in ref.translate(str.maketrans("ae", "eo")) if pick.random() > 0.1)
    assert count_edits(ref, hyp) == plain(ref, hyp)


def test_breakdown_of_whole_lines(spark, tmp_path):
    pick = random.Random(1)
    lines = [" ".join(pick.choice(["the", "oat", "hut", "dry"]) for _ in range(n)) for n in (5, 40, 200)]
    spark.createDataFrame([(1, i, "user", t) for i, t in enumerate(lines)], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    rows = catalog.QUERIES["edit_breakdown"](spark, str(tmp_path)).collect()
    found = sorted((r.n_sub, r.n_del, r.n_ins, r.edits) for r in rows)
    wanted = [plain(x, x.translate(str.maketrans("aeo", "eoa")).replace("th", "t")) for x in lines]
    assert found == sorted((*w, sum(w)) for w in wanted)
