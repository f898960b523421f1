"""Rows that agree in id and text are one document: substring dedup takes nothing from it for its own sake."""

import pytest

from quire.llm import rlz_dedup, suffix_dedup, windows

TEXT = " ".join(f"w{i}" for i in range(60))
OTHER = " ".join(f"v{i}" for i in range(60))


@pytest.mark.parametrize("hot", [windows.HOT, 1])
@pytest.mark.parametrize("dedup", [rlz_dedup.dedup, suffix_dedup.dedup])
def test_repeated_rows_keep_their_text(spark, monkeypatch, dedup, hot):
    monkeypatch.setattr(windows, "HOT", hot)
    rows = [(1, TEXT)] * 3 + [(None, OTHER)] * 2 + [(2, TEXT)] * 2
    found = sorted((r.doc_id is None, r.doc_id or 0, r.n_removed > 0) for r in dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert found == [(False, 1, False)] * 3 + [(False, 2, True)] * 2 + [(True, 0, False)] * 2
