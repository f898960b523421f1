"""Every query with an SQL twin gives its rows."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from quire.plans import catalog

DATA = "/root/testdata/sf0.001"


def plain(frame):
    def value(x):
        if x is None or x is pd.NA or x != x:
            return None
        if isinstance(x, float):
            return round(x, 9)
        return int(x) if hasattr(x, "item") and not isinstance(x, bool) else x

    rows = frame[sorted(frame.columns)].astype(object).values.tolist()
    return sorted(tuple((x is None, str(value(x))) for x in row) for row in rows)


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_matches_sql(spark, sql, name):
    assert plain(catalog.QUERIES[name](spark, DATA).toPandas()) == plain(sql.execute(catalog.ORACLE[name]).df())


def test_edit_counts_add_up_to_the_distance(spark):
    rows = catalog.QUERIES["edit_breakdown"](spark, DATA)
    assert rows.count() > 0
    assert rows.filter("n_sub + n_del + n_ins <> edits").count() == 0


def test_minimal_edits_equal_a_plain_version(spark):
    texts = {(r.doc_id, i + 1): t for r in spark.read.parquet(f"{DATA}/documents.parquet").collect() if r.text is not None for i, t in enumerate(r.text.split("\n"))}
    found = catalog.QUERIES["minimal_edits"](spark, DATA).collect()
    assert len(found) == len(texts)
    for r in found:
        text, rejected = texts[r.doc_id, r.line_no], []
        for find, new in (("the", "teh"), ("e", "E"), ("missing!", "x")):
            if find in text:
                text = text.replace(find, new, 1)
            else:
                rejected.append(find)
        assert (r.text, r.rejected) == (text, rejected)
