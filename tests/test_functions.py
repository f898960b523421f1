import random
import time

from pyspark.sql import functions as F

from quire.functions import text as T
from quire.functions.edit_ops import count_edits, distance
from quire.operators import core
from quire.plans import catalog
from quire.sources import sinks, tables
from quire.streaming import jobs


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_edit_counts():
    assert count_edits("abc", "abc") == (0, 0, 0)
    assert count_edits("", "xy") == (0, 0, 2)
    assert count_edits("kitten", "sitting") == (2, 0, 1)


def test_regions(spark):
    names = ["region_03_header", "column_1", "rejected"]
    rows = spark.createDataFrame([(n,) for n in names], "n string").select(T.parse_region(F.col("n")).alias("r")).collect()
    assert [r["r"] and tuple(r["r"]) for r in rows] == [(3, "header"), (1, "left"), None]
    assert one(spark, T.region_type(F.lit("region_01_left/line_002"))) == "left"
    assert one(spark, T.region_type(F.lit("column_1/line_002"))) is None
    assert one(spark, T.line_id(F.lit("region_01_left"), F.lit(7))) == "region_01_left/line_007"


def test_repetition_and_fences(spark):
    assert one(spark, T.is_repetitive(F.lit("ab ab abab a")))
    assert not one(spark, T.is_repetitive(F.lit("abcd")))
    assert one(spark, T.strip_fences(F.lit("```json\n{}\n```"))) == "{}"
    assert one(spark, T.replace_first(F.lit("a-a"), F.lit("a"), F.lit("b"))) == "b-a"
    assert one(spark, T.percent(F.lit(None).cast("double"))) == "—"
    assert one(spark, T.cer(F.lit(" ab "), F.lit("ac"))) == 0.5
    assert one(spark, T.cer(F.lit(" "), F.lit("ac"))) is None


def test_runs_bridge_gaps(spark):
    rows = spark.createDataFrame([(1, i, i not in (3, 7, 8)) for i in range(10)], "k int, i int, on boolean")
    found = lambda gap: sorted((r.run_start, r.run_end) for r in core.runs(rows, ["k"], "i", F.col("on"), gap).collect())
    assert found(0) == [(0, 2), (4, 6), (9, 9)]
    assert found(1) == [(0, 6), (9, 9)]
    assert found(2) == [(0, 9)]


def test_overlap_first_wins_and_none(spark):
    new = spark.createDataFrame([(1, 0, 0, 10), (1, 1, 50, 60)], "k int, n_id int, n_start int, n_end int")
    old = spark.createDataFrame([(1, 5, 0, 5), (1, 6, 5, 10)], "k int, o_id int, o_start int, o_end int")
    assert sorted(tuple(r) for r in core.best_overlap(new, old, "k").collect()) == [(1, 0, 5, 5), (1, 1, -1, 0)]


def test_ledger_keeps_the_new_row(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    assert sorted(tuple(r) for r in sinks.merge_ledger(old, new, ["k"]).collect()) == [("a", 1), ("b", 3), ("c", 4)]


def test_ledger_takes_the_last_of_equal_new_rows(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    for rows in ([("a", 3), ("a", 7)], [("a", 7), ("a", 3)]):
        assert [tuple(r) for r in sinks.merge_ledger(old, spark.createDataFrame(rows, "k string, v int"), ["k"]).collect()] == [("a", 7)]


def test_run_partitions_are_replaced_one_by_one(spark, tmp_path):
    path = str(tmp_path / "run")
    sinks.write_run(spark.createDataFrame([("c", "p1", 1), ("c", "p2", 2)], "config_slug string, page_id string, v int"), path)
    sinks.write_run(spark.createDataFrame([("c", "p2", 9)], "config_slug string, page_id string, v int"), path)
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 9]


def test_sources(spark, tmp_path):
    (tmp_path / "line_001.txt").write_text("a\nb\n\n")
    assert [tuple(r) for r in tables.label_files(spark, str(tmp_path / "*.txt")).collect()] == [("line_001", "a\nb")]
    (tmp_path / "p.json").write_text('{"model_tag": "m", "base_id": "page_0001", "lines": {"l1": {"pred_beam": "x"}}}')
    row = tables.predictions(spark, str(tmp_path / "p.json")).first()
    assert (row.page_id, row.line_id, row.pred_beam, row.non_character, row.ink_ratio) == ("page_0001", "l1", "x", False, 0.0)


def test_stream_works_once_for_each_job(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    work = lambda rows: rows.withColumn("done", F.lit(True))
    for part in ([1, 2, None], [2, 3, None]):
        spark.createDataFrame([(i,) for i in part], "job long").write.mode("append").parquet(source)
        stream = jobs.read_jobs(spark, source, "job long")
        jobs.process(stream, work, out, str(tmp_path / "state"), ["job"]).awaitTermination()
    assert sorted(r.job or 0 for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3]


def test_edit_distance_of_long_texts(spark):
    # by the whole table, in plain steps
    def table(ref, hyp):
        rows = [list(range(len(hyp) + 1))]
        for i, a in enumerate(ref, 1):
            rows.append([i])
            for j, b in enumerate(hyp, 1):
                rows[i].append(min(rows[i - 1][j] + 1, rows[i][j - 1] + 1, rows[i - 1][j - 1] + (a != b)))
        return rows

    def walked(ref, hyp):
        rows, i, j, found = table(ref, hyp), len(ref), len(hyp), [0, 0, 0]
        while i or j:
            if i and rows[i - 1][j] + 1 == rows[i][j]:
                i, found[1] = i - 1, found[1] + 1
            elif j and rows[i][j - 1] + 1 == rows[i][j]:
                j, found[2] = j - 1, found[2] + 1
            else:
                i, j, found[0] = i - 1, j - 1, found[0] + (ref[i - 1] != hyp[j - 1])
        return tuple(found)

    draw = random.Random(3)
    for n in (0, 1, 2, 5, 40, 63, 64, 65, 256, 257, 600):
        ref, hyp = ("".join(draw.choice("abé\U0001d11e") for _ in range(draw.randint(max(0, n - 9), n))) for _ in range(2))
        assert count_edits(ref, hyp) == walked(ref, hyp)
        assert one(spark, T.edits(F.lit(f" {ref}"), F.lit(hyp))) == sum(walked(ref, hyp)) == distance(ref, hyp)
    assert one(spark, T.edits(F.lit(None).cast("string"), F.lit("a"))) is None


def test_edits_of_turns_take_little_time():
    ref = "the quick brown fox jumps over a lazy dog " * 12
    start = time.process_time()
    for i in range(200):
        count_edits(f"{i}{ref}", ref.translate(str.maketrans("aeo", "eoa")))
    assert time.process_time() - start < 1.2


def test_pairs_are_dealt_to_all_cores(spark):
    assert core.spread(spark.range(1000).coalesce(1)).rdd.glom().map(len).filter(lambda n: n > 0).count() > 4


def test_tasks_of_gathered_rows_grow_with_them(spark, monkeypatch):
    monkeypatch.setattr(core, "GATHERED", 100)
    rows = spark.range(2000).selectExpr("id % 500 AS k", "id")
    held = [{r.k for r in part} for part in core.gathered(rows, "k").rdd.glom().collect()]
    assert len(held) == 21 and sum(map(len, held)) == 500
    for name in ("label_split", "reslice_tally"):
        plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert "REPARTITION_BY_NUM" in plan
