"""Label events, saved values and plans of moves on nulls, ties of source, and after the moves."""

from pyspark.sql import functions as F

from quire.operators import changes


def test_label_events(spark):
    rows = [(1, 1, "reject", None), (1, 2, "submit", "a\n\n"), (2, 1, "submit", " \n"), (3, 1, None, "x"), (3, 2, "drop", "x"), (4, 1, "submit", "b"), (4, 2, "reject", "c"), (None, 1, "empty", "d")]
    found = changes.label_states(spark.createDataFrame(rows, "line int, at int, action string, text string"), ["line"], ["at"]).collect()
    assert {tuple(r) for r in found} == {(1, "labeled", "a", 2, 1), (2, "empty", "", 1, 0), (4, "rejected", "", 2, 0), (None, "empty", "", 1, 0)}
    assert changes.label_states(spark.createDataFrame([], "line int, at int, action string, text string"), ["line"], ["at"]).count() == 0


def test_human_saves_stay(spark):
    rows = [(1, 1, "human", 5), (1, 2, "auto", 6), (2, 1, "auto", 7), (2, 2, None, 8), (3, 1, "human", 1), (3, 2, "human", 2)]
    found = changes.saved(spark.createDataFrame(rows, "page int, at int, source string, box int"), ["page"], ["at"], ["box"]).collect()
    assert {(r.page, r.box) for r in found} == {(1, 5), (2, 8), (3, 2)}


def test_plans_are_blocked_idempotent_and_reversible(spark):
    names = spark.createDataFrame([("a",), ("b",), ("B",), ("c",), ("c ",), (None,)], "name string")
    target = F.upper(F.trim("name"))
    plan = changes.move_plan(names, "name", target)
    assert {tuple(r) for r in plan.collect()} == {("a", "A", False), ("b", "B", True), ("c", "C", True), ("c ", "C", True)}
    assert [tuple(r) for r in changes.reversed_plan(plan).collect()] == [("A", "a")]
    after = names.filter("name is null or name <> 'a'").unionByName(spark.createDataFrame([("A",)], "name string"))
    assert changes.move_plan(after, "name", target).filter("not blocked").count() == 0


def test_page_selection(spark):
    def of(**how):
        return [r.id for r in spark.range(6).filter(changes.page_selected(F.col("id"), **how)).collect()]

    assert (of(), of(pages=[]), of(pages=[5, 9], first=0), of(first=4), of(first=1, last=2), of(last=0)) == ([0, 1, 2, 3, 4, 5], [], [5], [4, 5], [1, 2], [0])
