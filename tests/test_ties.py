"""Ties that an order leaves open have one result, in whatever order rows come."""

from quire.plans import catalog


def test_box_gate_does_not_depend_on_the_order_of_rows(spark, tmp_path):
    rows = [(1, 5, 90, 1, 20.0), (1, 5, 10, 1, 30.0), (1, 5, 10, 1, 10.0), (1, 5, 12, 2, 30.0), (1, 1005, 80, 2, 25.0), (1, 5, 12, 2, 31.0)]
    found = []
    for name, some in (("a", rows), ("b", rows[::-1])):
        frame = spark.createDataFrame(some, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double")
        frame.coalesce(1).write.parquet(f"{tmp_path}/{name}/lineitem.parquet")
        found.append(sorted(map(tuple, catalog.QUERIES["box_gate"](spark, f"{tmp_path}/{name}").collect())))
    assert len(found[0]) == 3 and found[0] == found[1]
