"""Queries over label events, saved boxes and plans of moves."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import changes
from quire.plans.registry import query
from quire.sources.tables import table

EVENTS = "SELECT user_id AS page, event_id % 7 AS line, ts, event_id, CASE WHEN event_type IN ('view', 'signup') THEN 'submit' WHEN event_type = 'click' THEN 'empty' WHEN event_type = 'error' THEN 'reject' ELSE 'skip' END AS action, CASE WHEN event_id % 5 = 0 THEN '  ' ELSE 'v' || event_id || chr(10) END AS text FROM events"


def _events(spark, folder):
    kind = F.col("event_type")
    action = F.when(kind.isin("view", "signup"), "submit").when(kind == "click", "empty").when(kind == "error", "reject").otherwise("skip")
    text = F.when(F.col("event_id") % 5 == 0, "  ").otherwise(F.concat(F.lit("v"), F.col("event_id").cast("string"), F.lit("\n")))
    return table(spark, folder, "events").select(F.col("user_id").alias("page"), (F.col("event_id") % 7).alias("line"), "ts", "event_id", action.alias("action"), text.alias("text"))


@query(f"WITH e AS (SELECT *, lag(action) OVER w AS before, row_number() OVER (PARTITION BY page, line ORDER BY ts DESC, event_id DESC) AS k, count(*) OVER (PARTITION BY page, line) AS n FROM ({EVENTS}) WHERE action <> 'skip' WINDOW w AS (PARTITION BY page, line ORDER BY ts, event_id)) SELECT page, line, max(CASE WHEN k = 1 THEN CASE WHEN action = 'reject' THEN 'rejected' WHEN action = 'submit' AND trim(text) <> '' THEN 'labeled' ELSE 'empty' END END) AS status, max(CASE WHEN k = 1 THEN CASE WHEN action = 'submit' AND trim(text) <> '' THEN rtrim(text, chr(10)) ELSE '' END END) AS text, count(*) AS n_events, count(*) FILTER (action <> 'reject' AND before = 'reject') AS n_unrejected FROM e GROUP BY page, line")
def label_events(spark, folder):
    """DML-01, DML-04: the state of each line after all that was submitted, emptied or rejected."""
    return changes.label_states(_events(spark, folder), ["page", "line"], ["ts", "event_id"])


@query("SELECT page, source, angle, n_saves FROM (SELECT *, row_number() OVER (PARTITION BY page ORDER BY source = 'human' DESC, ts DESC, event_id DESC) AS k, count(*) OVER (PARTITION BY page) AS n_saves FROM (SELECT event_id % 500 AS page, CASE WHEN event_type = 'click' THEN 'human' ELSE 'auto' END AS source, value AS angle, ts, event_id FROM events)) WHERE k = 1")
def saved_boxes(spark, folder):
    """DML-02: no automatic save replaces a human one."""
    source = F.when(F.col("event_type") == "click", "human").otherwise("auto")
    events = table(spark, folder, "events").select((F.col("event_id") % 500).alias("page"), source.alias("source"), F.col("value").alias("angle"), "ts", "event_id")
    return changes.saved(events, ["page"], ["ts", "event_id"], ["angle"])


@query("WITH o AS (SELECT o_orderkey AS n, 'page_' || o_orderkey AS plain, 'page_' || CASE WHEN o_orderkey < 10000 THEN lpad(o_orderkey::VARCHAR, 4, '0') ELSE o_orderkey::VARCHAR END || '_auto' AS full_name FROM orders), f AS (SELECT n, plain AS name, full_name FROM o WHERE n % 3 <> 0 UNION ALL SELECT n, full_name, full_name FROM o WHERE n % 3 = 0 OR n % 10 = 0) SELECT name AS src, full_name AS dst, full_name IN (SELECT name FROM f) AS blocked FROM f WHERE name <> full_name")
def rename_plan(spark, folder):
    """DML-05: names that a migration would change, and those it can't."""
    n = F.col("o_orderkey")
    orders = table(spark, folder, "orders").select(n, T.page_artifact_id(n, F.lit("auto")).alias("full_name"))
    plain = orders.filter(n % 3 != 0).select(F.concat(F.lit("page_"), n.cast("string")).alias("name"), "full_name")
    names = plain.unionByName(orders.filter((n % 3 == 0) | (n % 10 == 0)).select(F.col("full_name").alias("name"), "full_name"))
    return changes.move_plan(names, "name", F.col("full_name"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey BETWEEN 100 AND 5000 UNION ALL SELECT -o_orderkey FROM orders WHERE o_orderkey IN (1, 7, 33, 99999999)")
def page_selection(spark, folder):
    """FLT-20: a range of pages, and a list of them as negative numbers."""
    orders, n = table(spark, folder, "orders"), F.col("o_orderkey")
    listed = orders.filter(changes.page_selected(n, pages=[1, 7, 33, 99999999])).select((-n).alias("o_orderkey"))
    return orders.filter(changes.page_selected(n, first=100, last=5000)).select("o_orderkey").unionByName(listed)
