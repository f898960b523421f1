"""Review and bookkeeping over pages, lines and runs: an order stands for a page, a line item for a line, a part for a crop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import geometry as G
from quire.functions import text as T
from quire.operators import core
from quire.plans.registry import query
from quire.sources.tables import table

LINES = "SELECT l_orderkey AS page, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate, l_tax, l_discount))::INTEGER AS line, CASE l_returnflag WHEN 'N' THEN 'region_01_header' WHEN 'A' THEN 'region_02_left' ELSE 'region_03_right' END AS region, 't' || l_partkey AS text, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem"


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    region = F.when(F.col("l_returnflag") == "N", "region_01_header").when(F.col("l_returnflag") == "A", "region_02_left").otherwise("region_03_right")
    # line numbers repeat within an order
    number = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate", "l_tax", "l_discount"))
    return core.gathered(table(spark, folder, "lineitem"), "l_orderkey").withColumns({"page": F.col("l_orderkey"), "line": number, "region": region, "text": F.concat(F.lit("t"), F.col("l_partkey").cast("string"))})


STATUS = "CASE WHEN l_tax = 0 THEN 'rejected' WHEN l_linestatus = 'O' THEN 'pending' WHEN l_discount > 0 THEN 'labeled' ELSE 'empty' END"


def _with_status(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("l_discount") > 0, F.col("text")).otherwise(" ")
    return _lines(spark, folder).withColumn("status", core.line_status(F.col("l_tax") == 0, F.col("l_linestatus") != "O", label))


@query(f"SELECT page, count(*) FILTER (s = 'labeled') AS labeled, count(*) FILTER (s = 'empty') AS empty, count(*) FILTER (s = 'pending') AS pending, count(*) FILTER (s = 'rejected') AS rejected, count(*) AS total, CASE WHEN count(*) FILTER (s = 'labeled') = 0 THEN 'page ' || page || ': ' || count(*) || ' lines without a label' END AS message FROM (SELECT page, {STATUS} AS s FROM ({LINES})) GROUP BY page")
def line_states(spark, folder):
    """FLT-04, FLT-18, AGG-08: states of each page's lines, and what to label."""
    counts = core.status_counts(_with_status(spark, folder), ["page"], "status", ["labeled", "empty", "pending", "rejected"])
    return counts.withColumn("message", F.when(F.col("labeled") == 0, F.format_string("page %d: %d lines without a label", "page", "total")))


@query(f"SELECT o_orderkey AS page, CASE WHEN o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F') THEN 'none' WHEN o_orderstatus = 'F' THEN 'verified' ELSE 'sliced' END AS status, o_orderkey IN (SELECT page FROM ({LINES}) WHERE {STATUS} = 'labeled') AS has_labels FROM orders")
def auto_states(spark, folder):
    """FLT-06, FLT-07: the program's state of each page, and whether any of its lines has a label."""
    rows = _with_status(spark, folder)
    facts = rows.groupBy("page").agg(F.bool_or(F.col("l_linestatus") == "F").alias("sliced"), F.bool_or(F.col("status") == "labeled").alias("has_labels"))
    state = F.when(~F.coalesce("sliced", F.lit(False)), "none").when(F.col("o_orderstatus") == "F", "verified").otherwise("sliced")
    pages = table(spark, folder, "orders").select(F.col("o_orderkey").alias("page"), "o_orderstatus")
    return pages.join(facts, "page", "left").select("page", state.alias("status"), F.coalesce("has_labels", F.lit(False)).alias("has_labels"))


CORRECTED = "SELECT page, line, 'fixed ' || text AS corrected FROM (" + LINES + ") WHERE l_returnflag = 'R'"


@query(f"SELECT page, line, row_number() OVER (PARTITION BY page ORDER BY region, line) AS idx, region, split_part(region, '_', 3) AS region_type, coalesce(corrected, text) AS final FROM ({LINES}) LEFT JOIN ({CORRECTED}) USING (page, line)")
def run_rows(spark, folder):
    """JN-01, PRJ-01, WIN-03, STR-10: lines in reading order with their corrected text, else the recognized one."""
    rows = _lines(spark, folder)
    fixed = rows.filter("l_returnflag = 'R'").select("page", "line", F.concat(F.lit("fixed "), F.col("text")).alias("final"))
    joined = core.with_default(rows, fixed, ["page", "line"], "final", F.col("text"))
    kind = T.region_type(T.line_id(F.col("region"), F.col("line")))
    return core.renumbered(joined, ["page"], [F.asc("region"), F.asc("line")], "idx").select("page", "line", "idx", "region", kind.alias("region_type"), "final")


@query(f"SELECT l.page, l.line, l.text, p.p_name AS ref, coalesce(s.s_name, '?/?') AS origin FROM ({LINES}) l JOIN part p ON l.l_partkey = p.p_partkey LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) s ON l.l_suppkey = s.s_suppkey WHERE p.p_size > 5 AND l.l_returnflag <> 'A'")
def reference_rows(spark, folder):
    """JN-03, JN-04, FLT-01: predictions that are text, with their references, and where these come from, ?/? where unknown."""
    rows = _lines(spark, folder).filter("l_returnflag <> 'A'")
    refs = table(spark, folder, "part").filter("p_size > 5").select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("ref"))
    manifest = table(spark, folder, "supplier").filter("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("origin"))
    return core.with_default(rows.join(refs, "l_partkey"), manifest, ["l_suppkey"], "origin", F.lit("?/?")).select("page", "line", "text", "ref", "origin")


@query(f"SELECT page, line, rate, row_number() OVER (PARTITION BY page ORDER BY rate DESC NULLS LAST, line) AS rank, round(avg(rate) OVER (PARTITION BY page), 9) AS mean_rate FROM (SELECT page, line, CASE WHEN {STATUS} = 'labeled' THEN l_discount END AS rate FROM ({LINES}))")
def review_order(spark, folder):
    """JN-02, JN-05, AGG-20, SRT-04, QRY-13: lines by their rate from the worst, those without a reference last, and the mean of the others."""
    rows = _lines(spark, folder).select("page", "line")
    scored = _with_status(spark, folder).filter("status = 'labeled'").select("page", "line", F.col("l_discount").alias("rate"))
    joined = rows.join(scored, ["page", "line"], "left")
    w = Window.partitionBy("page")
    return joined.withColumn("rank", F.row_number().over(w.orderBy(F.desc_nulls_last("rate"), "line"))).withColumn("mean_rate", F.round(F.avg("rate").over(w), 9))


@query(f"SELECT l.page, l.line, coalesce(d.found, false) AS detected, t.truth FROM ({LINES}) l LEFT JOIN (SELECT page, line, true AS found FROM ({LINES}) WHERE l_quantity > 40) d USING (page, line) LEFT JOIN (SELECT page, line, CASE WHEN l_discount > 0.05 THEN 'non_character' ELSE 'text' END AS truth FROM ({LINES}) WHERE l_linestatus = 'F') t USING (page, line)")
def line_verdicts(spark, folder):
    """JN-06, JN-07: lines with what a detector found, false without a finding, and with a person's verdict, if any."""
    rows = _lines(spark, folder)
    found = rows.filter("l_quantity > 40").select("page", "line", F.lit(True).alias("detected"))
    truth = rows.filter("l_linestatus = 'F'").select("page", "line", F.when(F.col("l_discount") > 0.05, "non_character").otherwise("text").alias("truth"))
    return core.with_default(rows.select("page", "line"), found, ["page", "line"], "detected", F.lit(False)).join(truth, ["page", "line"], "left")


@query("SELECT (SELECT count(*) FROM orders WHERE o_orderstatus = 'F' AND o_custkey % 5 <> 0) AS train, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F' AND o_custkey % 5 = 0) AS test, 0::BIGINT AS leaked")
def split_check(spark, folder):
    """JN-08, JN-10, SET-03, SET-06: train pages are those that aren't tests, and none is both."""
    pages = table(spark, folder, "orders").filter("o_orderstatus = 'F'")
    test = pages.filter("o_custkey % 5 = 0").select("o_orderkey")
    train = pages.select("o_orderkey").join(test, "o_orderkey", "left_anti")
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    sides = parts.groupBy("o_orderkey").agg(F.bool_or(F.col("part") == "train").alias("a"), F.bool_or(F.col("part") == "test").alias("b"))
    return sides.agg(F.count_if("a").alias("train"), F.count_if("b").alias("test"), F.count_if(F.col("a") & F.col("b")).alias("leaked"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def complete_pairs(spark, folder):
    """JN-11: pages that have both a text and an image."""
    rows = _lines(spark, folder)
    has = lambda condition: rows.filter(condition).select(F.col("page").alias("o_orderkey"))
    return table(spark, folder, "orders").select("o_orderkey").join(has("l_returnflag = 'R'"), "o_orderkey", "left_semi").join(has("l_quantity > 45"), "o_orderkey", "left_semi")


@query("SELECT n.p_partkey AS new_id, coalesce(o.old_id, -1) AS old_id FROM part n LEFT JOIN (SELECT p_type || p_size AS c, min(p_partkey) AS old_id FROM part WHERE p_partkey % 2 = 1 GROUP BY ALL) o ON n.p_type || n.p_size = o.c WHERE n.p_partkey % 2 = 0")
def same_crops(spark, folder):
    """JN-13, IMG-19: new crops with the old one of equal content, the first of equals; -1 without one."""
    parts = table(spark, folder, "part").withColumn("content", F.concat(F.col("p_type"), F.col("p_size").cast("string")))
    new = parts.filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("new_id"), "content")
    old = parts.filter("p_partkey % 2 = 1").select(F.col("p_partkey").alias("old_id"), "content")
    return core.by_hash(new, old, "content", "new_id", "old_id").fillna(-1, ["old_id"])


@query("SELECT user_id, o.event_id AS o_id, count(*) AS n_pieces FROM (SELECT user_id, event_id, event_id % 1000 AS o_start, event_id % 1000 + 40 AS o_end FROM events WHERE event_type = 'view') o JOIN (SELECT user_id, event_id % 1000 AS n_start, event_id % 1000 + 5 AS n_end FROM events WHERE event_type = 'click') n USING (user_id) WHERE n_start >= o_start AND n_end <= o_end + 1 GROUP BY ALL")
def pieces_in_runs(spark, folder):
    """JN-14: pieces that lie within each old run."""
    events = table(spark, folder, "events").withColumn("at", F.col("event_id") % 1000)
    old = events.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("o_id"), F.col("at").alias("o_start"), (F.col("at") + 40).alias("o_end"))
    new = events.filter("event_type = 'click'").select("user_id", F.col("at").alias("n_start"), (F.col("at") + 5).alias("n_end"))
    return core.contained_pieces(new, old, "user_id", 50)


BOXES = "SELECT l_orderkey AS page, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey % 1000, l_linenumber) AS place, l_partkey % 1000 AS x1, l_suppkey % 100 AS y1, l_partkey % 1000 + l_quantity::BIGINT AS x2, l_suppkey % 100 + 30 AS y2 FROM lineitem WHERE l_linenumber"
SHARED = "greatest(least(d.x2, h.x2) - greatest(d.x1, h.x1), 0) * greatest(least(d.y2, h.y2) - greatest(d.y1, h.y1), 0)"


@query(f"SELECT page, place, round(iou, 9) AS iou, covers_min, within_max, iou >= 0.5 AS ok FROM (SELECT d.page, d.place, coalesce({SHARED} / nullif((d.x2 - d.x1) * (d.y2 - d.y1) + (h.x2 - h.x1) * (h.y2 - h.y1) - {SHARED}, 0), 0) AS iou, d.x1 <= h.x1 + 15 AND d.y1 <= h.y1 + 15 AND d.x2 >= h.x2 - 15 AND d.y2 >= h.y2 - 15 AS covers_min, d.x1 >= h.x1 - 55 AND d.y1 >= h.y1 - 55 AND d.x2 <= h.x2 + 55 AND d.y2 <= h.y2 + 55 AS within_max FROM ({BOXES} % 2 = 1) d JOIN ({BOXES} % 2 = 0) h USING (page, place))")
def box_gate(spark, folder):
    """JN-15, MTH-05, MTH-06, WIN-04: found and human boxes by their place in order, how much they share and whether tolerances hold."""
    rows = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("page"), "l_linenumber", (F.col("l_partkey") % 1000).alias("x1"), (F.col("l_suppkey") % 100).alias("y1"), F.col("l_quantity").cast("long").alias("w"))
    boxed = rows.withColumn("box", G.box(F.col("x1"), F.col("y1"), F.col("x1") + F.col("w"), F.col("y1") + 30))
    # SQL's order leaves ties open, as line numbers repeat; the rest of a box closes them
    order = [F.asc(c) for c in ("x1", "l_linenumber", "y1", "w")]
    side = lambda odd, name: core.renumbered(boxed.filter(F.col("l_linenumber") % 2 == odd), ["page"], order, "place").select("page", "place", F.col("box").alias(name))
    both = side(1, "found").join(side(0, "human"), ["page", "place"])
    share = G.iou(F.col("found"), F.col("human"))
    return both.withColumn("c", G.contained(F.col("found"), F.col("human"), F.col("human"))).select("page", "place", F.round(share, 9).alias("iou"), "c.covers_min", "c.within_max", (share >= 0.5).alias("ok"))


@query("WITH g AS (SELECT c_mktsegment AS model, unnest([512, 2048, NULL]) AS budget FROM (SELECT DISTINCT c_mktsegment FROM customer)), d AS (SELECT c_mktsegment AS model, 512 AS budget FROM customer WHERE c_acctbal > 9000) SELECT model, coalesce(budget::VARCHAR, 'dynamic') AS budget, stage FROM g, (SELECT unnest(['correct', 'translate']) AS stage) WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.model = g.model AND d.budget = g.budget)")
def sweep_plan(spark, folder):
    """JN-19, SET-05, HLP-04, QRY-11: the grid of models, budgets and stages, without the cells that are done."""
    customers = table(spark, folder, "customer")
    grid = customers.select(F.col("c_mktsegment").alias("model")).distinct().withColumn("budget", F.explode(F.array(F.lit(512), F.lit(2048), F.lit(None).cast("int"))))
    grid = grid.withColumn("budget", F.coalesce(F.col("budget").cast("string"), F.lit("dynamic")))
    stages = grid.withColumn("stage", F.lit("correct")).unionByName(grid.withColumn("stage", F.lit("translate")))
    done = customers.filter("c_acctbal > 9000").select(F.col("c_mktsegment").alias("model"), F.lit("512").alias("budget"))
    return core.pending(stages, done, ["model", "budget"])


@query(f"SELECT page, line FROM ({LINES}) WHERE l_returnflag = 'R' UNION SELECT page, line FROM ({LINES}) WHERE l_tax = 0")
def all_line_numbers(spark, folder):
    """SET-01, SRC-05: lines that are placed or rejected, each once."""
    rows = _lines(spark, folder)
    return rows.filter("l_returnflag = 'R'").select("page", "line").union(rows.filter("l_tax = 0").select("page", "line")).distinct()


@query("SELECT base, path FROM (SELECT *, row_number() OVER (PARTITION BY base ORDER BY root DESC, path) AS k FROM (SELECT 'page_' || lpad((o_orderkey % 3000)::VARCHAR, 4, '0') AS base, 'page_' || lpad((o_orderkey % 3000)::VARCHAR, 4, '0') || CASE WHEN o_orderstatus = 'F' THEN '_human' ELSE '_auto' END || '/' || o_orderkey AS path, (o_orderstatus = 'F')::INT AS root FROM orders)) WHERE k = 1")
def labeled_pages(spark, folder):
    """SET-02, SRC-18, STR-11: pages of two roots by their base id; the later root's stands."""
    method = F.when(F.col("o_orderstatus") == "F", "human").otherwise("auto")
    rows = table(spark, folder, "orders").select(T.page_artifact_id(F.col("o_orderkey") % 3000, method).alias("name"), "o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("root"))
    named = rows.select(T.base_id(F.col("name")).alias("base"), F.concat("name", F.lit("/"), F.col("o_orderkey").cast("string")).alias("path"), "root")
    return core.by_priority(named, ["base"], [F.desc("root"), F.asc("path")]).select("base", "path")


@query(f"SELECT 'no_reference' AS section, page, 0 AS line, count(*) AS n FROM ({LINES}) GROUP BY page HAVING count(*) FILTER (l_linestatus = 'F') = 0 UNION ALL SELECT 'non_character', page, line, 0 FROM ({LINES}) WHERE l_quantity > 49 UNION ALL SELECT 'failed', page, 0, 0 FROM (SELECT DISTINCT page FROM ({LINES}) WHERE l_tax = 0 AND l_discount = 0)")
def worklist(spark, folder):
    """SET-04, SNK-06: three kinds of work for a person, in one table; 0 where a section has no line or number."""
    rows = _lines(spark, folder)
    tagged = lambda df, name: df.withColumn("section", F.lit(name))
    blank = rows.groupBy("page").agg(F.count("*").alias("n"), F.count_if(F.col("l_linestatus") == "F").alias("f")).filter("f = 0").drop("f")
    marks, failed = rows.filter("l_quantity > 49").select("page", "line"), rows.filter("l_tax = 0 AND l_discount = 0").select("page").distinct()
    return tagged(blank, "no_reference").unionByName(tagged(marks, "non_character"), True).unionByName(tagged(failed, "failed"), True).fillna(0, ["line", "n"])


@query(f"SELECT page, line, found AS flagged, wanted AS expected FROM (SELECT page, line, l_quantity > 45 AS found, l_discount > 0.08 AS wanted FROM ({LINES})) WHERE found <> wanted")
def flag_difference(spark, folder):
    """SET-07: flags that are in one of two sets only."""
    rows = _lines(spark, folder)
    found, wanted = rows.filter("l_quantity > 45").select("page", "line"), rows.filter("l_discount > 0.08").select("page", "line")
    only = lambda a, b, flagged: core.pending(a, b, ["page", "line"]).withColumn("flagged", F.lit(flagged)).withColumn("expected", F.lit(not flagged))
    return only(found, wanted, True).unionByName(only(wanted, found, False))


@query("SELECT n_name AS model, round(sum(o.i / 1e6 * p.pin + o.t / 1e6 * p.pout), 6) AS cost, sum(o.i)::BIGINT AS in_tokens FROM (SELECT o_custkey, length(o_orderpriority) * 100 AS i, o_orderkey % 500 AS t FROM orders) o JOIN customer ON o_custkey = c_custkey JOIN (SELECT *, n_nationkey + 1.0 AS pin, n_nationkey * 3.0 AS pout FROM nation) p ON c_nationkey = n_nationkey GROUP BY n_name")
def token_costs(spark, folder):
    """AGG-17, MTH-09: the cost of each model's calls by its prices."""
    prices = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("model"), (F.col("n_nationkey") + 1.0).alias("pin"), (F.col("n_nationkey") * 3.0).alias("pout"))
    calls = table(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey"), (F.length("o_orderpriority") * 100).alias("i"), (F.col("o_orderkey") % 500).alias("t"))
    rows = calls.join(table(spark, folder, "customer").select("c_custkey", "c_nationkey"), "c_custkey").join(prices, "c_nationkey")
    return rows.groupBy("model").agg(F.round(F.sum(F.col("i") / 1e6 * F.col("pin") + F.col("t") / 1e6 * F.col("pout")), 6).alias("cost"), F.sum("i").cast("long").alias("in_tokens"))


@query(f"WITH o AS (SELECT page, count(*) AS old_n FROM ({LINES}) WHERE l_returnflag <> 'A' GROUP BY page), n AS (SELECT page, count(*) AS new_n, max(l_quantity) AS worst FROM ({LINES}) WHERE l_quantity > 10 GROUP BY page) SELECT coalesce(old_n, 0) - coalesce(new_n, 0) AS delta, count(*) AS pages, bool_and(coalesce(new_n, 0) >= coalesce(old_n, 0)) AS ok, max(worst) AS worst, sum(coalesce(old_n, 0))::BIGINT AS old_lines, sum(coalesce(new_n, 0))::BIGINT AS new_lines FROM o FULL JOIN n USING (page) GROUP BY ALL")
def slice_regression(spark, folder):
    """AGG-21, AGG-22, AGG-25, QRY-06: old and new line counts of all pages, totals, whether all are good, the worst."""
    rows = _lines(spark, folder)
    old = rows.filter("l_returnflag <> 'A'").groupBy("page").agg(F.count("*").alias("old_n"))
    new = rows.filter("l_quantity > 10").groupBy("page").agg(F.count("*").alias("new_n"), F.max("l_quantity").alias("worst"))
    both = old.join(new, "page", "full").fillna(0, ["old_n", "new_n"])
    return both.groupBy((F.col("old_n") - F.col("new_n")).alias("delta")).agg(F.count("*").alias("pages"), F.bool_and(F.col("new_n") >= F.col("old_n")).alias("ok"), F.max("worst").alias("worst"), F.sum("old_n").alias("old_lines"), F.sum("new_n").alias("new_lines"))


@query("SELECT event_id, value, multiline FROM (SELECT event_id, value, event_type = 'view' AS multiline FROM events) ORDER BY value DESC, event_id LIMIT 10")
def worst_losses(spark, folder):
    """TOP-04, STR-21: the ten examples of highest loss."""
    rows = table(spark, folder, "events").select("event_id", "value", F.contains(F.concat("event_type", F.when(F.col("event_type") == "view", "\n").otherwise("")), F.lit("\n")).alias("multiline"))
    return rows.orderBy(F.desc("value"), "event_id").limit(10)


@query("SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean_loss, count(*) FILTER (value > 50) AS n_high FROM events GROUP BY event_type")
def loss_summary(spark, folder):
    """AGG-23, QRY-15: mean loss and high ones of each kind."""
    return table(spark, folder, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean_loss"), F.count_if(F.col("value") > 50).alias("n_high"))


LABEL = "CASE WHEN o_orderkey % 4 = 0 THEN ' ' ELSE array_to_string(list_transform(range(1 + o_orderkey % 3), lambda i: 'part' || i), chr(10)) || chr(10) END"


@query(f"SELECT page, line, outcome, CASE outcome WHEN 'marker' THEN label WHEN 'autosplit' THEN 'part' || (k - 1) END AS part FROM (SELECT l_orderkey AS page, l_linenumber AS line, label, k, CASE WHEN trim(label) = '' THEN 'marker' WHEN n = 1 + l_orderkey % 3 THEN 'autosplit' ELSE 'relabel' END AS outcome FROM (SELECT page AS l_orderkey, line AS l_linenumber, {LABEL} AS label, count(*) OVER w AS n, row_number() OVER (w ORDER BY line) AS k FROM ({LINES}) JOIN orders ON page = o_orderkey WINDOW w AS (PARTITION BY page)))")
def label_split(spark, folder):
    """STR-22, QRY-07: a run's label goes to its children line by line, if there are as many."""
    key = F.col("l_orderkey")
    parts = F.transform(F.sequence(F.lit(0), (key % 3).cast("int")), lambda i: F.concat(F.lit("part"), i.cast("string")))
    label = F.when(key % 4 == 0, F.lit(" ")).otherwise(F.concat(F.array_join(parts, "\n"), F.lit("\n")))
    return core.split_label(_lines(spark, folder).withColumn("label", label), ["page"], "line", "label")


@query("WITH s AS (SELECT CASE WHEN l_orderkey % 4 = 0 THEN 'marker' WHEN count(*) = 1 + l_orderkey % 3 THEN 'autosplit' ELSE 'relabel' END AS outcome, l_orderkey % 10 AS grp, count(*) AS n FROM lineitem GROUP BY l_orderkey) SELECT coalesce(grp, -1) AS grp, coalesce(outcome, 'total') AS outcome, sum(n)::BIGINT AS n_lines FROM s GROUP BY ROLLUP (outcome, grp)")
def reslice_tally(spark, folder):
    """AGG-16: outcomes of a re-slicing by group, and in all (group -1)."""
    rows = label_split(spark, folder).withColumn("grp", F.col("page") % 10)
    return rows.rollup("outcome", "grp").agg(F.count("*").alias("n_lines")).select(F.coalesce("grp", F.lit(-1)).alias("grp"), F.coalesce("outcome", F.lit("total")).alias("outcome"), "n_lines")


@query(f"SELECT page, line, row_number() OVER (PARTITION BY page ORDER BY substr(region, 8, 2)::INT, line) AS new_no FROM ({LINES})")
def renumbered_lines(spark, folder):
    """WIN-02, SRT-02, STR-09: lines numbered anew by the order of their regions."""
    return core.renumbered(_lines(spark, folder), ["page"], [T.parse_region(F.col("region"))["order"].asc(), F.asc("line")]).select("page", "line", "new_no")


@query(f"SELECT page, coalesce(min(CASE WHEN s = 'pending' THEN line END), 1) AS open_at, max(line) AS newest, arg_max(region, line) AS newest_region FROM (SELECT page, line, region, {STATUS} AS s FROM ({LINES})) GROUP BY page")
def next_lines(spark, folder):
    """WIN-07, WIN-08: the first pending line of each page, the first without one, and the line of the highest number."""
    return _with_status(spark, folder).groupBy("page").agg(F.coalesce(F.min(F.when(F.col("status") == "pending", F.col("line"))), F.lit(1)).alias("open_at"), F.max("line").alias("newest"), F.max_by("region", "line").alias("newest_region"))


@query("SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM events")
def newest_jobs(spark, folder):
    """SRT-05: jobs from the newest."""
    return core.renumbered(table(spark, folder, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")], "place").select("user_id", "event_id", "place")


@query("WITH p AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS place, count(*) OVER () AS n FROM supplier), k AS (SELECT DISTINCT floor((k + 0.5) * n / m)::BIGINT AS place FROM (SELECT n, unnest(range(m)) AS k, m FROM (SELECT count(*) AS n, least(greatest(1, round_even(count(*) * 0.2, 0)::BIGINT), count(*) - 1) AS m FROM supplier))) SELECT s_suppkey, place, CASE WHEN place IN (SELECT place FROM k) THEN 'test' ELSE 'train' END AS part FROM p")
def even_split(spark, folder):
    """MTH-07, SMP-05, QRY-14: a fifth of the pages at even distances are for tests."""
    return core.even_holdout(table(spark, folder, "supplier"), "s_suppkey", 0.2)


@query("SELECT o_orderkey, 'page_' || CASE WHEN o_orderkey < 10000 THEN lpad(o_orderkey::VARCHAR, 4, '0') ELSE o_orderkey::VARCHAR END || '_auto' AS artifact, o_orderkey AS number, CASE o_orderkey % 4 WHEN 1 THEN 'region_01_left' WHEN 2 THEN 'region_02_right' ELSE 'column_' || (o_orderkey % 4) END || '/line_007' AS moved, 'see page_' || o_orderkey || CASE WHEN o_orderkey IN (7, 33) THEN '_human' ELSE '_auto' END || ' and page_1_human' AS tagged FROM orders")
def identifiers(spark, folder):
    """STR-08, STR-12, STR-14, STR-15, HLP-05: ids of pages, their numbers, keys that move to regions, tokens that get a method."""
    key = F.col("o_orderkey")
    rows = table(spark, folder, "orders").select("o_orderkey", T.page_artifact_id(key, F.lit("auto")).alias("artifact"))
    old = F.concat(F.lit("column_"), (key % 4).cast("string"), F.lit("/line_007"))
    note = F.concat(F.lit("see page_"), key.cast("string"), F.lit(" and page_1_human"))
    return rows.withColumn("number", T.page_number(F.col("artifact"))).withColumn("moved", T.repoint_key(old)).withColumn("tagged", T.tag_pages(note, ["7", "33"]))


@query("SELECT s_suppkey, CASE WHEN r < 0.15 THEN 'PASS' WHEN r < 0.4 THEN 'PARTIAL' ELSE 'FAIL' END AS verdict, greatest(0, least(s_suppkey - 5, 50)) AS clamped, regexp_replace(s_name, '[^0-9A-Za-z]', '', 'g') AS plain, regexp_matches(lower(s_name), 'credit|payment|402') AS credit FROM (SELECT *, abs(s_acctbal) / 10000 AS r FROM supplier)")
def gate_verdicts(spark, folder):
    """FLT-13, FLT-19, MTH-04, STR-25: verdicts by rate, clamped values, whitelisted characters, errors that tell of credit."""
    return table(spark, folder, "supplier").select("s_suppkey", core.verdict(F.abs("s_acctbal") / 10000).alias("verdict"), G.clamp(F.col("s_suppkey") - 5, F.lit(0), F.lit(50)).alias("clamped"), F.regexp_replace("s_name", "[^0-9A-Za-z]", "").alias("plain"), F.lower("s_name").rlike("credit|payment|402").alias("credit"))


@query(f"SELECT page, count(*) AS n_glyphs FROM (SELECT *, l_suppkey % 60 AS w, l_partkey % 70 AS h, l_partkey % 900 AS a FROM ({LINES})) WHERE a >= 20 AND w <= 8 * h AND h <= 8 * w AND w <= 50 AND (h <= 50 OR h >= 40 AND (CASE WHEN w > 0 AND h > 0 THEN a::DOUBLE / (w * h) ELSE 1.0 END) BETWEEN 0.15 AND 0.85) GROUP BY page")
def glyph_counts(spark, folder):
    """FLT-12: components of each page that may be letters."""
    w, h, a = F.col("l_suppkey") % 60, F.col("l_partkey") % 70, F.col("l_partkey") % 900
    return _lines(spark, folder).filter(core.is_glyph(w, h, a, F.lit(100), F.lit(100))).groupBy("page").agg(F.count("*").alias("n_glyphs"))


@query("SELECT doc_id FROM documents WHERE list_contains(regexp_split_to_array(lower(text), '[^a-z]+'), 'the') AND list_contains(regexp_split_to_array(lower(text), '[^a-z]+'), 'and')")
def text_search(spark, folder):
    """STR-27: documents that have all words asked for, whole and in any case; no stemming."""
    words = F.split(F.lower("text"), "[^a-z]+")
    return table(spark, folder, "documents").filter(F.array_contains(words, "the") & F.array_contains(words, "and")).select("doc_id")
