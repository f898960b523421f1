"""Named queries over the given tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.functions.edit_ops import edit_counts
from quire.operators import core
from quire.plans.registry import ORACLE, QUERIES, query
from quire.sources.tables import lines, table
from quire.streaming.jobs import latest_state

__all__ = ["ORACLE", "QUERIES"]

def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return lines(table(spark, folder, "documents"))


LINES = "SELECT doc_id, source, lang, t.i AS line_no, t.text FROM (SELECT doc_id, source, lang, unnest(list_transform(string_split(text, chr(10)), lambda x, i: {'i': i, 'text': x})) AS t FROM documents)"
# A reference is a whole turn of a conversation, stripped; the hypothesis swaps vowels and loses a letter.
PAIRS = "SELECT *, levenshtein(ref, hyp) AS edits, length(ref) AS ref_len, levenshtein(ref, hyp)::DOUBLE / length(ref)::DOUBLE AS cer FROM (SELECT *, replace(translate(ref, 'aeo', 'eoa'), 'th', 't') AS hyp FROM (SELECT conv_id, turn, role, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS ref FROM conversations)) WHERE ref <> ''"


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    """(conv_id, turn, role, ref, hyp, edits, ref_len, cer): lines with a reference; FLT-02 drops empty ones."""
    ref = T.collapse_ws(F.col("text"))
    turns = core.spread(table(spark, folder, "conversations").select("conv_id", "turn", "role", "text"))
    refs = turns.select("conv_id", "turn", "role", ref.alias("ref")).filter("ref <> ''")
    hyp = F.replace(F.translate("ref", "aeo", "eoa"), F.lit("th"), F.lit("t"))
    scored = refs.withColumn("hyp", hyp).withColumn("edits", T.edits(F.col("ref"), F.col("hyp"))).withColumn("ref_len", F.length("ref"))
    return scored.withColumn("cer", F.col("edits").cast("double") / F.col("ref_len").cast("double"))


BIN = "CASE WHEN ref_len <= 10 THEN '0-10' WHEN ref_len <= 20 THEN '11-20' WHEN ref_len <= 30 THEN '21-30' ELSE '31+' END"


@query(f"SELECT role, {BIN} AS length_bin, count(*) AS n_lines, round(avg(cer), 9) AS mean_cer, sum(edits)::BIGINT AS edits, sum(ref_len)::BIGINT AS ref_len, sum(edits)::DOUBLE / sum(ref_len)::DOUBLE AS cer FROM ({PAIRS}) GROUP BY ALL")
def error_analysis(spark, folder):
    """QRY-01, AGG-01, AGG-05: by role and length, the mean of the lines' error rates and the rate of all their characters."""
    return core.length_bins(_pairs(spark, folder), ["role"])


@query(f"SELECT conv_id, turn, ref, hyp, edits::BIGINT AS edits, cer FROM ({PAIRS}) ORDER BY cer DESC, conv_id, turn LIMIT 25")
def worst_lines(spark, folder):
    """TOP-01, SRT-01: the 25 worst lines."""
    rows = _pairs(spark, folder).select("conv_id", "turn", "ref", "hyp", F.col("edits").cast("long"), "cer")
    return rows.orderBy(F.desc("cer"), "conv_id", "turn").limit(25)


@query(f"SELECT conv_id, count(*) AS n_lines, sum(edits)::BIGINT AS edits, sum(ref_len)::BIGINT AS ref_len, sum(edits)::DOUBLE / sum(ref_len)::DOUBLE AS cer FROM ({PAIRS}) GROUP BY conv_id")
def page_scores(spark, folder):
    """AGG-02: error rate of each page."""
    return core.corpus_rate(_pairs(spark, folder), ["conv_id"])


@query(f"SELECT conv_id % 5 AS run, count(*) AS n_pages, round(sum(cer * n) / sum(n), 9) AS weighted FROM (SELECT conv_id, sum(edits)::DOUBLE / sum(ref_len)::DOUBLE AS cer, count(*) AS n FROM ({PAIRS}) GROUP BY conv_id) GROUP BY ALL")
def weighted_pages(spark, folder):
    """AGG-03: mean of the pages' error rates, weighed by their lines."""
    pages = core.corpus_rate(_pairs(spark, folder), ["conv_id"]).withColumn("run", F.col("conv_id") % 5)
    return core.weighted_mean(pages, ["run"], "cer", "n_lines").select("run", "n_pages", F.round("weighted", 9).alias("weighted"))


@query(f"SELECT role AS model, CASE WHEN turn < 2 THEN 0 ELSE 5 END AS shot, count(*) AS n_lines, sum(edits)::BIGINT AS edits, sum(ref_len)::BIGINT AS ref_len, sum(edits)::DOUBLE / sum(ref_len)::DOUBLE AS cer FROM ({PAIRS}) GROUP BY ALL")
def variant_scores(spark, folder):
    """AGG-24, QRY-17, SMP-06: the corpus error rate of each (model, shot)."""
    shot = F.when(F.col("turn") < 2, 0).otherwise(5)
    return core.corpus_rate(_pairs(spark, folder).select(F.col("role").alias("model"), shot.alias("shot"), "edits", "ref_len"), ["model", "shot"])


@query()
def edit_breakdown(spark, folder):
    """STR-02: substitutions, deletions and insertions of every whole line; checked against the edit distance in tests."""
    rows = _pairs(spark, folder).withColumn("e", edit_counts("ref", "hyp"))
    return rows.select("conv_id", "turn", "edits", "e.n_sub", "e.n_del", "e.n_ins")


NUMERAL, MARKS = r"[0-9\u0531-\u0556\u0561-\u0586]{1,3}\.", r"[\u0589\u055F\u00B7\u055E\u055B\u055A\u055D]"
FLAGS = "SELECT unnest([CASE WHEN regexp_matches(text, '[0-9Ա-Ֆա-ֆ]{1,3}\\.') THEN 'numeral' ELSE 'no_numeral' END, CASE WHEN regexp_matches(text, '[։՟·՞՛՚՝]') THEN 'mark' ELSE 'no_mark' END]) AS flag"


@query(f"SELECT flag, count(*) AS n_lines FROM ({FLAGS} FROM ({LINES})) GROUP BY flag")
def flag_groups(spark, folder):
    """AGG-06, STR-05, STR-06: overlapping groups, each line counted in two."""
    t = F.col("text")
    flags = F.array(F.when(t.rlike(NUMERAL), "numeral").otherwise("no_numeral"), F.when(t.rlike(MARKS), "mark").otherwise("no_mark"))
    return _lines(spark, folder).select(F.explode(flags).alias("flag")).groupBy("flag").agg(F.count("*").alias("n_lines"))


FRACTION = "CASE WHEN length(regexp_replace(text, '\\P{L}', '', 'g')) > 0 THEN length(regexp_replace(text, '[^а-яА-Яa-m]', '', 'g'))::DOUBLE / length(regexp_replace(text, '\\P{L}', '', 'g')) ELSE 0 END"


@query(f"SELECT doc_id, count(*) AS n_lines, count(*) FILTER (trim(text) = '') AS n_empty, count(DISTINCT text) AS n_distinct, round(avg({FRACTION}), 9) AS mean_fraction FROM ({LINES}) GROUP BY doc_id")
def degeneracy(spark, folder):
    """AGG-07, AGG-18, STR-04: lines, empty and different lines of each page, and the mean share of one script's letters."""
    share = F.avg(T.script_fraction(F.col("text"), "а-яА-Яa-m"))
    return _lines(spark, folder).groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if(F.trim("text") == "").alias("n_empty"), F.count_distinct("text").alias("n_distinct"), F.round(share, 9).alias("mean_fraction"))


DETECTED = "SELECT d.source, l.quality = 0 AS truth, length(regexp_replace(d.text, '[^#*$%&|<>!]', '', 'g')) > 20 AS found FROM documents d JOIN labels l USING (doc_id) WHERE d.text IS NOT NULL"


@query(f"SELECT *, CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) END AS precision, CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) END AS recall, CASE WHEN 2 * tp + fp + fn > 0 THEN (2 * tp)::DOUBLE / (2 * tp + fp + fn) END AS f1 FROM (SELECT source, count(*) FILTER (truth AND found) AS tp, count(*) FILTER (NOT truth AND found) AS fp, count(*) FILTER (truth AND NOT found) AS fn, count(*) FILTER (NOT truth AND NOT found) AS tn FROM ({DETECTED}) GROUP BY ROLLUP (source))")
def detector_gate(spark, folder):
    """QRY-03, AGG-09, AGG-10, AGG-11: a symbol detector against labels, with the micro-average."""
    found = table(spark, folder, "documents").filter("text IS NOT NULL").join(table(spark, folder, "labels"), "doc_id")
    rows = found.select("source", (F.col("quality") == 0).alias("truth"), (F.length(F.regexp_replace("text", "[^#*$%&|<>!]", "")) > 20).alias("found"))
    return core.confusion(rows, ["source"]).drop("level")


INK = f"SELECT doc_id, line_no, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS glyphs, length(text) AS ink FROM ({LINES})"
HIGH = "(ratio > 1.6 AND line_no > 1)"  # a page's first line is its header, which is exempt
RATIO = f"SELECT *, CASE WHEN m > 0 THEN ink / m ELSE 0.0 END AS ratio FROM (SELECT *, median(ink) OVER (PARTITION BY doc_id) AS m FROM ({INK}))"


def _features(spark: SparkSession, folder: str) -> DataFrame:
    rows = _lines(spark, folder).select("doc_id", "line_no", F.length(F.regexp_replace("text", "[^A-Za-z]", "")).cast("long").alias("glyphs"), F.length("text").cast("long").alias("ink"))
    return core.page_ratio(rows, "doc_id", "ink")


def _high(ratio):
    """A page's first line is its header."""
    region = F.when(F.col("line_no") == 1, T.region_name(F.lit(1), F.lit("header"))).otherwise(T.region_name(F.lit(2), F.lit("left")))
    return core.high_ink(T.line_id(region, F.col("line_no")), ratio, F.lit(1.0))


@query(f"SELECT doc_id, line_no::INTEGER AS line_no, ratio::DOUBLE AS ratio, concat_ws('+', CASE WHEN glyphs = 0 THEN 'no_glyphs' END, CASE WHEN {HIGH} THEN 'high_ink' END) AS reason FROM ({RATIO}) WHERE glyphs = 0 OR {HIGH}")
def flagged_lines(spark, folder):
    """QRY-04, WIN-01, FLT-08 to FLT-10: lines that aren't text, by page-relative ink, with reasons."""
    none, high = F.col("glyphs") == 0, _high(F.col("ratio"))
    reason = F.concat_ws("+", F.when(none, "no_glyphs"), F.when(high, "high_ink"))
    return _features(spark, folder).filter(none | high).select("doc_id", "line_no", "ratio", reason.alias("reason"))


@query(f"SELECT doc_id, line_no::INTEGER AS line_no, ink, rank::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ink DESC, line_no) AS rank FROM ({RATIO}) WHERE NOT (glyphs = 0 OR {HIGH})) WHERE rank <= 5")
def borderline_lines(spark, folder):
    """TOP-02: the five highest of each page that aren't flagged."""
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("ink"), "line_no"))
    rows = _features(spark, folder).filter(~((F.col("glyphs") == 0) | _high(F.col("ratio")))).withColumn("rank", rank)
    return rows.filter("rank <= 5").select("doc_id", "line_no", "ink", "rank")


@query(f"WITH f AS (SELECT doc_id, line_no, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS r FROM ({LINES}) WHERE length(text) > 40) SELECT doc_id, min(line_no)::INTEGER AS run_start, max(line_no)::INTEGER AS run_end, (max(line_no) - min(line_no) + 1)::INTEGER AS run_len FROM f GROUP BY doc_id, line_no - r")
def long_line_runs(spark, folder):
    """ARR-01, WIN-06: maximal runs of long lines."""
    return core.runs(_lines(spark, folder), ["doc_id"], "line_no", F.length("text") > 40)


@query(f"WITH f AS (SELECT doc_id, line_no, CASE WHEN line_no - lag(line_no) OVER w - 1 <= 2 THEN 0 ELSE 1 END AS new FROM ({LINES}) WHERE length(text) > 40 WINDOW w AS (PARTITION BY doc_id ORDER BY line_no)), g AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY line_no) AS i FROM f), r AS (SELECT doc_id, min(line_no) AS run_start, max(line_no) AS run_end FROM g GROUP BY doc_id, i) SELECT doc_id, run_start::INTEGER AS run_start, run_end::INTEGER AS run_end, (run_end - run_start + 1)::INTEGER AS run_len FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY run_end - run_start DESC, run_start) AS k FROM r) WHERE k = 1")
def dominant_run(spark, folder):
    """SEQ-05, SEQ-06: the longest run of long lines after bridging gaps of two; the first wins ties."""
    found = core.runs(_lines(spark, folder), ["doc_id"], "line_no", F.length("text") > 40, max_gap=2)
    return core.by_priority(found, ["doc_id"], [F.desc("run_len"), F.asc("run_start")])


@query("SELECT user_id, event_id, sum(event_id) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)::DOUBLE / 7 AS smooth FROM events")
def smoothed(spark, folder):
    """WIN-05: centred moving average, zero beyond the ends."""
    rows = table(spark, folder, "events").select("user_id", "event_id")
    return core.moving_average(rows, ["user_id"], "event_id", "event_id", 7).select("user_id", "event_id", F.col("smooth").cast("double").alias("smooth"))


@query(f"WITH t AS (SELECT doc_id, line_no, text, sum(length(text) + 1) OVER (PARTITION BY doc_id ORDER BY line_no) AS e FROM ({LINES})), o AS (SELECT doc_id, line_no AS o_id, e - length(text) - 1 AS s, e FROM t), n AS (SELECT doc_id, unnest(range(0, max(e)::BIGINT, 100)) AS s, max(e) AS last FROM t GROUP BY doc_id), p AS (SELECT n.doc_id, n.s // 100 AS n_id, o.o_id, least(n.s + 100, o.e) - greatest(n.s, o.s) AS overlap FROM n JOIN o ON n.doc_id = o.doc_id AND n.s < o.e AND o.s < n.s + 100) SELECT doc_id, n_id, o_id, overlap::BIGINT AS overlap FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, n_id ORDER BY overlap DESC, o_id) AS k FROM p) WHERE k = 1")
def label_carry_over(spark, folder):
    """QRY-07, JN-12: pieces of 100 characters take the line that they overlap most; the first wins ties."""
    w = Window.partitionBy("doc_id").orderBy("line_no")
    t = _lines(spark, folder).select("doc_id", "line_no", F.sum(F.length("text") + 1).over(w).alias("o_end"), F.length("text").alias("n"))
    old = t.select("doc_id", F.col("line_no").cast("long").alias("o_id"), (F.col("o_end") - F.col("n") - 1).alias("o_start"), "o_end")
    ends = t.groupBy("doc_id").agg(F.max("o_end").alias("last"))
    new = ends.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("last") - 1) / 100))).alias("n_id"))
    new = new.select("doc_id", "n_id", (F.col("n_id") * 100).alias("n_start"), (F.col("n_id") * 100 + 100).alias("n_end"))
    return core.best_overlap(new, old, "doc_id")


@query("SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS doc FROM conversations GROUP BY conv_id")
def merged_documents(spark, folder):
    """AGG-12: texts in reading order."""
    return core.joined_text(table(spark, folder, "conversations"), ["conv_id"], "turn", "text")


@query("WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY md5(concat(doc_id::VARCHAR, 'split')), doc_id) AS rank FROM documents) SELECT doc_id, rank, CASE WHEN rank <= 20 THEN 'test' WHEN rank <= 70 THEN 'train_50' ELSE 'train_150' END AS part FROM r WHERE rank <= 170")
def nested_splits(spark, folder):
    """SMP-02 to SMP-04: a seeded holdout and nested train sets."""
    return core.nested_split(table(spark, folder, "documents"), "doc_id", "split", 20, [50, 150])


@query("SELECT user_id, event_id, event_type AS state FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def job_states(spark, folder):
    """STM-02: the latest state of each job."""
    return latest_state(table(spark, folder, "events"))


BREAK = "SELECT user_id AS run_id, event_id, value >= 0 AND event_id % 3 > 0 AS ok, event_id % 97 = 0 AS fatal FROM events"


@query(f"SELECT run_id, event_id, max((bad >= 3 AND good = 0) OR fatal) OVER (PARTITION BY run_id ORDER BY event_id) AS stopped FROM (SELECT *, sum((NOT ok)::INT) OVER w AS bad, sum(ok::INT) OVER w AS good FROM ({BREAK}) WINDOW w AS (PARTITION BY run_id ORDER BY event_id))")
def stop_points(spark, folder):
    """STM-05: where the circuit breaker would have ended each run."""
    rows = table(spark, folder, "events").select(F.col("user_id").alias("run_id"), "event_id", F.expr("value >= 0 AND event_id % 3 > 0").alias("ok"), F.expr("event_id % 97 = 0").alias("fatal"))
    return core.circuit_breaker(rows, ["run_id"], ["event_id"], "ok", "fatal").select("run_id", "event_id", "stopped")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')")
def pending_work(spark, folder):
    """JN-09, STM-06: planned keys without a result."""
    done = table(spark, folder, "orders").filter("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return core.pending(table(spark, folder, "customer").select("c_custkey"), done, ["c_custkey"])


@query("SELECT n_name, r_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
def dimension_lookup(spark, folder):
    """JN-17, JN-20: facts with their dimensions, whose few rows Spark broadcasts by their size."""
    nation = table(spark, folder, "nation").join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name", "r_name").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, l_orderkey, l_linenumber, l_quantity FROM (SELECT l_partkey AS p_partkey, l_orderkey, l_linenumber, l_quantity, row_number() OVER (PARTITION BY l_partkey ORDER BY l_quantity, l_orderkey, l_linenumber) AS k FROM lineitem) WHERE k = 1")
def best_per_group(spark, folder):
    """AGG-14: the least of each group, first wins ties."""
    rows = table(spark, folder, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_orderkey", "l_linenumber", "l_quantity")
    return core.by_priority(rows, ["p_partkey"], [F.asc("l_quantity"), F.asc("l_orderkey"), F.asc("l_linenumber")])


@query("SELECT o_orderkey, CASE WHEN n = 0 THEN 'unlabeled' WHEN open > 0 THEN 'in_progress' ELSE 'done' END AS status FROM (SELECT o_orderkey, count(l_orderkey) AS n, count(*) FILTER (l_linestatus = 'O') AS open FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey)")
def page_status(spark, folder):
    """QRY-12, FLT-05: status from the states of a page's lines."""
    counts = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count_if(F.col("l_linestatus") == "O").alias("open"))
    status = F.when(F.col("n").isNull(), "unlabeled").when(F.col("open") > 0, "in_progress").otherwise("done")
    return table(spark, folder, "orders").select("o_orderkey").join(counts, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", status.alias("status"))


SLUG = "concat_ws('__', source, lang, 'v1')"


@query(f"SELECT doc_id, {SLUG} AS slug, 'page_' || CASE WHEN doc_id < 10000 THEN lpad(doc_id::VARCHAR, 4, '0') ELSE doc_id::VARCHAR END AS page_id, (len(string_split(coalesce(text, ''), 'th')) - 1)::INTEGER AS n_th, left(text, 200) AS head FROM documents")
def page_keys(spark, folder):
    """STR-08, STR-13, STR-16, STR-24: identifiers, slugs, counts and cut messages."""
    return table(spark, folder, "documents").select("doc_id", F.concat_ws("__", "source", "lang", F.lit("v1")).alias("slug"), T.page_id(F.col("doc_id")).alias("page_id"), F.regexp_count(F.coalesce("text", F.lit("")), F.lit("th")).alias("n_th"), F.left("text", F.lit(200)).alias("head"))


@query()
def minimal_edits(spark, folder):
    """STR-20: ordered edits that replace their first match, with those that found none."""
    pairs = [("the", "teh"), ("e", "E"), ("missing!", "x")]
    changes = F.array(*(F.struct(F.lit(a).alias("find"), F.lit(b).alias("new")) for a, b in pairs))
    return _lines(spark, folder).withColumn("e", T.apply_edits(F.col("text"), changes)).select("doc_id", "line_no", "e.text", "e.rejected")
