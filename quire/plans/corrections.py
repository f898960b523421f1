"""Correction runs: blocks that are sent, replies that are parsed, and their evaluation against references."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.functions import corrections as C
from quire.functions import text as T
from quire.operators import core
from quire.plans.catalog import PAIRS, _pairs
from quire.plans.registry import query

PRICES = (2.0, 12.0)
LETTERS = "a-m"
RN = f"SELECT *, hyp AS pred, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn, count(*) OVER (PARTITION BY conv_id) AS n FROM ({PAIRS})"
FIXED = "CASE WHEN rn % 5 = 0 THEN pred ELSE translate(pred, 'eoa', 'aeo') END"
REPLY = f"SELECT *, CASE WHEN rn % 4 = 3 THEN pred ELSE {FIXED} END AS corrected, rn % 4 <> 3 AS applied FROM ({RN})"


def _sent(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(lines with rn, blocks with a reply): the reply is fenced, lacks every fourth line from the third on, gives one line twice
    and one out of range."""
    rows = _pairs(spark, folder).withColumnRenamed("hyp", "pred")
    rows = rows.withColumn("rn", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")))
    blocks = C.numbered_block(rows, ["conv_id"], "turn", "pred")
    lines = F.transform(F.split("block", "\n"), lambda x: F.struct(F.split(x, "\t", 2)[0].cast("int").alias("k"), F.split(x, "\t", 2)[1].alias("t")))
    given = F.filter(lines, lambda x: x["k"] % 4 != 3)
    told = F.transform(given, lambda x: F.concat(x["k"].cast("string"), F.lit(". "), F.when(x["k"] % 5 == 0, x["t"]).otherwise(F.translate(x["t"], "eoa", "aeo"))))
    reply = F.concat(F.lit("```text\nHere they are:\n"), F.array_join(told, "\n"), F.lit("\n1) again\n99999: beyond\n```"))
    return rows, blocks.withColumn("reply", reply).withColumn("parsed", C.parse_rewrite(F.col("reply"), F.col("n")))


@query(f"SELECT conv_id, count(*) AS n, string_agg(rn || chr(9) || pred, chr(10) ORDER BY rn) AS block, count(*) < 3 AS parse_ok, (count(*) FILTER (applied))::INTEGER AS n_parsed FROM ({REPLY}) GROUP BY conv_id")
def correction_blocks(spark, folder):
    """STR-17 to STR-19: the numbered block of each page, and what the reply to it parses to."""
    return _sent(spark, folder)[1].select("conv_id", F.col("n").cast("long").alias("n"), "block", "parsed.parse_ok", F.size("parsed.lines").alias("n_parsed"))


def _evaluated(rows: DataFrame) -> DataFrame:
    # lines that stay as they were have their edits already
    changed = F.when(F.col("corrected") != F.col("pred"), F.col("corrected"))
    rows = rows.withColumn("edits_corrected", F.coalesce(T.edits(F.col("ref"), changed), F.col("edits")))
    rows = rows.withColumn("cer_corrected", F.col("edits_corrected").cast("double") / F.col("ref_len").cast("double"))
    out = C.correction_summary(rows, ["conv_id"], *PRICES, LETTERS)
    return out.select(*(F.round(c, 9).alias(c) if kind == "double" else c for c, kind in out.dtypes))


def _evaluation(corrected: str, parse_ok: str, rejected: str) -> str:
    share = lambda c: f"CASE WHEN length(regexp_replace({c}, '\\P{{L}}', '', 'g')) > 0 THEN length(regexp_replace({c}, '[^a-m]', '', 'g'))::DOUBLE / length(regexp_replace({c}, '\\P{{L}}', '', 'g')) ELSE 0 END"
    lines = f"SELECT *, levenshtein(ref, corrected) AS e2, levenshtein(ref, corrected)::DOUBLE / ref_len AS c2 FROM ({corrected})"
    sums = f"SELECT conv_id, count(*) AS n, sum(edits)::DOUBLE / sum(ref_len) AS b, sum(e2)::DOUBLE / sum(ref_len) AS c, count(*) FILTER (c2 > cer + 1e-9) AS made_worse, count(*) FILTER (cer <= 1e-9) AS n_was_correct, count(*) FILTER (cer <= 1e-9 AND c2 > 1e-9) AS broke_correct, count(*) FILTER (corrected <> pred) AS n_changed, ({rejected})::BIGINT AS rejected_edits, {parse_ok} AS parse_ok, avg({share('pred')}) AS f1, avg({share('corrected')}) AS f2, sum(length(corrected))::DOUBLE / sum(ref_len) AS len_ratio, (sum(length(rn::VARCHAR) + 1 + length(pred)) + count(*) - 1)::BIGINT AS in_tokens, sum(length(corrected))::BIGINT AS out_tokens FROM ({lines}) GROUP BY conv_id"
    return f"SELECT conv_id, n, round(b, 9) AS cer_baseline, round(c, 9) AS cer_corrected, made_worse, n_was_correct, broke_correct, n_changed, rejected_edits, parse_ok, round(f1, 9) AS base_fraction, round(f2, 9) AS corr_fraction, round(len_ratio, 9) AS len_ratio, in_tokens, out_tokens, round(b - c, 9) AS abs_reduction, round(CASE WHEN b > 0 THEN (b - c) / b ELSE 0 END, 9) AS rel_reduction, f2 < f1 - 0.05 OR abs(len_ratio - 1) > 0.15 AS paraphrase_flag, round(in_tokens / 1e6 * 2 + out_tokens / 1e6 * 12, 9) AS cost_page, round((in_tokens / 1e6 * 2 + out_tokens / 1e6 * 12) * 1000, 9) AS cost_1000 FROM ({sums})"


@query(_evaluation(REPLY, "count(*) < 3", "0"))
def correction_evaluation(spark, folder):
    """QRY-02, AGG-15, FLT-16, FLT-17, JN-16, MTH-02, MTH-03, MTH-09: whole-line corrections; a line without one keeps its baseline."""
    rows, replies = _sent(spark, folder)
    told = replies.select(F.col("conv_id").alias("page"), "parsed", F.length("block").cast("long").alias("in_tokens"))
    joined = rows.join(told, F.col("conv_id") == F.col("page"))
    joined = joined.withColumn("corrected", F.coalesce(F.try_element_at("parsed.lines", F.col("rn")), F.col("pred"))).withColumn("parse_ok", F.col("parsed.parse_ok"))
    tokens = F.sum(F.length("corrected")).over(Window.partitionBy("conv_id"))
    return _evaluated(joined.withColumn("rejected", F.lit(0)).withColumn("out_tokens", tokens))


EDITED = "SELECT *, CASE WHEN rn % 2 = 1 AND conv_id % 10 <> 9 THEN regexp_replace(pred, 'e', 'a') ELSE pred END AS corrected FROM (" + RN + ")"


@query(_evaluation(EDITED, "conv_id % 10 <> 9", "sum(CASE WHEN conv_id % 10 = 9 OR rn % 2 = 0 THEN 0 ELSE 1 + (CASE WHEN contains(pred, 'e') THEN 0 ELSE 1 END) END)"))
def minimal_edit_evaluation(spark, folder):
    """JSN-01, STR-20: edits from a JSON reply, each replacing its first match; what isn't found is rejected. Every tenth reply is broken."""
    rows = _pairs(spark, folder).withColumnRenamed("hyp", "pred")
    rows = rows.withColumn("rn", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")))
    blocks = C.numbered_block(rows, ["conv_id"], "turn", "pred")
    odd = F.filter(F.sequence(F.lit(1), F.col("n")), lambda i: i % 2 == 1)
    entries = F.concat(F.transform(odd, lambda i: F.concat(F.lit('"'), i.cast("string"), F.lit('": {"e": "a", "missing!": "x"}'))), F.array(F.lit('"2": "no object"'), F.lit('"x": {"a": "b"}'), F.lit('"0": {"a": "b"}'), F.lit('"99999": {"a": "b"}')))
    body = F.concat(F.lit("Sure. {"), F.array_join(entries, ", "), F.when(F.col("conv_id") % 10 == 9, "").otherwise("} Done."))
    told = blocks.withColumn("parsed", C.parse_minimal_edit(body, F.col("n"))).select(F.col("conv_id").alias("page"), "parsed", F.length("block").cast("long").alias("in_tokens"))
    joined = rows.join(told, F.col("conv_id") == F.col("page"))
    changes = F.transform(F.map_entries(F.coalesce(F.try_element_at("parsed.edits", F.col("rn")), F.create_map().cast("map<string,string>"))), lambda x: F.struct(x["key"].alias("find"), x["value"].alias("new")))
    joined = joined.withColumn("e", T.apply_edits(F.col("pred"), changes)).withColumn("corrected", F.col("e.text")).withColumn("rejected", F.size("e.rejected")).withColumn("parse_ok", F.col("parsed.parse_ok"))
    return _evaluated(joined.withColumn("out_tokens", F.sum(F.length("corrected")).over(Window.partitionBy("conv_id"))))


@query(f"SELECT role, count(*) AS n, round(avg(cer), 9) AS mean FROM ({PAIRS}) GROUP BY role")
def group_rates(spark, folder):
    """AGG-04: size and mean error rate of each group, worst first."""
    return core.group_means(_pairs(spark, folder), ["role"], "cer").withColumn("mean", F.round("mean", 9))
