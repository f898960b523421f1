"""Replies of a corrector: numbered blocks, their parsing, and edits in JSON; all on Columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import script_fraction, strip_fences

#: A numbered line: number, one mark at most, white space, text.
NUMBERED = r"^\s*(\d+)[\.\):\t]?\s+(.*)$"


def numbered_block(rows: DataFrame, keys: list[str], order: str, text: str) -> DataFrame:
    """(keys, n, block): the texts of each key in order, one line each, numbered from 1 with a tab behind."""
    parts = F.array_sort(F.collect_list(F.struct(order, text)))
    block = F.array_join(F.transform("parts", lambda x, i: F.concat((i + 1).cast("string"), F.lit("\t"), x[text])), "\n")
    return rows.groupBy(*keys).agg(parts.alias("parts")).select(*keys, F.size("parts").alias("n"), block.alias("block"))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def parse_rewrite(reply: Column, n: Column) -> Column:
    """struct(lines map<int,string>, parse_ok): the numbered lines of a reply, within 1 to n; the first of a number counts.

    parse_ok says whether every number from 1 to n is there. Lines without a number are left out."""
    # each array is bound once: what a lambda only refers to is computed anew for every element
    texts = F.split(strip_fences(reply), r"\r\n|\n|\r")
    found = F.transform(texts, lambda x, i: F.struct(F.regexp_extract(x, NUMBERED, 1).try_cast("int").alias("key"), i.alias("i"), F.regexp_extract(x, NUMBERED, 2).alias("value")))
    by_key = F.array_sort(F.filter(found, lambda x: x["key"].between(1, n)))
    first = _bound(by_key, lambda a: F.filter(a, lambda x, i: ~F.get(a, i - 1)["key"].eqNullSafe(x["key"])))
    lines = F.map_from_entries(F.transform(first, lambda x: F.struct(x["key"].alias("key"), x["value"].alias("value"))))
    return _bound(lines, lambda a: F.struct(a.alias("lines"), (F.size(a) == n).alias("parse_ok")))


def parse_minimal_edit(reply: Column, n: Column) -> Column:
    """struct(edits map<int,map<string,string>>, parse_ok) from a JSON object {line: {find: new}} within the reply.

    Keys that aren't numbers from 1 to n, and values that aren't objects, are left out; without an object that can be
    read there are no edits, and parse_ok is false."""
    outer = F.nullif(F.regexp_extract(strip_fences(reply), r"(?s)\{.*\}", 0), F.lit(""))
    raw = F.from_json(outer, "map<string,string>")
    entries = F.filter(F.map_entries(raw), lambda x: x["key"].try_cast("int").between(1, n) & x["value"].startswith("{"))
    edits = F.map_from_entries(F.transform(entries, lambda x: F.struct(x["key"].cast("int").alias("key"), F.from_json(x["value"], "map<string,string>").alias("value"))))
    none = F.create_map().cast("map<int,map<string,string>>")
    return F.struct(F.coalesce(edits, none).alias("edits"), raw.isNotNull().alias("parse_ok"))


def correction_summary(rows: DataFrame, keys: list[str], price_in: float, price_out: float, letters: str) -> DataFrame:
    """One row for each run from its lines (ref, pred, corrected, cer, cer_corrected, edits, edits_corrected, parse_ok, rejected,
    in_tokens, out_tokens; the last three and parse_ok are the run's): error before and after, what got worse or broke,
    changes, a guard against paraphrase (fewer letters of the script by 0.05, or a length off by more than 15 %), cost."""
    share = lambda c: F.avg(script_fraction(F.col(c), letters))
    ref_chars = F.sum(F.length("ref"))
    out = rows.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.try_divide(F.sum("edits").cast("double"), ref_chars).alias("cer_baseline"),
        F.try_divide(F.sum("edits_corrected").cast("double"), ref_chars).alias("cer_corrected"),
        F.count_if(F.col("cer_corrected") > F.col("cer") + 1e-9).alias("made_worse"),
        F.count_if(F.col("cer") <= 1e-9).alias("n_was_correct"),
        F.count_if((F.col("cer") <= 1e-9) & (F.col("cer_corrected") > 1e-9)).alias("broke_correct"),
        F.count_if(F.col("corrected") != F.col("pred")).alias("n_changed"),
        F.sum("rejected").alias("rejected_edits"),
        F.bool_and("parse_ok").alias("parse_ok"),
        share("pred").alias("base_fraction"),
        share("corrected").alias("corr_fraction"),
        F.coalesce(F.try_divide(F.sum(F.length("corrected")).cast("double"), ref_chars), F.lit(0.0)).alias("len_ratio"),
        F.max("in_tokens").alias("in_tokens"),
        F.max("out_tokens").alias("out_tokens"),
    )
    gain = F.col("cer_baseline") - F.col("cer_corrected")
    cost = F.col("in_tokens") / 1e6 * price_in + F.col("out_tokens") / 1e6 * price_out
    guard = (F.col("corr_fraction") < F.col("base_fraction") - 0.05) | (F.abs(F.col("len_ratio") - 1.0) > 0.15)
    out = out.withColumn("abs_reduction", gain).withColumn("rel_reduction", F.coalesce(F.try_divide(gain, F.col("cer_baseline")), F.lit(0.0)))
    return out.withColumn("paraphrase_flag", guard).withColumn("cost_page", cost).withColumn("cost_1000", cost * 1000)
