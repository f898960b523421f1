"""String functions on Columns; all but the edit distance stay within whole-stage code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.edit_ops import edit_distance


def trim_ws(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse_ws(c: Column) -> Column:
    return trim_ws(F.regexp_replace(c, r"(?U)\s+", " "))


def edits(ref: Column, hyp: Column) -> Column:
    """Code-point edit distance of the stripped texts."""
    return edit_distance(trim_ws(ref), trim_ws(hyp))


def cer(ref: Column, hyp: Column) -> Column:
    """Edits per reference character; null for an empty reference."""
    return F.try_divide(edits(ref, hyp).cast("double"), F.length(trim_ws(ref)).cast("double"))


def script_fraction(c: Column, letters: str = r"԰-֏") -> Column:
    """Share of a script's letters among all letters; 0.0 without letters."""
    all_ = F.length(F.regexp_replace(c, r"\P{L}", ""))
    own = F.length(F.regexp_replace(c, rf"[^{letters}]|\P{{L}}", ""))
    return F.when(all_ > 0, own / all_).otherwise(0.0)


def is_repetitive(c: Column, min_repeats: int = 4, max_unit: int = 3) -> Column:
    """A unit of up to max_unit characters repeated min_repeats times or more makes up the text without its spaces."""
    s = F.regexp_replace(c, r"(?U)\s+", "")
    found = F.lit(False)
    for unit in range(1, max_unit + 1):
        times = F.floor(F.length(s) / unit).cast("int")
        found = found | ((times >= min_repeats) & (F.repeat(F.substring(s, 1, unit), times) == F.left(s, times * unit)))
    return F.coalesce(found, F.lit(False))


def region_type(line_id: Column) -> Column:
    """The type within region_NN_<type>/..., else null."""
    return F.nullif(F.regexp_extract(line_id, r"^region_[0-9]+_([a-z]+)/", 1), F.lit(""))


def parse_region(name: Column) -> Column:
    """struct(order, type) of a region's name; numbered columns are 1 left and 2 right; others are null."""
    order = F.regexp_extract(name, r"^(?:region|column)_([0-9]+)", 1)
    kind = F.regexp_extract(name, r"^region_[0-9]+_([a-z]+)$", 1)
    column = F.when(name.rlike("^column_1$"), "left").when(name.rlike("^column_2$"), "right")
    kind = F.coalesce(F.nullif(kind, F.lit("")), column)
    return F.when(kind.isNotNull(), F.struct(order.cast("int").alias("order"), kind.alias("type")))


def padded(prefix: str, digits: int, number: Column) -> Column:
    """The number with leading zeros; a longer one stays whole."""
    return F.format_string(f"{prefix}%0{digits}d", number.cast("long"))


def line_id(region: Column, number: Column) -> Column:
    return F.concat(region, F.lit("/"), padded("line_", 3, number))


def page_id(number: Column) -> Column:
    return padded("page_", 4, number)


def page_artifact_id(number: Column, method: Column) -> Column:
    return F.concat(page_id(number), F.lit("_"), method)


def region_name(order: Column, kind: Column) -> Column:
    return F.concat(padded("region_", 2, order), F.lit("_"), kind)


def base_id(name: Column) -> Column:
    """The id without the method that made it."""
    return F.regexp_replace(name, "_(?:human|auto)$", "")


def page_number(name: Column) -> Column:
    """The number within page_NNNN, else null."""
    return F.nullif(F.regexp_extract(name, r"^page_(\d+)", 1), F.lit("")).cast("long")


def region_of_column(number: Column) -> Column:
    """The region that stands for a numbered column: 1 left, 2 right, others keep their number as a column."""
    return F.when(number == 1, "region_01_left").when(number == 2, "region_02_right").otherwise(F.concat(F.lit("column_"), number.cast("string")))


def repoint_key(key: Column) -> Column:
    """A key column_N/line_NNN moved to its region; other keys stay."""
    number = F.nullif(F.regexp_extract(key, r"^column_(\d+)/line_\d+$", 1), F.lit("")).cast("int")
    return F.when(number.isNotNull(), F.concat(region_of_column(number), F.regexp_extract(key, "(/line_[0-9]+)$", 1))).otherwise(key)


def tag_pages(text: Column, human: list[str]) -> Column:
    """Page tokens without a method get one: _human for pages of the given numbers, _auto for the others."""
    end = r"(?!\d)(?!_(?:human|auto))"
    out = F.regexp_replace(text, rf"(page_(?:{'|'.join(human)})){end}", "$1_human") if human else text
    return F.regexp_replace(out, rf"(page_\d+){end}", "$1_auto")


def strip_fences(c: Column) -> Column:
    return trim_ws(F.regexp_replace(F.regexp_replace(trim_ws(c), r"^```[A-Za-z]*\n?", ""), r"\n?```$", ""))


def replace_first(c: Column, find: Column, new: Column) -> Column:
    at = F.instr(c, find)
    return F.when((at > 0) & (find != ""), F.concat(F.left(c, at - 1), new, F.substring(c, at + F.length(find), F.length(c)))).otherwise(c)


def apply_edits(text: Column, changes: Column) -> Column:
    """struct(text, rejected) after array<struct<find,new>> in order, each replacing its first match; unmatched finds are rejected."""
    start = F.struct(text.alias("text"), F.array().cast("array<string>").alias("rejected"))

    def step(a, e):
        found = (F.instr(a["text"], e["find"]) > 0) & (e["find"] != "")
        return F.struct(replace_first(a["text"], e["find"], e["new"]).alias("text"), F.when(found, a["rejected"]).otherwise(F.concat(a["rejected"], F.array(e["find"]))).alias("rejected"))

    return F.aggregate(changes, start, step)


def percent(c: Column) -> Column:
    return F.when(c.isNotNull(), F.format_string("%.1f%%", c * 100)).otherwise("—")
