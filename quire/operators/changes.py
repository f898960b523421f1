"""Changes of labels, boxes and names, as events whose latest state is asked for, or as plans of moves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import trim_ws

ACTIONS = ("submit", "empty", "reject")


def label_states(events: DataFrame, keys: list[str], order: list[str], action: str = "action", text: str = "text") -> DataFrame:
    """Status and text of each line after its events, and how often an action took it out of rejection.

    A submitted text loses its last newlines; a blank or null one leaves the line empty. Unknown and null actions change
    nothing, and a line with no other has no row. order should tell the events of a line apart; of ties any counts as later."""
    known = events.filter(F.col(action).isin(*ACTIONS))
    kept = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"\n+\z", "")
    labeled = (F.col(action) == "submit") & (trim_ws(kept) != "")
    status = F.when(F.col(action) == "reject", "rejected").when(labeled, "labeled").otherwise("empty")
    before = F.lag(action).over(Window.partitionBy(*keys).orderBy(*order))
    back = (F.col(action) != "reject") & (before == "reject")
    rows = known.select(*keys, F.struct(*order).alias("_at"), F.struct(status.alias("status"), F.when(labeled, kept).otherwise("").alias("text")).alias("_state"), F.coalesce(back, F.lit(False)).alias("_back"))
    agg = rows.groupBy(*keys).agg(F.max_by("_state", "_at").alias("_state"), F.count("*").alias("n_events"), F.count_if("_back").alias("n_unrejected"))
    return agg.select(*keys, "_state.status", "_state.text", "n_events", "n_unrejected")


def saved(events: DataFrame, keys: list[str], order: list[str], values: list[str], source: str = "source") -> DataFrame:
    """What is saved of each key: the latest of human source, which no other replaces, else the latest of all."""
    human = F.coalesce(F.col(source) == "human", F.lit(False))
    latest = F.max_by(F.struct(source, *values), F.struct(human.alias("human"), *order)).alias("_saved")
    return events.groupBy(*keys).agg(latest, F.count("*").alias("n_saves")).select(*keys, "_saved.*", "n_saves")


def move_plan(names: DataFrame, name: str, target: Column) -> DataFrame:
    """(src, dst, blocked) for names whose target is another; nothing is moved.

    A move is blocked if its target stands among the names or is that of another move. Planned again after the moves
    that aren't blocked, they no longer occur; reversed_plan() leads back. Null names and targets have no row."""
    moves = names.select(F.col(name).alias("src"), target.alias("dst")).filter("src <> dst").distinct()
    taken = names.select(F.col(name).alias("dst"), F.lit(True).alias("taken")).filter("dst is not null").distinct()
    rivals = F.count("*").over(Window.partitionBy("dst"))
    return moves.withColumn("rivals", rivals).join(taken, "dst", "left").select("src", "dst", (F.coalesce("taken", F.lit(False)) | (F.col("rivals") > 1)).alias("blocked"))


def reversed_plan(plan: DataFrame) -> DataFrame:
    return plan.filter("not blocked").select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def page_selected(number: Column, pages: list[int] | None = None, first: int | None = None, last: int | None = None) -> Column:
    """Pages of a list, or of a range with both ends, or all; the list counts if both are given."""
    if pages is not None:
        return number.isin(*pages)
    low = F.lit(True) if first is None else number >= first
    return low if last is None else low & (number <= last)
