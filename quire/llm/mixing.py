"""Mixing sources to target weights by fitting subset sums.

Documents are counted by source and exact size. A source's target takes whole passes over it; what remains
is first filled with the same share of every size, then fitted by a bounded-knapsack dynamic program over
the counts that are left, from a coarse unit to single words. Of each size, as many documents as it needs are taken in the order of a seeded hash.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut

#: Words, or coarser units of them, that the dynamic program fits at a time for each source.
FIT_WORDS = 1 << 16
#: Share of a budget by which a mix that looks like its source may miss it.
NEAR = 0.001
#: Rows of a (source, size) that one task ranks, about: larger groups are split by their hash.
RANKED = 50_000


def subset_sum(sizes: Sequence[int], counts: Sequence[int], budget: int) -> list[int]:
    """How many of each size to take, counts at most, so that the sum is as near below the budget as can be.

    Bounded knapsack on a bit set: counts are split into powers of two, a bit tells that a sum can be
    reached, and the sets after each step are kept to walk back. Larger sizes come first."""
    mask, reach, steps = (1 << (budget + 1)) - 1, 1, []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        left, chunk = min(counts[i], budget // sizes[i]) if sizes[i] > 0 else 0, 1
        while left > 0 and not reach >> budget & 1:
            n = min(chunk, left)
            steps.append((i, n, reach))
            reach |= reach << (sizes[i] * n) & mask
            left, chunk = left - n, chunk * 2
    at, taken = reach.bit_length() - 1, [0] * len(sizes)
    for i, n, before in reversed(steps):
        if not before >> at & 1:
            taken[i] += n
            at -= sizes[i] * n
    return taken


def fit(sizes: list[int], counts: list[int], budget: int) -> list[int]:
    """Documents to take of each size, within a budget of any height.

    Every size gives the budget's share of its documents, so that the mix looks like the source, and filled() fits
    the rest. Where that stays more than NEAR of the budget below it, as with few long documents, filled() has the
    whole budget, if this comes nearer."""
    total = lambda picks: sum(s * p for s, p in zip(sizes, picks))
    if budget >= total(counts):
        return list(counts)
    taken = filled(sizes, counts, budget, [c * budget // total(counts) for c in counts])
    if budget - total(taken) > NEAR * budget:
        taken = max(taken, filled(sizes, counts, budget, [0] * len(sizes)), key=total)
    return taken


def filled(sizes: list[int], counts: list[int], budget: int, taken: list[int]) -> list[int]:
    """taken and what subset_sum() fits into the rest of the budget.

    Above FIT_WORDS it counts in a coarser unit, sizes rounded up, so that the sum stays within the budget; what this
    leaves open is fitted again, in a finer unit, until it is counted word by word."""
    taken, rest = list(taken), budget - sum(s * t for s, t in zip(sizes, taken))
    while True:
        unit = -(-rest // FIT_WORDS) or 1
        open_ = [i for i, s in enumerate(sizes) if 0 < s <= rest and taken[i] < counts[i]]
        more = subset_sum([-(-sizes[i] // unit) for i in open_], [counts[i] - taken[i] for i in open_], rest // unit)
        if not any(more) and open_ and unit > 1:  # only rounding keeps the largest that fits out
            more[max(range(len(open_)), key=lambda j: sizes[open_[j]])] = 1
        for i, m in zip(open_, more):
            taken[i] += m
            rest -= m * sizes[i]
        if unit == 1 or not any(more):
            return taken


def targets(sources: DataFrame, weights: Sequence[int] = (5, 2, 1), total_share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources by code point, null last, get the weights in turn; total_share of all words is shared by weight,
    a target stops at most times its source's words, and the excess is shared again by weight until none is
    above. Each round of the loop is one small aggregation; only its two sums reach the driver.
    """
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = cut(sources.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * F.lit(most)).alias("most")))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    budget, price, full = total * total_share, 0.0, -1
    while True:
        # sources whose share would pass their limit are set to it; the others share the rest
        row = ranked.agg(F.sum(F.when(F.col("weight") * price >= F.col("most"), F.col("most")).otherwise(0.0)), F.sum(F.when(F.col("weight") * price < F.col("most"), F.col("weight")).otherwise(0.0)), F.count_if(F.col("weight") * price >= F.col("most"))).first()
        if row[2] == full or not row[1]:
            break
        full, price = row[2], (budget - row[0]) / row[1]
    return ranked.select("source", "source_size", F.least(F.col("most"), F.col("weight") * F.lit(price) if price else F.lit(0.0)).alias("target"))


def _hash(id_col: str, seed: int) -> Column:
    return F.xxhash64(F.col(id_col), F.lit(seed))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), total_share: float = 1.5, most: float = 2.0, seed: int = 11, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, source, size, source_size, target, taken) for each row of docs: how many words the mix takes of it.

    Null texts have size 0, null sources are one source. Rows with equal ids are told apart by their size or
    are interchangeable. Documents without words are never taken. Reruns agree: ranks go by a seeded hash of
    the id. A (source, size) of very many rows is ranked in parts by hash, so no task ranks more than about
    RANKED rows.
    """
    sized = cut(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long").alias("size")))
    histogram = cut(sized.groupBy("source", "size").agg(F.count("*").alias("n")))
    budgets = cut(targets(histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, total_share, most))

    def fit_source(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", ascending=False)
        sizes, counts = rows["size"].tolist(), rows["n"].tolist()
        words, target = int(rows["source_size"].iloc[0]), float(rows["target"].iloc[0])
        passes = min(int(target // words), 2) if words else 0
        rows["passes"] = passes
        rows["extra"] = fit(sizes, counts, int(target) - passes * words)
        return rows[["source", "size", "n", "source_size", "target", "passes", "extra"]]

    schema = "source string, size long, n long, source_size long, target double, passes long, extra long"
    wanted = histogram.alias("h").join(budgets.alias("b"), F.col("h.source").eqNullSafe(F.col("b.source"))).select("h.source", "h.size", "h.n", "b.source_size", "b.target")
    picks = cut(wanted.groupBy("source").applyInPandas(fit_source, schema))

    ranks = sized.alias("d").join(picks.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.size") == F.col("p.size")))
    ranks = ranks.select("d.id", "d.source", "d.size", "p.source_size", "p.target", "p.passes", "p.extra", _hash("d.id", seed).alias("h"), (F.col("p.n") / RANKED).cast("long").alias("splits"))
    ranks = ranks.withColumn("part", F.pmod(F.col("h"), F.col("splits") + 1))
    # rows of earlier parts come first; their counts shift the rank within a part
    counts = ranks.filter("splits > 0").groupBy("source", "size", "part").agg(F.count("*").alias("m"))
    before = counts.select("source", "size", "part", (F.sum("m").over(Window.partitionBy("source", "size").orderBy("part")) - F.col("m")).alias("shift"))
    shifted = ranks.alias("r").join(before.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")) & (F.col("r.size") == F.col("s.size")) & (F.col("r.part") == F.col("s.part")), "left").select("r.*", F.coalesce("s.shift", F.lit(0)).alias("shift"))
    rank = F.row_number().over(Window.partitionBy("source", "size", "part").orderBy("h", "id")) + F.col("shift")
    copies = F.col("passes") + (rank <= F.col("extra")).cast("long")
    return shifted.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", (F.col("size") * copies).alias("taken"))
