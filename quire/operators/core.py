"""Relational operators over lines, pages, runs and intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Tasks for each core that spread() deals rows to.
SPREAD = 4


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt out evenly, for steps whose time is far beyond their bytes: files of few bytes are read by few tasks."""
    tasks = SPREAD * rows.sparkSession.sparkContext.defaultParallelism
    return rows.withColumn("_dealt", F.monotonically_increasing_id()).repartition(tasks, "_dealt").drop("_dealt")


#: Rows of a task, about, that gathered() makes.
GATHERED = 500_000


def gathered(rows: DataFrame, key: str) -> DataFrame:
    """Rows of a key together, in tasks whose number grows with the rows: what a task sorts stays as it is."""
    tasks = max(rows.count() // GATHERED + 1, rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(tasks, key)


def length_bin(length: Column) -> Column:
    return F.when(length <= 10, "0-10").when(length <= 20, "11-20").when(length <= 30, "21-30").otherwise("31+")


def corpus_rate(rows: DataFrame, keys: list[str], edits: str = "edits", length: str = "ref_len") -> DataFrame:
    """Edits per reference character of each group: sums first, one division. Partial sums before the shuffle."""
    agg = rows.groupBy(*keys).agg(F.count("*").alias("n_lines"), F.sum(edits).cast("long").alias("edits"), F.sum(length).cast("long").alias("ref_len"))
    return agg.withColumn("cer", F.try_divide(F.col("edits").cast("double"), F.col("ref_len").cast("double")))


def length_bins(rows: DataFrame, keys: list[str]) -> DataFrame:
    """corpus_rate() of each group and length bin, with the mean of the lines' own rates; empty bins have no row."""
    binned = rows.withColumn("length_bin", length_bin(F.col("ref_len")))
    agg = binned.groupBy(*keys, "length_bin").agg(F.count("*").alias("n_lines"), F.round(F.avg("cer"), 9).alias("mean_cer"), F.sum("edits").cast("long").alias("edits"), F.sum("ref_len").cast("long").alias("ref_len"))
    return agg.withColumn("cer", F.try_divide(F.col("edits").cast("double"), F.col("ref_len").cast("double")))


def weighted_mean(pages: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
    """Mean of a page's value, weighed; null without weight. Pages whose value is null don't count."""
    known = pages.filter(F.col(value).isNotNull())
    return known.groupBy(*keys).agg(F.count("*").alias("n_pages"), F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(weight).cast("double")).alias("weighted"))


def group_means(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Size and mean of each group, from the highest mean down."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(value).alias("mean")).orderBy(F.desc("mean"), *keys)


def high_ink(line_id: Column, ink: Column, median: Column, factor: float = 1.6, exempt: tuple[str, ...] = ("header",)) -> Column:
    """Whether a line has more ink than factor times its page's median; types of region that are exempt never have."""
    kind = F.regexp_extract(line_id, r"^region_[0-9]+_([a-z]+)/", 1)
    return (median > 0) & (ink > factor * median) & ~kind.isin(*exempt)


def confusion(rows: DataFrame, keys: list[str], truth: str = "truth", found: str = "found") -> DataFrame:
    """Confusion counts with precision, recall and F1, null where undefined; a roll-up adds the micro-average.

    level is 0 for a group and above for a roll-up, so that a null key isn't taken for one."""
    t, f = F.col(truth), F.col(found)
    counts = rows.rollup(*keys).agg(F.grouping_id().alias("level"), *(F.count_if(c).alias(n) for n, c in (("tp", t & f), ("fp", ~t & f), ("fn", t & ~f), ("tn", ~t & ~f))))
    d = lambda c: c.cast("double")
    p, r = F.try_divide(d(F.col("tp")), d(F.col("tp") + F.col("fp"))), F.try_divide(d(F.col("tp")), d(F.col("tp") + F.col("fn")))
    return counts.withColumn("precision", p).withColumn("recall", r).withColumn("f1", F.try_divide(d(2 * F.col("tp")), d(2 * F.col("tp") + F.col("fp") + F.col("fn"))))


def page_ratio(rows: DataFrame, key: str, value: str) -> DataFrame:
    """value over the median of its page; 0.0 where the median isn't above 0."""
    medians = rows.groupBy(key).agg(F.median(value).alias("page_median"))
    ratio = F.when(F.col("page_median") > 0, F.col(value) / F.col("page_median")).otherwise(0.0)
    return rows.join(medians, key).withColumn("ratio", ratio)


def runs(rows: DataFrame, keys: list[str], position: str, flag: Column, max_gap: int = 0) -> DataFrame:
    """(keys, run_start, run_end, run_len): maximal runs where flag holds, bridging gaps up to max_gap."""
    order = Window.partitionBy(*keys).orderBy(position)
    on = rows.filter(flag).withColumn("_gap", F.col(position) - F.lag(position).over(order) - 1)
    island = F.sum(F.when(F.col("_gap") <= max_gap, 0).otherwise(1)).over(order)
    grouped = on.withColumn("_island", island).groupBy(*keys, "_island")
    out = grouped.agg(F.min(position).alias("run_start"), F.max(position).alias("run_end"))
    return out.withColumn("run_len", F.col("run_end") - F.col("run_start") + 1).drop("_island")


def moving_average(rows: DataFrame, keys: list[str], position: str, value: str, width: int = 7) -> DataFrame:
    """Centred box average that counts places beyond the ends as zero."""
    frame = Window.partitionBy(*keys).orderBy(position).rowsBetween(-(width // 2), width // 2)
    return rows.withColumn("smooth", F.sum(value).over(frame) / width)


def best_overlap(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """For intervals new(key, n_id, n_start, n_end), the old one (o_id, o_start, o_end) of most overlap.

    The first old one wins ties; o_id is -1 where none overlaps. Ends are outside. The pairs are those of a
    key whose intervals meet."""
    meets = (new[key] == old[key]) & (F.col("n_start") < F.col("o_end")) & (F.col("o_start") < F.col("n_end"))
    overlap = F.least("n_end", "o_end") - F.greatest("n_start", "o_start")
    pairs = new.join(old, meets, "left").select(new[key], "n_id", F.when(F.col("o_id").isNotNull(), overlap).otherwise(0).alias("overlap"), F.coalesce("o_id", F.lit(-1)).alias("o_id"))
    best = F.max(F.struct("overlap", (-F.col("o_id")).alias("back"))).alias("b")
    return pairs.groupBy(key, "n_id").agg(best).select(key, "n_id", (-F.col("b.back")).alias("o_id"), F.col("b.overlap").alias("overlap"))


def by_priority(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the first by order (a human's before a program's, the latest event, a later source)."""
    return rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rank = 1").drop("_rank")


def joined_text(rows: DataFrame, keys: list[str], order: str, text: str, sep: str = "\n") -> DataFrame:
    """Texts of each key in order, joined."""
    parts = F.array_sort(F.collect_list(F.struct(order, text)))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda x: x[text]), sep).alias("doc"))


def nested_split(rows: DataFrame, key: str, seed: str, holdout: int, sizes: list[int]) -> DataFrame:
    """(key, rank, part): a seeded order whose first rows are held out and whose next ones form nested train sets.

    part is 'test', or the smallest train set that has the row; null beyond the largest. Only the first
    holdout + max(sizes) rows are ranked, so the order is a top-k and no full sort in one task."""
    most = holdout + max(sizes)
    mark = F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)))
    first = rows.select(key, mark.alias("mark")).orderBy("mark", key).limit(most)
    found = first.count()
    if found < most:
        raise ValueError(f"{found} rows are too few for a holdout of {holdout} and a train set of {max(sizes)}")
    rank = first.withColumn("rank", F.row_number().over(Window.orderBy("mark", key)))
    part = F.when(F.col("rank") <= holdout, "test")
    for n in sorted(sizes):
        part = part.when(F.col("rank") <= holdout + n, f"train_{n}")
    return rank.select(key, F.col("rank").cast("long").alias("rank"), part.alias("part"))


def circuit_breaker(events: DataFrame, run: list[str], order: list[str], ok: str, fatal: str, failures: int = 3) -> DataFrame:
    """events with stopped: whether the run would have ended at or before each, by a fatal error or by failures without a success.

    An event log of a run is small and ordered; its running sums take one task per run. order should have no ties."""
    w = Window.partitionBy(*run).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    bad, good = F.sum(F.when(~F.col(ok), 1).otherwise(0)).over(w), F.sum(F.when(F.col(ok), 1).otherwise(0)).over(w)
    at = events.withColumn("_stop", ((bad >= failures) & (good == 0)) | F.col(fatal))
    return at.withColumn("stopped", F.max("_stop").over(w)).drop("_stop")


def pending(plan: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the plan that aren't done."""
    return plan.join(done.select(*keys), keys, "left_anti")


def line_status(rejected: Column, has_text: Column, text: Column) -> Column:
    """rejected, pending without a text, labeled, or empty where the text is blank."""
    return F.when(rejected, "rejected").when(~has_text, "pending").when(F.trim(text) != "", "labeled").otherwise("empty")


def status_counts(rows: DataFrame, keys: list[str], status: str, names: list[str]) -> DataFrame:
    """How many rows of each key have each of the named states, and all of them."""
    return rows.groupBy(*keys).agg(*(F.count_if(F.col(status) == n).alias(n) for n in names), F.count("*").alias("total"))


def with_default(rows: DataFrame, other: DataFrame, keys: list[str], value: str, default: Column) -> DataFrame:
    """rows with the other's value by key, the default where it has none; rows that don't match stay."""
    return rows.join(other.select(*keys, value), keys, "left").withColumn(value, F.coalesce(F.col(value), default))


def by_hash(new: DataFrame, old: DataFrame, content: str, new_id: str, old_id: str) -> DataFrame:
    """Each new row with the old row of equal content, found by its SHA-1; the first of equal old ones, null without one."""
    first = old.groupBy(F.sha1(content).alias("_hash")).agg(F.min(old_id).alias(old_id))
    keyed = new.withColumn("_hash", F.sha1(content))
    return keyed.join(first, "_hash", "left").select(new_id, old_id)


def renumbered(rows: DataFrame, keys: list[str], order: list[Column], name: str = "new_no") -> DataFrame:
    """Rows numbered from 1 in reading order within each key."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def even_picks(n: int, share: float) -> list[int]:
    """Places spread evenly over n, at least one and never all; none of one or fewer."""
    if n <= 1:
        return []
    most = min(max(1, round(n * share)), n - 1)
    return sorted({int((k + 0.5) * n / most) for k in range(most)})


def even_holdout(pages: DataFrame, key: str, share: float = 0.2) -> DataFrame:
    """(key, place, part): pages in order, those at even distances are 'test', the others 'train'.

    A page is in the test part if some k has its place: that is a bound on k for each page, no list of picks."""
    n = pages.count()
    most = min(max(1, round(n * share)), n - 1) if n > 1 else 0
    placed = pages.select(key).withColumn("place", F.row_number().over(Window.orderBy(key)) - 1)
    k = F.ceil(F.col("place") * F.lit(most / n if n else 0.0) - 0.5)
    near = F.array(*(F.greatest(k + d, F.lit(0)) for d in (-1, 0, 1)))
    hit = F.exists(near, lambda x: (x < most) & (F.floor((x + 0.5) * F.lit(float(n)) / F.lit(float(max(most, 1)))) == F.col("place")))
    return placed.withColumn("part", F.when(hit, "test").otherwise("train"))


def split_label(rows: DataFrame, keys: list[str], child: str, label: str) -> DataFrame:
    """(keys, child, part, outcome): a label's lines go to the children of a run one by one if there are as many of both.

    Blank labels mark every child; where the numbers differ the children are to be labeled again, without a part."""
    own = Window.partitionBy(*keys)
    parts = F.split(F.regexp_replace(label, r"\n+$", ""), "\n")
    n, at = F.count("*").over(own), F.row_number().over(own.orderBy(child))
    # the label is split behind the windows, whose rows are sorted without its parts
    out = rows.withColumn("_n", n).withColumn("_at", at).withColumn("_parts", parts)
    outcome = F.when(F.trim(F.regexp_replace(label, r"\s+", " ")) == "", "marker").when(F.size("_parts") == F.col("_n"), "autosplit").otherwise("relabel")
    out = out.withColumn("outcome", outcome)
    return out.select(*keys, child, F.when(F.col("outcome") == "autosplit", F.get("_parts", F.col("_at") - 1)).when(F.col("outcome") == "marker", F.col(label)).alias("part"), "outcome")


def contained_pieces(new: DataFrame, old: DataFrame, key: str, width: int) -> DataFrame:
    """(key, o_id, n_pieces): new intervals (n_start, n_end) within each old one (o_start, o_end), its end plus one included.

    Both meet by buckets of width that an old interval covers and a new one starts in, not by key alone."""
    at = old.withColumn("_b", F.explode(F.sequence(F.floor(F.col("o_start") / width), F.floor((F.col("o_end") + 1) / width))))
    own = new.withColumn("_b", F.floor(F.col("n_start") / width)).select(F.col(key).alias("_k"), "_b", "n_start", "n_end")
    inside = at.join(own, (at[key] == own["_k"]) & (at["_b"] == own["_b"]) & (F.col("n_start") >= F.col("o_start")) & (F.col("n_end") <= F.col("o_end") + 1))
    return inside.groupBy(at[key], "o_id").agg(F.count("*").alias("n_pieces"))


def verdict(rate: Column) -> Column:
    """PASS below 0.15, PARTIAL below 0.40, else FAIL; null without a rate."""
    return F.when(rate < 0.15, "PASS").when(rate < 0.40, "PARTIAL").when(rate.isNotNull(), "FAIL")


def is_glyph(width: Column, height: Column, area: Column, col_width: Column, col_height: Column, least_height: int = 40, fill: tuple[float, float] = (0.15, 0.85)) -> Column:
    """Whether a connected component may be one letter: no speck, no line, not half as wide as its column; one that is more than
    half as high must be large and filled like a letter."""
    shape = (area >= 20) & (width <= 8 * height) & (height <= 8 * width) & (width <= 0.5 * col_width)
    extent = F.when((width > 0) & (height > 0), area / (width * height)).otherwise(1.0)
    return shape & ((height <= 0.5 * col_height) | ((height >= least_height) & extent.between(*fill)))
