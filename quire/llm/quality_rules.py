"""Quality rules with risk-controlled thresholds; DataFrame functions only.

Each rule rejects a text whose measure lies beyond a cutoff. The good labelled texts of every stratum fall into two
halves. The first gives a path of cutoffs from lenient to strict: at each level, every rule's is the quantile that a
given share of these texts lies beyond. The second is the holdout: level by level, the texts that any rule rejects
are counted, and the level is certified while the exact binomial test refutes, at delta / strata, that alpha or
more of all good texts are rejected. The path ends at the first that isn't (fixed-sequence testing, so that its
steps need no further correction); Bonferroni covers the strata. So with probability 1 - delta no stratum loses
alpha or more of its good texts to the rules. Without a single rejection a holdout certifies from
log(delta / strata) / log(1 - alpha) texts on: 217 for four strata, 0.05 and 0.02.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, cut, let, maybe_broadcast, words_of

SYMBOLS = "#*$%&|<>"
#: Rule: its measure. Rejected are measures above the cutoff.
RULES: dict[str, str] = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_words": "n_repeat_words / greatest(n_words, 1)",
    "long_words": "word_chars / greatest(n_words, 1)",
    "short_words": "n_words / greatest(word_chars, 1)",
}
#: Share of a fit half's texts that lie beyond each rule's cutoff, from lenient to strict.
LEVELS = (0.0, 0.0005, 0.001, 0.002, 0.003, 0.004, 0.006, 0.008, 0.012, 0.016)
#: Share of the good texts of a stratum that the rules stay below, and the chance that this fails anywhere.
ALPHA, DELTA = 0.02, 0.05


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more: the windows' 64-bit hashes are sorted with their
    places, equal neighbours' places are sorted again, and each adds the words that the next doesn't cover."""
    windows = lambda w: F.array_sort(F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))))
    same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
    places = lambda s: F.array_sort(F.transform(F.filter(s, lambda x, j: same(x, F.get(s, j - 1)) | same(x, F.get(s, j + 1))), lambda x: x["i"]))
    covered = lambda p: F.aggregate(F.transform(p, lambda v, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - v, F.lit(3)))), F.lit(0), lambda a, v: a + v)
    return F.when(F.size(words) >= 3, let(windows(words), lambda s: let(places(s), covered))).otherwise(F.lit(0))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """(id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed) of each whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    long = lambda c: c.cast("long")
    counted = docs.select(
        F.col(id_col),
        F.col(stratum_col).alias("stratum"),
        let(words_of(text), lambda w: F.struct(long(F.size(w)).alias("n_words"), long(_repeat_words(w)).alias("n_repeat_words"))).alias("w"),
        long(F.length(F.regexp_replace(text, SPACE, ""))).alias("word_chars"),
        long(F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"),
        let(lines, lambda x: F.struct(long(F.size(x)).alias("n_lines"), long(F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"))).alias("l"),
    )
    return counted.select(id_col, "stratum", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines", F.expr("w.n_words < 50 or 100 * w.n_repeat_words > 50 * w.n_words").alias("base_failed"))


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(at most k of n) for k < n * p, exactly but for rounding: the last term in logarithms, times the sum of
    the terms over it, whose ratios j / (n - j + 1) * (1 - p) / p are all below 1."""
    k, n = k.cast("double"), n.cast("double")
    steps = F.sequence(F.lit(1), F.greatest(k, F.lit(1.0)).cast("long"))
    log_choose = F.aggregate(steps, F.lit(0.0), lambda a, i: a + F.when(i <= k, F.log((n - k + i) / i)).otherwise(0.0))
    log_last = log_choose + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def add(a, i):
        j = k - i + 1
        term = F.when(i <= k, a["term"] * j / (n - j + 1) * ((1 - p) / p)).otherwise(0.0)
        return F.struct(term.alias("term"), (a["total"] + term).alias("total"))

    return F.exp(log_last) * F.aggregate(steps, start, add, lambda a: a["total"])


def certify(labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA, id_col: str = "doc_id") -> DataFrame:
    """(stratum, n, level, cut_<rule> double): the strictest certified cutoffs from the measures of good labelled texts; null
    where no level is certified. n is the holdout's size.

    Texts that fail the base rules aren't counted: the cutoffs don't decide on them. An id is one trial, however
    often it stands there. Two aggregations whose rows are strata; quantiles are sketches of a fixed size.
    """
    once = labelled.filter("not base_failed").groupBy(id_col).agg(F.max(F.struct("stratum", *(F.expr(m).alias(rule) for rule, m in RULES.items()))).alias("m"))
    halves = once.select((F.crc32(F.col(id_col).cast("string")) % 2 == 0).alias("fit"), "m.*")
    shares = F.array(*(F.lit(1.0 - q) for q in LEVELS))
    paths = halves.filter("fit").groupBy("stratum").agg(*(F.percentile_approx(rule, shares, 10_000).alias(f"path_{rule}") for rule in RULES))
    held = halves.filter("not fit").alias("h").join(paths.alias("p"), F.col("h.stratum").eqNullSafe(F.col("p.stratum")))
    beyond = lambda j: F.greatest(*(F.col(f"h.{rule}") > F.col(f"p.path_{rule}")[j] for rule in RULES))
    counts = held.groupBy(F.col("p.stratum").alias("stratum"), *(F.col(f"p.path_{rule}").alias(f"path_{rule}") for rule in RULES)).agg(F.count("*").alias("n"), F.array(*(F.count_if(beyond(j)) for j in range(len(LEVELS)))).alias("k"))
    tested = counts.withColumn("limit", F.lit(delta) / F.count("*").over(_everything()))
    # a count that reaches its share can't be certified, so the sum is only formed below it
    passed = F.transform("k", lambda k: F.when(k < F.col("n") * alpha, binomial_cdf(k, F.col("n"), alpha) <= F.col("limit")).otherwise(F.lit(False)))
    failure = F.array_position(passed, False).cast("int")
    level = F.when(failure == 0, len(LEVELS)).otherwise(failure - 1)
    return tested.withColumn("level", level).select("stratum", "n", "level", *(F.get(f"path_{rule}", F.col("level") - 1).alias(f"cut_{rule}") for rule in RULES))


def _everything():
    """Over all strata."""
    return Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def judge(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """The measures of each text, base_failed and kept.

    Null texts have no words and so fail the base. Null strata are a stratum. Where a stratum has too few good
    labelled texts to certify a level, its rules reject nothing. Labels are (id, quality); nulls don't count, an id
    that repeats counts once. Rows out are rows in. Other columns aren't read.
    """
    measured = cut(measures(docs, id_col, text_col, stratum_col))
    good = labels.filter("quality = 1").select(F.col(id_col)).distinct()
    cuts = cut(certify(measured.join(good, id_col), alpha, delta, id_col))
    found = measured.alias("m").join(maybe_broadcast(cuts.drop("n", "level"), cuts.count()).alias("c"), F.col("m.stratum").eqNullSafe(F.col("c.stratum")), "left")
    rejected = [F.coalesce(F.expr(measure) > F.col(f"cut_{rule}"), F.lit(False)) for rule, measure in RULES.items()]
    verdict = ~F.col("base_failed")
    for r in rejected:
        verdict = verdict & ~r
    return found.select(f"m.{id_col}", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", verdict.alias("kept"), F.concat_ws("+", *(F.when(r, F.lit(rule)) for r, rule in zip(rejected, RULES))).alias("rejected_by"))
