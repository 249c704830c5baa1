"""Quality rules with thresholds whose risk is controlled on labelled texts. DataFrame functions only.

Besides fixed base rules, each text has a few measures, and each measure a grid of cutoffs. In every stratum a small design
fold of the labelled texts puts all steps (a measure and a cutoff) in one order: fewest good texts rejected first, then most
bad ones. Steps are taken in that order, a text being rejected if it is above the cutoff of any step taken, and tested on
the other labelled texts of quality 1, the holdout: the exact (Clopper-Pearson) upper bound of the rate at which the steps
so far reject good texts, all together, has to stay below LIMIT. The first step that fails ends the sequence, so testing
many steps needs no correction (the order was fixed before the holdout was looked at); testing many strata does, and each
has a share of DELTA in proportion to its holdout (a weighted Bonferroni correction). So with probability 1 - DELTA, in no
stratum do the measures reject more than LIMIT of the good texts that pass the base rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.llm.common import cut

#: Greatest rate of false rejection in a stratum by all measures together, and the chance that this fails anywhere.
LIMIT, DELTA = 0.02, 0.05
#: Strata are broadcast up to this many.
BROADCAST_STRATA = 10_000
#: First hex digits of the MD5 of the ids whose labels make the design fold, an eighth.
DESIGN = "01"
# Fixed values of the base rules.
SPACE, SYMBOLS = " \t\n\u000b\f\r", "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50

#: Measures by name: a column of the counted features, and the cutoffs tried (a text is rejected above one).
GRID = {
    "symbol_share": [0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.3, 0.5],
    "dup_lines_per_100_words": [0.5, 1, 2, 3, 5, 8, 12, 20, 40],
    "repeat_share": [0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5],
    "mean_word": [5.5, 6, 6.5, 7, 7.5, 8, 9, 10, 12, 15],
    "upper_share": [0.05, 0.1, 0.2, 0.3, 0.5, 0.7],
}


def counted(docs: DataFrame) -> DataFrame:
    """docs (id and text columns, others kept) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and n_upper, without text.

    Words are runs without white space (\\x20, \\x09 to \\x0D). A null text counts as empty. Three-word windows are told
    apart by a 64-bit hash of their words within one text.
    """
    text = F.coalesce("text", F.lit(""))
    without = lambda chars: F.length(text) - F.length(F.translate(text, chars, ""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    rows = docs.select(
        *[c for c in docs.columns if c != "text"],
        F.filter(F.split(F.translate(text, SPACE, " " * 6), " ", -1), lambda x: x != "").alias("_words"),
        F.length(F.translate(text, SPACE, "")).cast("long").alias("word_chars"),
        without(SYMBOLS).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
        without("ABCDEFGHIJKLMNOPQRSTUVWXYZ").cast("long").alias("n_upper"),
    )
    rest = [c for c in rows.columns if not c.startswith("_")]
    n = F.size("_words")
    w = lambda i: F.get("_words", i)
    at = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    rows = rows.select(
        *rest,
        n.cast("long").alias("n_words"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(F.transform(at, lambda i: F.struct(F.xxhash64(w(i), w(i + 1), w(i + 2)).alias("h"), i.alias("i")))).alias("_sorted"),
    )
    rest = [c for c in rows.columns if not c.startswith("_")]
    h = lambda i: F.get("_sorted", i)["h"]
    twice = F.filter(F.transform("_sorted", lambda x, i: F.when((h(i - 1) == x["h"]) | (h(i + 1) == x["h"]), x["i"])), lambda x: x.isNotNull())
    rows = rows.select(*rest, F.sort_array(twice).alias("_twice"))
    # Of each repeated window, the words up to the next repeated window's first, three at most.
    own = F.transform("_twice", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("_twice", i + 1) - x, F.lit(3))))
    return rows.select(*rest, F.aggregate(own, F.lit(0), lambda a, x: a + x).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def _measures() -> dict[str, Column]:
    per = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    return {
        "symbol_share": per("n_symbols", "word_chars"),
        "dup_lines_per_100_words": 100 * per("n_dup_lines", "n_words"),
        "repeat_share": per("n_repeat_words", "n_words"),
        "mean_word": per("word_chars", "n_words"),
        "upper_share": per("n_upper", "word_chars"),
    }


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) of a binomial (n, p), summed in logarithms from its first term. The upper bound of k in n is below p if this is below the level."""
    step = F.struct(F.lit(0.0).alias("s"), (n * F.log1p(F.lit(-p))).cast("double").alias("t"))
    odds = F.log(F.lit(p / (1 - p)))
    upto = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k.cast("long"))).otherwise(F.array().cast("array<long>"))
    grown = F.aggregate(
        upto,
        F.struct(F.exp(step["t"]).alias("s"), step["t"].alias("t")),
        lambda a, i: F.struct((a["s"] + F.exp(a["t"] + F.log((n - i + 1) / i) + odds)).alias("s"), (a["t"] + F.log((n - i + 1) / i) + odds).alias("t")),
        lambda a: a["s"],
    )
    return F.least(F.lit(1.0), grown)


#: All steps by measure and place in its grid.
STEPS = [(m, i, float(c)) for m, grid in GRID.items() for i, c in enumerate(grid)]


def in_order(labelled: DataFrame) -> DataFrame:
    """(stratum, one column for each step with its place in the stratum's order), from the design fold's counts.

    Ties go to the more lenient cutoff of its grid, then by the measures' names.
    """
    count = lambda q: [F.count_if(F.col("design") & (F.col("quality") == q) & (F.col(m) > c)).alias(f"n{q}_{m}_{i}") for m, i, c in STEPS]
    counts = labelled.groupBy("stratum").agg(*count(0), *count(1))
    steps = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(i).alias("i"), F.col(f"n1_{m}_{i}").alias("good"), F.col(f"n0_{m}_{i}").alias("bad")) for m, i, _ in STEPS])
    place = F.row_number().over(Window.partitionBy("stratum").orderBy("good", F.desc("bad"), F.desc("i"), "m"))
    placed = counts.select("stratum", F.inline(steps)).withColumn("place", place)
    return placed.groupBy("stratum").agg(*[F.max(F.when((F.col("m") == m) & (F.col("i") == i), F.col("place"))).alias(f"place_{m}_{i}") for m, i, _ in STEPS])


def cutoffs(labelled: DataFrame, limit: float = LIMIT, delta: float = DELTA) -> DataFrame:
    """(stratum, one column per measure): the least cutoff of the steps taken, null where there is none.

    labelled: stratum, the measures, quality and design of labelled texts that pass the base rules. A stratum without a
    holdout takes no step. Counting is one aggregation for each fold; all else is done on rows by stratum and step.
    """
    order = in_order(labelled)
    few = F.broadcast(order) if order.count() <= BROADCAST_STRATA else order
    holdout = labelled.where(~F.col("design") & (F.col("quality") == 1)).join(few, "stratum")
    first = F.least(*[F.when(F.col(m) > c, F.col(f"place_{m}_{i}")) for m, i, c in STEPS])
    counts = holdout.groupBy("stratum", F.coalesce(first, F.lit(len(STEPS) + 1)).alias("place")).agg(F.count("*").alias("k"))
    # Every step's place, those that no text is the first to fall by included.
    places = counts.groupBy("stratum").agg(F.sum("k").alias("n"), F.map_from_entries(F.collect_list(F.struct("place", "k"))).alias("by"))
    places = places.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))))
    places = places.select("stratum", "n", "share", "by", F.explode(F.sequence(F.lit(1), F.lit(len(STEPS)))).alias("place"))
    upto = Window.partitionBy("stratum").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    joint = places.withColumn("k", F.sum(F.coalesce(F.try_element_at("by", "place"), F.lit(0))).over(upto))
    passed = joint.where((F.col("k") < limit * F.col("n")) & (binomial_tail(F.col("n"), F.col("k"), limit) < delta * F.col("share")))
    last = passed.groupBy("stratum").agg(F.max("place").alias("last"))
    cuts = [F.array_min(F.array(*[F.when(F.col(f"place_{m}_{i}") <= F.col("last"), F.lit(c)) for n, i, c in STEPS if n == m])).alias(f"cut_{m}") for m in GRID]
    return order.join(last, "stratum").select("stratum", *cuts)


def judged(docs: DataFrame, labels: DataFrame, stratum: str = "lang", limit: float = LIMIT, delta: float = DELTA) -> DataFrame:
    """For each row of docs: doc_id, the counts, base_failed, kept, and the measures' names that reject it.

    A null stratum is a stratum of its own; one with too few labelled good texts for any step keeps all that pass the base
    rules. Only narrow rows are checkpointed and shuffled: the text is read once. Repeated rows come out as often as they
    come in; a label that lacks an id or value doesn't count, and an id with several counts by its largest. However often a
    labelled id occurs, it is one draw of the binomial: of its rows that pass the base rules, that of the least stratum and
    measures. Ids are taken as drawn, so copies of a text under several labelled ids are as many draws.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(stratum).cast("string"), F.lit("\u0000null")).alias("stratum"), "text")
    features = cut(counted(rows).withColumn("base_failed", base_failed()).withColumns(_measures()))
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality"))
    design = F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1).isin(*DESIGN)
    drawn = features.where(~F.col("base_failed")).join(known, "doc_id").groupBy("doc_id", "quality").agg(F.min(F.struct("stratum", *GRID)).alias("one"))
    labelled = cut(drawn.select("one.*", "quality", design.alias("design")))
    limits = cut(cutoffs(labelled, limit, delta))
    # One row for each stratum; broadcast behind a check of their number, else joined by shuffle.
    named = F.broadcast(limits) if limits.count() <= BROADCAST_STRATA else limits
    rejects = F.array_compact(F.array(*[F.when(F.col(m) > F.col(f"cut_{m}"), F.lit(m)) for m in GRID]))
    both = features.join(named, "stratum", "left").withColumn("rejected_by", rejects)
    kept = ~F.col("base_failed") & (F.size("rejected_by") == 0)
    return both.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "rejected_by")
