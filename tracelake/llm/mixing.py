"""Mixing sources to target weights under a token budget. DataFrame functions only.

Leaves are (domain, lang, source). The budget goes down the tree by the children's weights; a child that cannot use its
share (its tokens times the most epochs) passes the shortage to its siblings, and only what they all cannot use goes to the
siblings of their parent. Each leaf then takes whole epochs of its documents and a prefix of one more, in an order seeded
by the epoch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.llm.common import cut

LEVELS = ("domain", "lang", "source")
#: Weights of nodes by level; others weigh 1. Share of all tokens that is asked for, the most epochs, and the seed.
WEIGHTS = {"domain": {"web": 3.0, "books": 1.0}, "lang": {"en": 4.0, "fr": 2.0, "de": 2.0, "es": 2.0}, "source": {"src0": 2.0}}
BUDGET_SHARE, MOST_EPOCHS, SEED = 0.8, 2, 17
#: Leaves are broadcast up to this many.
BROADCAST_LEAVES = 50_000
#: A leaf's documents are dealt to ranges by so many bits of the seeded order, and those of the range in which the budget
#: ends by as many more, until no such range has over SORTED of them; only these are sorted.
BITS, SORTED = 8, 4096
#: A null lang or source is a node of this name.
NULL = "\u0000null"


def with_leaf(docs: DataFrame, *others: Column) -> DataFrame:
    """doc_id (as a long), _hash (of the text), _domain, _lang and _source of docs (null is a node of its own), and `others`.

    The domain is books for every third source, by a hash of its name, and web for the others.
    """
    source = F.coalesce(F.col("source").cast("string"), F.lit(NULL))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("_hash"),
        F.when(F.pmod(F.crc32(source), F.lit(3)) == 0, "books").otherwise("web").alias("_domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit(NULL)).alias("_lang"),
        source.alias("_source"),
        *others,
    )


def _n_words() -> Column:
    words = F.translate(F.coalesce("text", F.lit("")), " \t\n\u000b\f\r", " " * 6)
    return F.size(F.filter(F.split(words, " ", -1), lambda x: x != "")).cast("long")


def _weight(level: str, weights: dict[str, dict[str, float]]) -> Column:
    out = F.lit(1.0)
    for name, w in weights.get(level, {}).items():
        out = F.when(F.col(f"_{level}") == name, F.lit(float(w))).otherwise(out)
    return out


def filled(nodes: DataFrame, parent: list, name: str) -> DataFrame:
    """Add budget: `given` (of the parent) dealt to the nodes of each parent by weight, none above its capacity.

    In the order of capacity over weight, a node is full as long as an even level of what is left would overflow it; the
    first that is not fixes the level for itself and the rest.
    """
    kin = Window.partitionBy(*parent).orderBy(F.col("capacity") / F.col("weight"), name)
    before = F.coalesce(F.sum("capacity").over(kin.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(kin.rowsBetween(0, Window.unboundedFollowing))
    level = F.greatest(F.lit(0.0), F.col("given") - before) / rest
    fits = nodes.withColumn("_level", level).withColumn("_open", F.col("_level") <= F.col("capacity") / F.col("weight"))
    final = F.min(F.when(F.col("_open"), F.struct(F.col("capacity") / F.col("weight"), F.col(name), F.col("_level").alias("level")))).over(Window.partitionBy(*parent))
    return fits.withColumn("_final", final["level"]).withColumn("budget", F.when(F.col("_final").isNull(), F.col("capacity")).otherwise(F.least("capacity", F.col("_final") * F.col("weight")))).drop("_level", "_open", "_final")


def budgets(leaves: DataFrame, weights=None, budget: float | None = None, share: float = BUDGET_SHARE, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """(_domain, _lang, _source, supply, budget) from leaves with supply. Without `budget`, it is `share` of all supply."""
    weights = WEIGHTS if weights is None else weights
    keys = [f"_{x}" for x in LEVELS]
    out = None
    for depth, level in enumerate(LEVELS):
        nodes = leaves.groupBy(*keys[: depth + 1]).agg((F.sum("supply") * F.lit(float(most_epochs))).cast("double").alias("capacity"), F.sum("supply").alias("supply"))
        nodes = nodes.withColumn("weight", _weight(level, weights))
        if out is None:
            asked = F.lit(float(budget)) if budget is not None else share * F.sum("supply").over(Window.partitionBy(F.lit(0)))
            nodes = nodes.withColumn("given", asked)
        else:
            nodes = nodes.join(out.select(*keys[:depth], F.col("budget").alias("given")), keys[:depth])
        out = filled(nodes.where("capacity > 0 and weight > 0"), keys[:depth] or [F.lit(0)], keys[depth]).drop("given")
    return out.select(*keys, "supply", "budget")


def plan(rows: DataFrame, weights=None, budget: float | None = None, share: float = BUDGET_SHARE, most_epochs: int = MOST_EPOCHS, seed: int = SEED) -> DataFrame:
    """One row per leaf: whole epochs, and where the started epoch's prefix ends in the seeded order.

    All places whose leading `depth` bits are below `prefix` are taken, and of those that begin with it the ones up to `last`.

    rows: narrow (doc_id, _hash, leaf columns, _tokens). Sums by leaf and range of the order find the range in which the
    budget ends, then the range within it, and so on; only the last one's documents are ordered. Rows of one id and text go
    in or stay out together.
    """
    keys = [f"_{x}" for x in LEVELS]
    leaves = rows.groupBy(*keys).agg(F.sum("_tokens").alias("supply"))
    leaf = budgets(leaves, weights, budget, share, most_epochs)
    leaf = leaf.withColumn("epochs", F.floor(F.col("budget") / F.col("supply")).cast("int")).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("supply"))
    leaf = cut(leaf.select(*keys, "supply", "budget", "epochs", "rest"))
    ordered = rows.join(_broadcast_if_few(leaf), keys).select(*keys, "rest", "_tokens", place_of(F.col("epochs"), seed).alias("place"))
    # The open range of each leaf: its leading bits so far, and the tokens before it.
    edge, depth = leaf.select(*keys, F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("before")), 0
    while True:
        inside = ordered.join(_broadcast_if_few(edge), keys).where(_leading(depth) == F.col("prefix"))
        most = inside.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
        if most <= SORTED or depth + BITS > 63:
            break
        depth += BITS
        sums = inside.groupBy(*keys, _leading(depth).alias("next")).agg(F.sum("_tokens").alias("tokens"), F.max("rest").alias("rest"), F.max("before").alias("start"))
        upto = Window.partitionBy(*keys).orderBy("next").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.col("start") + F.coalesce(F.sum("tokens").over(upto), F.lit(0)))
        # The last range that begins within the budget; it ends there or is the leaf's last.
        at = F.max(F.struct(F.col("next").alias("prefix"), "before")).alias("at")
        edge = cut(sums.where("before <= rest").groupBy(*keys).agg(at).select(*keys, "at.prefix", "at.before"))
    order = Window.partitionBy(*keys).orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    taken = inside.withColumn("upto", F.col("before") + F.sum("_tokens").over(order)).where("upto <= rest").groupBy(*keys).agg(F.max("place").alias("last"))
    out = leaf.join(edge.select(*keys, "prefix"), keys, "left").join(taken, keys, "left")
    return out.select(*keys, "supply", "budget", "epochs", "prefix", F.lit(depth).alias("depth"), "last")


def place_of(epoch: Column, seed: int) -> Column:
    """A row's place in the order of an epoch: 63 bits of a seeded hash, then the id and the text's hash, which settle ties.

    Without a sign, so the order of keys is that of their leading bits, however many of them are looked at.
    """
    return F.struct(F.shiftrightunsigned(F.xxhash64(F.lit(seed), epoch, F.col("doc_id"), F.col("_hash")), 1).alias("key"), F.col("doc_id").alias("id"), F.col("_hash").alias("hash"))


def _leading(bits: int) -> Column:
    return F.shiftrightunsigned(F.col("place.key"), 63 - bits) if bits else F.lit(0).cast("long")


def _broadcast_if_few(leaves: DataFrame) -> DataFrame:
    return F.broadcast(leaves) if leaves.count() <= BROADCAST_LEAVES else leaves


def selected(rows: DataFrame, leaf_plan: DataFrame, seed: int = SEED) -> DataFrame:
    """rows (doc_id, _hash, leaf columns, others that begin with _) as often as their leaf's epochs take them, with _epoch from 0.

    A filter against the plan's few rows: the documents are not shuffled.
    """
    keys = [f"_{x}" for x in LEVELS]
    both = rows.join(leaf_plan.select(*keys, "epochs", "prefix", "depth", "last"), keys).withColumn("place", place_of(F.col("epochs"), seed))
    leading = F.when(F.col("depth") == 0, F.lit(0).cast("long")).otherwise(F.expr("shiftrightunsigned(place.key, 63 - depth)"))
    upto = (leading < F.col("prefix")) | ((leading == F.col("prefix")) & F.coalesce(F.col("place") <= F.col("last"), F.lit(False)))
    times = F.col("epochs") + F.when(upto, 1).otherwise(0)
    out = both.withColumn("_epoch", F.explode(F.when(times > 0, F.sequence(F.lit(0), times - 1)).otherwise(F.array().cast("array<int>"))))
    return out.select(*rows.columns, "_epoch")


def _planned(docs: DataFrame, **options) -> tuple[DataFrame, DataFrame, int]:
    """Checkpointed narrow rows of the documents with words, with _tokens; and the plan."""
    narrow = cut(with_leaf(docs, _n_words().alias("_tokens")).where("_tokens > 0"))
    return narrow, _broadcast_if_few(cut(plan(narrow, **options))), options.get("seed", SEED)


def chosen(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, epoch, domain, lang, source, n_tokens) of what mixed() takes, without a second look at the texts."""
    narrow, made, seed = _planned(docs, **options)
    own = lambda level: F.when(F.col(f"_{level}") != NULL, F.col(f"_{level}")).alias(level)
    return selected(narrow, made, seed).select("doc_id", F.col("_epoch").alias("epoch"), F.col("_domain").alias("domain"), own("lang"), own("source"), F.col("_tokens").alias("n_tokens"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs (doc_id, text, lang, source, others kept) mixed to the weights, with domain and epoch.

    Options: weights, budget, share, most_epochs, seed; see plan. Columns of docs named domain or epoch are replaced. A
    document of no words is never taken. Rows of one id and text go in or stay out together; null ids are like any other.
    The result never exceeds a leaf's budget, and falls short of it by less than the tokens of the next id and text in the
    order. An empty table gives an empty result. The children of one node are ordered in one task, as narrow rows.
    """
    _, made, seed = _planned(docs, **options)
    kept = [c for c in docs.columns if c not in ("domain", "epoch")]
    worded = docs.where(F.length(F.translate("text", " \t\n\u000b\f\r", "")) > 0)
    rows = selected(with_leaf(worded, F.struct(*kept).alias("_row")), made, seed)
    return rows.select("_row.*", F.col("_domain").alias("domain"), F.col("_epoch").alias("epoch"))
