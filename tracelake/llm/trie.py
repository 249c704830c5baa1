"""The prefix trie of conversations, by prefix doubling.

Every turn gets a dense name (equal turns have one name), then every aligned block of two, four, eight ... turns, from the
names of its halves, in as many rounds as the longest conversation has binary digits. A prefix of d turns is the blocks of
d's binary decomposition, longest first: in as many rounds again each prefix is named by a shorter prefix and the block that
follows it, each once. Equal prefixes then have one name, which is a node, and all of a node is grouped from its members:
sums over its subtree are sums over its members of what each of them has from that depth on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions.ship import map_arrow
from tracelake.llm.common import Written

#: A conversation begins with up to HEADS - 1 turns of the one whose id is the next lower multiple of GROUP.
GROUP, HEADS = 20, 4
# Joins are merge joins by hint: what they join grows with the input, and small inputs in many rounds fill the driver with broadcasts.
#: What separates words, as a pattern of their characters.
WORD = r"[^\x20\x09-\x0D]+"


def named(store: Written, rows: DataFrame, on: list[str], first: int = 0) -> tuple[DataFrame, int]:
    """rows with `name` for `on`: equal in equal rows, dense from `first`. Also the number of names.

    A key of many rows (a first turn that all share) is a skewed partition of a merge join, which adaptive execution splits.
    The first names of partitions are an array looked up by the partition, not single constants: so all rounds run the same
    generated code, which the driver and the executors compile once.
    """
    distinct = store.cut(rows.select(*on).distinct().withColumn("_at", F.monotonically_increasing_id()))  # numbers by place are written before they are used
    part = F.shiftright("_at", 33).cast("int")
    sizes = distinct.groupBy(part.alias("part")).agg(F.count("*").alias("names")).collect()  # one row for each partition
    starts, names = [first] * (max((r.part for r in sizes), default=0) + 1), first
    for size in sizes:
        starts[size.part] = names
        names += size.names
    name = F.get(F.lit(starts), part) + F.col("_at").bitwiseAND((1 << 33) - 1)
    return rows.join(distinct.select(*on, name.alias("name")).hint("merge"), on), names - first


def _ranged(store: Written, rows: DataFrame, order: list[str]) -> DataFrame:
    """rows with _block, by ranges of conv_id and `order`. Written, as the limits are drawn from a sample."""
    return store.cut(rows.repartitionByRange("conv_id", *order).withColumn("_block", F.spark_partition_id()))


def rebuilt(store: Written, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns (conv_id, i from 0, digest of role and text, words of the text) of all rebuilt conversations; and (conv_id, turns) of each, also of those without a turn.

    Turns are ordered by turn (null first), role and digest, a null role or text being empty. A conversation c begins with the
    first h turns of the one whose id is c - c % GROUP, h being the CRC32 of c's digits modulo HEADS, then come its own
    without the first h. Ranges of turns are numbered, so a conversation of any length is spread over tasks.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = ["turn", "role", "digest"]
    ranged = _ranged(store, rows, order)
    before = Window.partitionBy("conv_id").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = ranged.groupBy("conv_id", "_block").agg(F.count("*").alias("n")).withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    c = F.col("conv_id")
    sizes = blocks.groupBy("conv_id").agg(F.sum("n").alias("n")).withColumn("giver", c - c % GROUP)
    sizes = sizes.withColumn("h", F.when(c == F.col("giver"), 0).otherwise(F.crc32(c.cast("string").cast("binary")) % HEADS))
    givers = sizes.select(c.alias("giver"), F.col("n").alias("given"))
    # Of h turns that are to be taken, m are there.
    sizes = store.cut(sizes.join(givers.hint("merge"), "giver", "left").withColumn("m", F.least("h", F.coalesce("given", F.lit(0)))))
    placed = ranged.join(blocks.select("conv_id", "_block", "start").join(sizes.select("conv_id", "h", "m").hint("merge"), "conv_id").hint("merge"), ["conv_id", "_block"])
    inside = Window.partitionBy("conv_id", "_block").orderBy(*order)
    placed = placed.withColumn("at", F.col("start") + F.row_number().over(inside) - 1)
    own = placed.where("at >= h").select("conv_id", (F.col("at") - F.col("h") + F.col("m")).alias("i"), "digest", "words")
    heads = placed.where((F.col("at") < HEADS - 1) & (c % GROUP == 0)).select(c.alias("giver"), F.col("at").alias("i"), "digest", "words")
    taken = sizes.where("m > 0").select("conv_id", "giver", "m").join(heads.hint("merge"), "giver").where("i < m").select("conv_id", "i", "digest", "words")
    turns = F.col("m") + F.greatest(F.lit(0), F.col("n") - F.col("h"))
    return store.cut(own.unionByName(taken)), sizes.select("conv_id", turns.alias("turns"))


def _levels(store: Written, turns: DataFrame, longest: int) -> list[DataFrame]:
    """For each k the aligned blocks of 2**k turns: conv_id, at (the first turn), length, words of the last turn, name."""
    level, _ = named(store, turns.select("conv_id", F.col("i").alias("at"), F.lit(1).cast("long").alias("length"), "words", "digest"), ["digest"])
    levels = [store.cut(level.drop("digest"))]
    while 1 << len(levels) <= longest:
        begin = F.col("at") - F.col("at") % (2 * F.col("length"))
        of = lambda c, side: F.max(F.when((F.col("at") == F.col("begin")) == side, F.col(c)))
        halves = levels[-1].withColumns({"begin": begin, "twice": 2 * F.col("length")}).groupBy("conv_id", "begin", "twice")
        whole = halves.agg(of("words", False).alias("words"), of("name", True).alias("left"), of("name", False).alias("right")).where("left is not null and right is not null")
        level, _ = named(store, whole.select("conv_id", F.col("begin").alias("at"), F.col("twice").alias("length"), "words", "left", "right"), ["left", "right"])
        levels.append(store.cut(level.drop("left", "right")))
    return levels


def prefixes(store: Written, turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """(conv_id, d, node, words of turn d) of every prefix of every conversation; node 0 is the prefix of no turn."""
    zero = F.lit(0).cast("long")
    like = sizes.select("conv_id", zero.alias("d"), zero.alias("node"), zero.alias("words"))
    found, names = [store.write(like)], 1
    longest = sizes.agg(F.max("turns")).first()[0] or 0
    for level in reversed(_levels(store, turns, longest)):
        # The blocks of this length that follow a prefix of a multiple of twice as many turns, which has its name by now.
        block = level.where("at % (2 * length) = 0").withColumnRenamed("name", "right").hint("merge")
        before = store.read(like, found).select("conv_id", F.col("d").alias("at"), F.col("node").alias("left"))
        grown = store.cut(before.join(block, ["conv_id", "at"]).select("conv_id", "at", "length", "words", "left", "right"))
        grown, n = named(store, grown, ["left", "right"], names)
        found.append(store.write(grown.select("conv_id", (F.col("at") + F.col("length")).alias("d"), F.col("name").alias("node"), "words")))
        names += n
    return store.read(like, found)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by node and block: the SHA-256 of each node's texts, joined by commas."""
    node = sha = None
    done: list[tuple[int, str]] = []
    for batch in batches:
        for now, text in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if now == node:
                sha.update(b"," + text.encode())
                continue
            if sha:
                done.append((node, sha.hexdigest()))
            node, sha = now, hashlib.sha256(text.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in done], pa.int64()), pa.array([s for _, s in done], pa.string())], ["node", "ends_sha256"])
            done = []
    if sha:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.int64()), pa.array([sha.hexdigest()])], ["node", "ends_sha256"])


def _ends(store: Written, prefix: DataFrame, sizes: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the conversations that end at each node. Texts of whole ranges of ids are made apart and hashed one after the other."""
    last = prefix.select("conv_id", "d", "node").join(sizes.select("conv_id", F.col("turns").alias("d")).hint("merge"), ["conv_id", "d"])
    ranged = store.cut(last.select("node", "conv_id").repartitionByRange("node", "conv_id").withColumn("_block", F.spark_partition_id()))
    texts = ranged.groupBy("node", "_block").agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))
    return map_arrow(texts.repartition("node").sortWithinPartitions("node", "_block").select("node", "ids"), _hashes, "node long, ends_sha256 string")


def _from_here_on(store: Written, rows: DataFrame, values: list[str]) -> DataFrame:
    """`values` summed over the conversation's rows from this d on."""
    ranged = _ranged(store, rows, ["d"])
    after = Window.partitionBy("conv_id").orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = ranged.groupBy("conv_id", "_block").agg(*[F.sum(v).alias(f"_{v}") for v in values])
    blocks = blocks.select("conv_id", "_block", *[F.coalesce(F.sum(f"_{v}").over(after), F.lit(0)).alias(f"_{v}") for v in values])
    inside = Window.partitionBy("conv_id", "_block").orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, 0)
    both = ranged.join(blocks.hint("merge"), ["conv_id", "_block"])
    return both.withColumns({v: F.sum(v).over(inside) + F.col(f"_{v}") for v in values}).drop("_block", *[f"_{v}" for v in values])


def nodes(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node of the trie.

    conversations: conv_id, turn, role, text; other columns count for nothing. A node is a distinct sequence of first turns
    (role and text, told apart by SHA-256), the root that of none. Its conv_id is its smallest member. saved_tokens: of all
    nodes of the subtree, the words of the last text times the members but one. Turns with one turn number are ordered by
    role and digest; repeated rows are turns of their own. A row without a conv_id belongs to no conversation and counts for
    nothing. No rows give no nodes, not even a root.

    No step takes a conversation or a node to one task but the hash of the ids that end at a node, which is fed with texts of
    whole ranges of them.
    """
    store = Written(conversations.sparkSession, "trie")
    turns, sizes = rebuilt(store, conversations)
    prefix = prefixes(store, turns, sizes)
    node = prefix.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.max("d").alias("depth"), F.count("*").alias("n_convs"))
    node = store.cut(node)
    # A node is the prefix of its depth of its smallest member, so its parent is that member's prefix of one turn less.
    up = prefix.select("conv_id", (F.col("d") + 1).alias("depth"), F.col("node").alias("parent"))
    child = store.cut(node.select("node", "conv_id", "depth").join(up.hint("merge"), ["conv_id", "depth"]).select("node", "parent"))
    children = child.groupBy("parent").agg(F.count("*").alias("n_children")).withColumnRenamed("parent", "node")
    node = store.cut(node.join(children.hint("merge"), "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    first = node.select("conv_id", F.col("depth").alias("d"), (F.col("n_children") == 0).cast("long").alias("leaf"))
    own = prefix.join(first.hint("merge"), ["conv_id", "d"], "left")
    # Every member but the smallest saves its turn; each leaf counts at its smallest member.
    own = own.select("conv_id", "d", "node", F.when(F.col("leaf").isNull(), F.col("words")).otherwise(0).cast("long").alias("saved"), F.coalesce("leaf", F.lit(0)).cast("long").alias("leaf"))
    sums = _from_here_on(store, own, ["saved", "leaf"]).groupBy("node").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))
    parents = node.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    parents = child.join(parents.hint("merge"), "parent").drop("parent")
    out = node.join(sums.hint("merge"), "node").join(parents.hint("merge"), "node", "left").join(_ends(store, prefix, sizes).hint("merge"), "node", "left")
    ends = F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", ends)
