"""Sharding by jump consistent hashing. DataFrame functions only.

A row's shard follows from its key and the number of shards alone, without a table of ring positions. A key jumps from shard
to shard by a pseudo-random sequence of its own, and stays in the last one below the number of shards; so with one shard
more, a key either stays or moves into the new one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.llm.common import cut

SHARDS = 24
#: Jumps that every row makes; a row that has not come to its end by then makes the rest in a loop of its own.
JUMPS = 40
#: At most so many slots are filled from one row of the counted ones at a time.
FILLED = 4096
# Fixed values of the published hash: its multiplier, and the bits of a state that a jump looks at.
MULTIPLIER, STATE_BITS = 2862933555777941757, 31
#: Bytes that a row takes beside its text.
OVERHEAD = 8


def key_hash(key: Column) -> Column:
    """64 bits of the MD5 of a key as text, signed; the same on every engine. A null key is like an empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 16), 16, -10).cast("long")


def _next_state(state: Column) -> Column:
    """state * MULTIPLIER + 1 modulo 2**64, from products below 2**63, as whole products overflow."""
    low_m, high_m = MULTIPLIER & 0xFFFFFFFF, MULTIPLIER >> 32
    bits = lambda c, n: c.bitwiseAND(F.lit((1 << n) - 1))
    s0, s1 = bits(state, 16), bits(F.shiftrightunsigned(state, 16), 16)
    low, high = bits(state, 32), F.shiftrightunsigned(state, 32)
    a, b = s0 * F.lit(low_m) + F.lit(1), s1 * F.lit(low_m)
    bottom = a + F.shiftleft(bits(b, 16), 16)
    # Of high * low_m only the lowest 32 bits count; its two halves of `high` keep within 63 bits.
    cross = bits(high, 16) * F.lit(low_m) + F.shiftleft(bits(F.shiftrightunsigned(high, 16) * F.lit(low_m), 16), 16)
    top = F.shiftrightunsigned(bottom, 32) + F.shiftrightunsigned(b, 16) + bits(low * F.lit(high_m), 32) + bits(cross, 32)
    return F.shiftleft(bits(top, 32), 32).bitwiseOR(bits(bottom, 32))


def _jump(at: Column, shards: int) -> Column:
    """One jump of (before, at, next, state): `at` is the shard of `shards`, `before` that of one less, while next is below."""
    state = _next_state(at["state"])
    drawn = (F.shiftrightunsigned(state, 64 - STATE_BITS) + 1).cast("double")
    to = F.floor((at["next"] + 1).cast("double") * (F.lit(float(1 << STATE_BITS)) / drawn))
    # Where the jump starts is the shard reached; that of one shard less is the last below its number.
    here = F.struct(F.when(at["next"] < shards - 1, at["next"]).otherwise(at["before"]).alias("before"), at["next"].alias("at"), to.alias("next"), state.alias("state"))
    return F.when(at["next"] < shards, here).otherwise(at)


def shard_pair(key: Column, shards: int = SHARDS) -> Column:
    """A struct of `at`, the shard of a hashed key, and `grown`, its shard with one more. For at least one shard."""
    more = shards + 1
    none, zero = F.lit(-1).cast("long"), F.lit(0).cast("long")
    start = F.struct(none.alias("before"), none.alias("at"), zero.alias("next"), key.alias("state"))
    loop = lambda n, begin: F.aggregate(F.sequence(F.lit(1), F.lit(n)), begin, lambda a, _: _jump(a, more))
    end = loop(min(more, JUMPS), start)
    if more > JUMPS:
        # Every jump goes up by one at least, so these are all that there can be.
        end = F.get(F.transform(F.array(end), lambda a: F.when(a["next"] < more, loop(more, a)).otherwise(a)), F.lit(0))
    return F.get(F.transform(F.array(end), lambda a: F.struct(a["before"].cast("int").alias("at"), a["at"].cast("int").alias("grown"))), F.lit(0))


def placed(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id") -> DataFrame:
    """docs with shard and grown_shard, from `key` alone and without a shuffle. Columns of these names are replaced."""
    if shards < 1:
        raise ValueError("there has to be a shard")
    rows = docs.drop("shard", "grown_shard", "_pair").withColumn("_pair", shard_pair(key_hash(F.col(key)), shards))
    return rows.withColumns({"shard": F.col("_pair.at"), "grown_shard": F.col("_pair.grown")}).drop("_pair")


def numbered(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of docs (doc_id, text; others count for nothing).

    size: UTF-8 bytes of the text (none if null) plus OVERHEAD. slot: the row's place in its shard, without gaps from 0, in
    the order of the key's hash, the id, the checksum and the size. It does not depend on how the table is partitioned. Rows
    that agree in all of these are alike here and counted as one, so a third of all rows may be one row; they take
    neighbouring slots. A null id is a key like any other. An empty table gives no rows.

    Only counted narrow rows are shuffled, once by themselves and once to ranges of the order; ranges are summed up for each
    shard, and a row's slot is that of its range and its place within, so no task takes a shard.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text).cast("long") + OVERHEAD).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("n"))
    hashed = placed(counted.withColumn("hash", key_hash(F.col("doc_id"))), shards)
    order = ["hash", "doc_id", "text_crc32", "size"]
    # Checkpointed, as a range's limits are drawn from a sample.
    ranged = cut(hashed.repartitionByRange("shard", *order).withColumn("block", F.spark_partition_id()))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = ranged.groupBy("shard", "block").agg(F.sum("n").alias("n")).select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    first = ranged.withColumn("first", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(blocks, ["shard", "block"])
    first = first.withColumn("first", F.col("first") + F.col("start"))
    one = first.where("n = 1").withColumn("slot", F.col("first"))
    # Repeated rows: first a row for each FILLED slots, dealt out anew, then one for each slot.
    many = first.where("n > 1").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / FILLED))))
    many = many.repartition(*order, "part").withColumn("slot", F.explode(F.sequence(F.col("part") * FILLED, F.least(F.col("n"), (F.col("part") + 1) * FILLED) - 1)))
    out = one.unionByName(many.drop("part").withColumn("slot", F.col("first") + F.col("slot")))
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def write(docs: DataFrame, path: str, shards: int = SHARDS, key: str = "doc_id", files: int = 8) -> None:
    """Write the rows of docs as Parquet to a folder shard=k for each shard, of `files` files each, with grown_shard.

    A shard's rows are dealt to its files by the hash of their text, so neither a shard nor a key is one task.
    """
    rows = placed(docs, shards, key)
    dealt = rows.withColumn("_file", F.pmod(F.xxhash64(key, "text"), F.lit(files)))
    dealt.repartition(shards * files, "shard", "_file").drop("_file").write.partitionBy("shard").parquet(path)
