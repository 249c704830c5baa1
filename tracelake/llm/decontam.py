"""Benchmark decontamination: MinHash containment search, partitioned by size, then exact shingle containment.

An item with n different shingles is contained in a document if at least THRESHOLD * n of them occur there. Items are
partitioned by size (n up to a power of two); in each partition an item's signature is its k least shingles in one order of
all shingles, by how many items have them and then by hash, where k is one more than a contained item of that size may
lack. So each document that contains an item holds a shingle of its signature, however long the document is, and nothing is
lost. Documents are read once: bit maps sized by the number of items' shingles pick out the shingles that items have, and
only documents with one of a signature go on to equi-joins and the exact count, in rows of one shingle each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracelake.functions.ship import map_arrow
from tracelake.llm.common import Words, cut, pieces

SHINGLE, THRESHOLD = 5, 0.8
#: A map has about BITS_EACH bits for each shingle, at least and at most so many (log2); 2**28 take 32 MB. With more shingles
#: than that serves, more of the documents' shingles pass and are told apart by the joins.
BITS_EACH, LEAST_LOG_BITS, MOST_LOG_BITS = 16, 20, 28
#: From which bits of a shingle's hash its two cells are taken.
PROBES = (36, 8)
#: Items' shingles are broadcast up to so many rows of four numbers, and joined by shuffles beyond.
BROADCAST_ROWS = 1_000_000


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of shingles of SHINGLE lower-cased words and their rows; a row of fewer words has one, of all its words."""
    words = Words(column, lower=True)
    hashes, at = words.grams(SHINGLE)
    row = words.row[at]
    counts = np.diff(words.first)
    for n in range(1, SHINGLE):
        short = np.flatnonzero(counts == n)
        if len(short):
            own, first = words.grams(n)
            where = np.searchsorted(first, words.first[short])
            hashes, row = np.concatenate((hashes, own[where] ^ np.uint64(n))), np.concatenate((row, short))
    return hashes, row


def _item_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        hashes, row = shingles(piece.column("text"))
        at = pa.array(row)
        yield pa.RecordBatch.from_arrays([piece.column("item_id").take(at), piece.column("item_hash").take(at), pa.array(hashes.view(np.int64))], ["item_id", "item_hash", "h"])


def items_of(benchmark: DataFrame) -> DataFrame:
    """(item_id, item_hash, h, n, known): each item's different shingles, their number, and whether the item is known by it."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.xxhash64("text").alias("item_hash"), "text")
    found = map_arrow(rows, _item_shingles, "item_id long, item_hash long, h long").distinct()
    shared = found.join(found.groupBy("h").agg(F.count("*").alias("items")), "h")
    item = Window.partitionBy("item_id", "item_hash")
    sized = shared.withColumn("n", F.count("*").over(item))
    room = F.pow(F.lit(2.0), F.ceil(F.log2("n")))
    known = F.row_number().over(item.orderBy("items", "h")) <= F.floor((1 - THRESHOLD) * room + 1e-9) + 1
    return sized.withColumn("known", known).select("item_id", "item_hash", "h", "n", "known")


def _bits(hashes: DataFrame) -> np.ndarray:
    """A bit map of the hashes as 64-bit words, of a size that their number calls for and MOST_LOG_BITS bounds."""
    n = hashes.count()
    log_bits = min(MOST_LOG_BITS, max(LEAST_LOG_BITS, (BITS_EACH * n).bit_length()))
    cells = F.explode(F.array(*[F.shiftrightunsigned("h", i).bitwiseAND(F.lit((1 << log_bits) - 1)) for i in PROBES])).alias("cell")
    bit = F.expr("shiftleft(1L, cast(cell & 63 as int))")
    words = hashes.select(cells).groupBy(F.shiftrightunsigned("cell", 6).alias("w")).agg(F.bit_or(bit).alias("b")).toArrow()
    out = np.zeros(1 << (log_bits - 6), np.int64)
    out[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return out


def _in(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    found = np.ones(len(hashes), bool)
    for i in PROBES:
        cell = (hashes >> np.uint64(i) & np.uint64((len(bits) << 6) - 1)).astype(np.int64)
        found &= (bits[cell >> 6] >> (cell & 63) & 1).astype(bool)
    return found


def _hits(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, all_of = shared.value
        for piece in pieces(batches):
            hashes, row = shingles(piece.column("text"))
            keep = _in(all_of, hashes)
            hashes, row = hashes[keep], row[keep]
            sure = np.unique(row[_in(known, hashes)])
            if not len(sure):
                continue
            own = np.isin(row, sure)
            pairs = np.unique(np.stack((row[own].astype(np.uint64), hashes[own]), axis=1), axis=0)
            at = pa.array(pairs[:, 0].astype(np.int64))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id").take(at), piece.column("text_hash").take(at), pa.array(np.ascontiguousarray(pairs[:, 1]).view(np.int64))], ["doc_id", "text_hash", "h"])

    return run


def _leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, item_hash, n_item, n_shared), each pair of texts once."""
    items = cut(items_of(benchmark))
    few = F.broadcast if items.count() <= BROADCAST_ROWS else lambda rows: rows
    maps = _bits(items.where("known").select("h").distinct()), _bits(items.select("h").distinct())
    shared = docs.sparkSession.sparkContext.broadcast(maps)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    hits = cut(map_arrow(rows, _hits(shared), "doc_id long, text_hash long, h long"))
    pairs = hits.join(few(items.where("known").select("h", "item_id", "item_hash")), "h").select("doc_id", "text_hash", "item_id", "item_hash").distinct()
    # Each candidate pair yields the item's shingles, of which those that the document has too are counted.
    own = items.select(F.col("item_id").alias("_item"), "item_hash", "h", "n")
    asked = pairs.join(few(own), (F.col("item_id").eqNullSafe(F.col("_item"))) & (pairs["item_hash"] == own["item_hash"])).select("doc_id", "text_hash", "item_id", pairs["item_hash"], "h", "n")
    there = hits.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("h").alias("_h"))
    found = asked.join(there, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")) & (F.col("h") == F.col("_h")), "left_semi")
    counts = found.groupBy("doc_id", "text_hash", "item_id", "item_hash").agg(F.first("n").alias("n_item"), F.count("*").alias("n_shared"))
    return counts.where(F.col("n_shared") >= THRESHOLD * F.col("n_item") - 1e-9)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment): every pair of a document that contains a benchmark item.

    Shingles are SHINGLE consecutive words (without white space, A-Z lower-cased), each counted once; a text of fewer words
    is one shingle of all its words, so a short item is found in documents that equal it. Texts that are null or without
    words contain nothing and are nowhere contained. Ids may be null or repeat: texts of one id are judged one by one, and a
    pair that is found more than once, as for repeated rows, is returned once, with its largest share.
    """
    share = F.struct((F.col("n_shared") / F.col("n_item")).alias("containment"), "n_item", "n_shared")
    best = _leaks(docs, benchmark).groupBy("doc_id", "item_id").agg(F.max(share).alias("x"))
    return best.select("doc_id", "item_id", "x.n_item", "x.n_shared", "x.containment")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that contain no benchmark item, with all columns."""
    bad = _leaks(docs, benchmark).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    return docs.join(bad, docs["doc_id"].cast("long").eqNullSafe(bad["_id"]) & (F.xxhash64(docs["text"]) == bad["_hash"]), "left_anti")
