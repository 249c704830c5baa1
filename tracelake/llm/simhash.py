"""SimHash near-duplicates, found with a covering code as anchors.

The anchors are pairs of words of the perfect binary Golay code of length 23, laid over 46 of a fingerprint's 64 bits; the
other 18 bits are covered by any anchor. Every 23-bit block lies within 3 bits of exactly one code word, so each
fingerprint has one home anchor. If two fingerprints differ in at most 2 bits, the home anchor of the first lies, block by
block, within 3 bits plus those 2 of the second: so each fingerprint is also sent to every anchor within covering radius
plus threshold, and homes meet guests at an equi-join on the anchor. Nothing is lost, and there are no caps.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.functions.ship import map_arrow
from tracelake.llm.common import cut
from tracelake.llm.components import connected_components

# The generator polynomial of the [23, 12] Golay code, its block length and its covering radius.
GOLAY, BLOCK, RADIUS = 0b101011100011, 23, 3
THRESHOLD, SHINGLE, SEED = 2, 3, 42
#: Shingles of one text that are hashed at once.
CHUNK = 1 << 16
#: Narrow rows are broadcast up to so many, and joined by shuffles beyond.
BROADCAST_ROWS = 500_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits; bit i is set if it is set in over half of the shingles' hashes. No words: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest, set_in = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    n = max(1, len(words) - shingle + 1)
    for at in range(0, n, CHUNK):  # bounds the temporary lists, however long the text is
        own = words[at : at + CHUNK + shingle - 1] if n > 1 else words
        whole = b" ".join(own)
        if n == 1:
            hashes = [digest(whole, SEED)]
        else:
            lengths = np.fromiter(map(len, own), np.int64, len(own))
            ends = np.cumsum(lengths + 1) - 1
            hashes = [digest(whole[i:j], SEED) for i, j in zip((ends - lengths)[: len(own) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())]
        set_in += np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        marks = np.fromiter((fingerprint(x.as_py()) for x in batch.column("text")), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(marks.view(np.int64))], ["doc_id", "text_hash", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp) of every row of docs; fp is the 64 bits as a signed long."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return map_arrow(rows, _fingerprints, "doc_id long, text_hash long, fp long")


@cache
def _cosets() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The syndrome of each single bit; then error words by syndrome and excess over RADIUS, with each list's start."""
    unit = np.zeros(BLOCK, np.int64)
    for i in range(BLOCK):
        rest = 1 << i
        for j in range(BLOCK - 1, 10, -1):
            rest ^= (GOLAY << (j - 11)) if rest >> j & 1 else 0
        unit[i] = rest
    errors, keys = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
    for weight in range(1, RADIUS + THRESHOLD + 1):
        chosen = np.array(list(combinations(range(BLOCK), weight)), np.int64)
        errors.append((1 << chosen).sum(axis=1))
        keys.append(np.bitwise_xor.reduce(unit[chosen], axis=1) + 2048 * max(0, weight - RADIUS))
    errors, keys = np.concatenate(errors), np.concatenate(keys)
    order = np.argsort(keys, kind="stable")
    return unit, errors[order], np.searchsorted(keys[order], np.arange(2048 * (THRESHOLD + 1) + 1))


def _syndromes(block: np.ndarray) -> np.ndarray:
    unit = _cosets()[0]
    out = np.zeros(len(block), np.int64)
    for i in range(BLOCK):
        out ^= unit[i] * (block >> i & 1)
    return out


def anchors(marks: np.ndarray, excess: int) -> tuple[np.ndarray, np.ndarray]:
    """For fingerprints: the row and the anchor of each anchor within RADIUS in each block, plus `excess` bits in all."""
    _, errors, starts = _cosets()
    blocks = [marks & ((1 << BLOCK) - 1), marks >> BLOCK & ((1 << BLOCK) - 1)]
    keys = [_syndromes(b) for b in blocks]
    rows, found = [], []
    for i in range(excess + 1):
        for j in range(excess + 1 - i):
            low, high = keys[0] + 2048 * i, keys[1] + 2048 * j
            n_low, n_high = starts[low + 1] - starts[low], starts[high + 1] - starts[high]
            counts = n_low * n_high
            row = np.repeat(np.arange(len(marks)), counts)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            a = blocks[0][row] ^ errors[starts[low[row]] + nth // n_high[row]]
            b = blocks[1][row] ^ errors[starts[high[row]] + nth % n_high[row]]
            rows.append(row)
            found.append(a | b << BLOCK)
    return np.concatenate(rows), np.concatenate(found)


def _at_anchors(excess: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                marks = batch.column("fp").slice(at, 2000).to_numpy(zero_copy_only=False)
                row, anchor = anchors(marks, excess)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(marks[row])], ["anchor", "fp"])

    return run


def links(marks: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of different fingerprints of `marks` (fp, distinct) that differ in THRESHOLD bits or fewer."""
    homes = map_arrow(marks, _at_anchors(0), "anchor long, fp long").select("anchor", F.col("fp").alias("a"))
    guests = map_arrow(marks, _at_anchors(THRESHOLD), "anchor long, fp long").select("anchor", F.col("fp").alias("b"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= THRESHOLD)
    return homes.join(guests, "anchor").where(near).select("a", "b")


def _with_components(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) of each row; root is the component's least fingerprint."""
    marked = cut(fingerprints(docs))
    by_mark = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    roots = connected_components(links(by_mark.select("fp")))
    rooted = by_mark.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return marked.join(rooted.join(least, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) for each row of docs (doc_id, text, ...); other columns are not read.

    component_id is the least doc_id reachable through links. Null and empty texts have fingerprint 0 and are linked like
    any other; rows with a null id take part but never name a component (which is null if all its ids are); repeated rows
    come out as often as they come in. Equal fingerprints are aggregated first, so copies of one text meet nowhere else.
    """
    return _with_components(docs).select("doc_id", "fp", "component_id")


def narrow(rows: DataFrame) -> DataFrame:
    """Narrow checkpointed rows: broadcast behind a check of their number, else joined by shuffle."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def keep_first(docs: DataFrame, rooted: DataFrame) -> DataFrame:
    """One row of docs for each root of `rooted` (doc_id, text_hash, root): the one with the least id, null ids last, then text hash.

    Repeated rows count as copies: of those of one id and text, which only differ in other columns, the one with the least
    hash stays. Columns, of any name, and their order stay.
    """
    counts = rooted.groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "n")).alias("first")
    kept = counts.groupBy("root").agg(first).select(F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash"), F.col("first.n").alias("_n"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"))
    rows = rows.join(narrow(cut(kept)), F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")))
    repeated = rows.where("_n > 1").groupBy("id", "hash").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return rows.where("_n = 1").select("row").unionByName(repeated.select("row")).select("row.*")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One row of docs for each component of near-duplicates; see keep_first for which."""
    return keep_first(docs, _with_components(docs))
