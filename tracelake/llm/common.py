"""What the operators share: tables, checkpoints, and byte-level helpers on Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.functions.shared import cut as cut
from tracelake.functions.shared import remove, shared_folder

#: White space as the operators' contracts name it: \x20 and \x09 to \x0D.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
#: An Arrow batch is worked on in pieces of about this many bytes of text, which bounds the temporary arrays.
PIECE_BYTES = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Written:
    """Tables written as Parquet in the shared folder and read again by the schema they were written with.

    A checkpoint runs the last stage twice and keeps rows as serialised objects; a written table runs once and is read by
    column. Several tables of one schema are one scan.
    """

    def __init__(self, spark: SparkSession, what: str) -> None:
        self.spark, self.base, self.tables = spark, f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}", 0

    def write(self, rows: DataFrame) -> str:
        path, self.tables = f"{self.base}/{self.tables}", self.tables + 1
        rows.write.parquet(path)
        return path

    def cut(self, rows: DataFrame) -> DataFrame:
        return self.read(rows, [self.write(rows)])

    def read(self, like: DataFrame, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(*paths)

    def remove(self) -> None:
        """Delete all that was written here."""
        if self.tables:
            remove(self.spark, self.base)


def held_out(doc_id: str = "doc_id"):
    """True for the fold that no model may learn from; a null id is never held out, and never learnt from either."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """At most `most` labelled documents outside the held-out fold, chosen by a hash of the id, with their whole text.

    The ids are chosen from `labels` alone, so their broadcast to the scan of `docs` is bounded by `most`. A label that is
    null, or an id with several labels, counts by its largest label. Of rows with one id, that with the least text hash is
    taken, so that `most` bounds the rows too. Columns: text, y, hash (of the text).
    """
    chosen = (
        labels.select(F.col("doc_id").alias("learn_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("learn_id").isNotNull() & F.col("y").isNotNull() & (F.crc32(F.col("learn_id").cast("string")) % 5 != 0))
        .orderBy(F.xxhash64("learn_id"), "learn_id", F.desc("y"))
        .limit(most)
        .groupBy("learn_id")
        .agg(F.max("y").alias("y"))
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("learn_id"))
    one = rows.groupBy("learn_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("one"))
    # Few rows, but they are worked on at length: a partition for each core.
    return one.select("one.text", "y", "one.hash").repartition(docs.sparkSession.sparkContext.defaultParallelism)


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that each piece holds about `most` bytes of `column`, or one longer row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        parts = np.cumsum(lengths) // most
        at = np.concatenate(([0], np.flatnonzero(np.diff(parts)) + 1, [len(parts)])) if len(parts) else [0]
        for i, j in zip(at[:-1], at[1:]):
            if j > i:
                yield batch.slice(int(i), int(j - i))


def joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of UTF-8 bytes, each followed by a newline, and where each starts (with the end last). Null is empty."""
    kind = pa.large_string()
    texts = pc.binary_join_element_wise(pc.fill_null(column.cast(kind), ""), pa.scalar("", kind), pa.scalar("\n", kind))
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if len(texts) else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Rolling:
    """Prefix sums of a polynomial hash, so that the hash of any span is one subtraction and one product (modulo 2**64).

    The values summed are random 64-bit words per byte, or word hashes; a span's hash does not depend on where it stands.
    """

    BASE = np.uint64(0x9E3779B97F4A7C13)
    INVERSE = np.uint64(pow(0x9E3779B97F4A7C13, -1, 1 << 64))
    _up = _down = np.ones(1, np.uint64)
    BYTES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)

    def __init__(self, values: np.ndarray) -> None:
        n = len(values) + 1
        if len(Rolling._up) < n:
            for name, step in (("_up", self.BASE), ("_down", self.INVERSE)):
                steps = np.full(2 * n, step, np.uint64)
                steps[0] = 1
                setattr(Rolling, name, np.cumprod(steps, dtype=np.uint64))
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(values * Rolling._up[: n - 1], out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * Rolling._down[starts])

    def grams(self, n: int) -> np.ndarray:
        """Of each run of n values."""
        count = max(0, len(self.sums) - n)
        return mixed((self.sums[n : n + count] - self.sums[:count]) * Rolling._down[:count])


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the high bits over the low ones; a bijection."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(32))


def lookup(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


def spans(data: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs without a separator; the last byte has to be one."""
    apart = separators[data]
    turns = np.flatnonzero(np.diff(apart, prepend=True))
    return turns[0::2], turns[1::2]


class Words:
    """The words of a piece: spans without white space, with the row that each is in and a 64-bit hash of its bytes."""

    def __init__(self, column: pa.Array, lower: bool = False) -> None:
        self.data, self.offsets = joined(column)
        if lower:
            upper = (self.data >= 65) & (self.data <= 90)
            self.data = self.data + (upper.astype(np.uint8) << 5)
        self.starts, self.ends = spans(self.data, lookup(SPACES))
        self.row = np.searchsorted(self.offsets, self.starts, side="right") - 1
        self.hash = Rolling(Rolling.BYTES[self.data]).spans(self.starts, self.ends)
        self.first = np.searchsorted(self.starts, self.offsets)  # each row's first word; the end last

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each run of n words of one row, and the index of its first word."""
        at = np.flatnonzero(self.row[: max(0, len(self.row) - n + 1)] == self.row[n - 1 :])
        return Rolling(self.hash).grams(n)[at], at
