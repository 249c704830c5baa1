"""Token ids in packed rows of one length: best-fit decreasing, with a segment tree over the bins' free room.

Documents are tokenised with a public byte-level BPE whose file is a parameter, ended by a separator, and cut losslessly
into parts of at most `length` tokens. Parts are dealt to shards by a hash and packed shard by shard, in groups of bounded
size, so no task holds more than a group.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.functions.ship import map_arrow

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The pattern that this public vocabulary's texts are split by, and its free id, used as separator and padding.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEPARATOR = 50256
LENGTH = 2048
#: Bytes of text for each shard, and tokens packed at once.
SHARD_BYTES, GROUP_TOKENS = 1 << 24, 1 << 22
#: Entries of the cache of words' ids in each Python worker.
CACHE = 400_000
#: Ids are stored as little-endian 16-bit numbers.
ID = np.dtype("<u2")

_encoders: dict[int, Encoder] = {}


class Encoder(dict):
    """Ids of a run of text, as bytes, by that run: " " and what follows up to the next space after a non-space.

    The pattern never joins a non-space to a space after it, so these runs can be encoded apart from each other.
    """

    def __init__(self, ranks: bytes) -> None:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        if max(table.values()) >= SEPARATOR:
            raise ValueError(f"ids of this tokenizer reach {SEPARATOR} or beyond")
        self.encode = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary

    def __missing__(self, run: str) -> bytes:
        ids = np.array(self.encode(run), ID).tobytes()
        if len(self) >= CACHE:
            self.clear()
        if len(run) < 64:
            self[run] = ids
        return ids

    def ids(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        runs, spaces = [first], " "
        # A space belongs to the run before it if that ends in white space, or is empty.
        for word in rest:
            if runs[-1] == "" or runs[-1][-1].isspace():
                runs[-1] += " " + word
            else:
                runs.append(spaces + word)
        return b"".join(map(self.__getitem__, runs))


def _parts(shared, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.get(0) or _encoders.setdefault(0, Encoder(shared.value))
        end = np.array([SEPARATOR], ID).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids, parts, texts = [], [], []
                for i, text in zip(batch.column("doc_id").slice(at, 256).to_pylist(), batch.column("text").slice(at, 256)):
                    tokens = encoder.ids(text.as_py() or "") + end
                    step = length * ID.itemsize
                    for k in range(0, len(tokens), step):
                        ids.append(i)
                        parts.append(k // step)
                        texts.append(tokens[k : k + step])
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(parts, pa.int32()), pa.array(texts, pa.binary())], ["doc_id", "part", "ids"])

    return run


def tokenised(docs: DataFrame, tokenizer: str = TOKENIZER, length: int = LENGTH) -> DataFrame:
    """(doc_id, part, ids): each document's ids and a separator, cut into parts of at most `length` (part counts from 0)."""
    shared = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_bytes())
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _parts(shared, length), "doc_id long, part int, ids binary")


def best_fit(sizes: list[int], room: int) -> list[list[int]]:
    """Indices of sizes, in falling order, for each bin; each goes to the bin with the least room that still holds it.

    A segment tree over 0..room counts the open bins by their free room; the first leaf from the size on is the best fit.
    """
    leaves = 1 << room.bit_length()
    tree = [0] * (2 * leaves)
    free: dict[int, list[int]] = {}
    bins: list[list[int]] = []

    def change(at: int, by: int) -> None:
        at += leaves
        while at:
            tree[at] += by
            at >>= 1

    def first_from(at: int) -> int:
        at += leaves
        if not tree[at]:
            while at > 1 and (at & 1 or not tree[at + 1]):
                at >>= 1
            if at <= 1:
                return -1
            at += 1
            while at < leaves:
                at = 2 * at if tree[2 * at] else 2 * at + 1
        return at - leaves

    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fit = first_from(sizes[i])
        if fit < 0:
            bins.append([i])
            left, own = room - sizes[i], len(bins) - 1
        else:
            own = free[fit].pop()
            change(fit, -1)
            bins[own].append(i)
            left = fit - sizes[i]
        if left:
            free.setdefault(left, []).append(own)
            change(left, 1)
    return bins


def _packed(length: int):
    names = ["pack_id", "n_tokens", "ids", "cu_seqlens", "position_resets", "doc_ids", "parts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        held: list[tuple] = []
        tokens = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal number
            sizes = [len(x[2]) // ID.itemsize for x in held]
            out: list[tuple] = []
            for chosen in best_fit(sizes, length):
                own = [held[i] for i in chosen]
                cu = np.concatenate(([0], np.cumsum([sizes[i] for i in chosen]))).astype(np.int32)
                ids = b"".join(x[2] for x in own)
                padding = np.full(length - cu[-1], SEPARATOR, ID).tobytes()
                out.append((number, int(cu[-1]), ids + padding, cu, cu[:-1], [x[0] for x in own], [x[1] for x in own]))
                number += 1
            for at in range(0, len(out), 512):
                columns = zip(*out[at : at + 512])
                kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "part", "ids"))):
                held.append(row)
                tokens += len(row[2]) // ID.itemsize
                if tokens >= GROUP_TOKENS:
                    yield from flush()
                    held, tokens = [], 0
        if held:
            yield from flush()

    return run


def packed(docs: DataFrame, tokenizer: str = TOKENIZER, length: int = LENGTH) -> DataFrame:
    """Packed rows: pack_id, n_tokens, ids (binary: `length` little-endian 16-bit ids, padded), cu_seqlens, position_resets, doc_ids, parts.

    cu_seqlens: 0 and the end of each segment; position_resets: where position ids start again at 0; doc_ids and parts name
    each segment. All tokens of all documents are in exactly one row. A null or empty text is its separator alone; repeated
    rows are packed as often as they come; null ids stay null. The rows depend on docs only, not on its partitions.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = 1 + size // SHARD_BYTES
    parts = tokenised(docs, tokenizer, length).repartition(shards, F.xxhash64("doc_id", "part", "ids"))
    schema = "pack_id long, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, doc_ids array<long>, parts array<int>"
    return map_arrow(parts.sortWithinPartitions("doc_id", "part", "ids"), _packed(length), schema)


def write(rows: DataFrame, path: str) -> None:
    """Write packed rows as Parquet; a reader stacks `ids` into the id matrix with matrix()."""
    rows.write.parquet(path)


def matrix(ids: list[bytes], length: int = LENGTH) -> np.ndarray:
    """The id matrix of some rows."""
    return np.frombuffer(b"".join(ids), ID).reshape(-1, length)
