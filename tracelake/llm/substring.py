"""Removal of passages that repeat, after a count-min prefilter.

A window is LENGTH consecutive words. Its key is the leftmost least hash among the GRAM-word grams inside it, so windows
with one word sequence have one key, and a key stands for up to LENGTH - GRAM + 1 neighbouring windows. Counting the
places where keys are chosen therefore overestimates how often any window with that key occurs.

1. Every partition counts its keys in a count-min sketch; the sketches are merged by an exchange on blocks of cells. It is
   asked of counters only whether they are above one, and whether they are high (about HOT or more).
2. A second pass keeps only the windows whose key is estimated repeated, and groups those exactly by key and window hash
   (64 bits each). Windows that recur within one batch are settled there, so a passage that a third of all documents share
   reaches its group at most once per batch. Windows of a key with a high count are dealt out one by one, by their own
   hash, as those that lead into such a passage differ from each other, but share its keys.
3. The repeated windows' words are removed from each document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.functions.ship import map_arrow
from tracelake.llm.common import Rolling, Words, mixed, pieces

LENGTH, GRAM = 35, 8
#: Rows of the sketch, and cells in a block.
DEPTH, BLOCK_CELLS = 3, 1 << 19
#: A row has about CELLS_EACH cells for each key place that texts of so many bytes have, at least and at most so many (log2).
#: 3 rows of 2**27 cells take 96 MB where broadcast, which bounds it: more data make more false alarms for the second pass,
#: and lose nothing.
CELLS_EACH, BYTES_EACH, LEAST_LOG_CELLS, MOST_LOG_CELLS = 4, 144, 20, 27
#: A key counted so often in one partition, or in so many partitions, counts as hot.
HOT = 64
_SALTS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _cells(keys: np.ndarray, row: int, log_cells: int) -> np.ndarray:
    return ((keys * _SALTS[row]) >> np.uint64(64 - log_cells)).astype(np.int64)


def log_cells_for(size: int) -> int:
    """Log2 of the cells of a row for texts of `size` bytes in all."""
    return min(MOST_LOG_CELLS, max(LEAST_LOG_CELLS, round(np.log2(1 + CELLS_EACH * size / BYTES_EACH))))


def _windows(words: Words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each window: index of its first word, index of its key's gram, and the hashes of all grams (by first word)."""
    window_hash, at = words.grams(length)
    n = len(words.hash)
    if not len(at):
        return at, at, np.zeros(0, np.uint64)
    grams = np.zeros(n, np.uint64)
    inner = Rolling(words.hash).grams(min(GRAM, length))
    grams[: len(inner)] = inner
    least = np.arange(n)
    span, done = length - min(GRAM, length) + 1, 1
    while done < span:
        step = min(done, span - done)
        left, right = least[: n - step], least[step:]
        least[: n - step] = np.where(grams[right] < grams[left], right, left)
        done += step
    return at, least[at], grams


def _sketched(length: int, log_cells: int):
    """One sketch for each partition: for each block of cells, which are at least 1, at least 2 and at least HOT."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [np.zeros(0, np.uint64)]
        for piece in pieces(batches):
            words = Words(piece.column("text"))
            _, gram_at, grams = _windows(words, length)
            if len(gram_at):
                found.append(grams[gram_at[np.diff(gram_at, prepend=-1) != 0]])
        keys, repeats = np.unique(np.concatenate(found), return_counts=True)
        for row in range(DEPTH if len(keys) else 0):
            cells, inverse = np.unique(_cells(keys, row, log_cells), return_inverse=True)
            counts = np.bincount(inverse, weights=repeats)
            edges = np.searchsorted(cells, np.arange(0, (1 << log_cells) + 1, BLOCK_CELLS))
            for block, (i, j) in enumerate(zip(edges[:-1], edges[1:])):
                if i < j:
                    levels = []
                    for least in (1, 2, HOT):
                        bits = np.zeros(BLOCK_CELLS, bool)
                        bits[cells[i:j][counts[i:j] >= least] - block * BLOCK_CELLS] = True
                        levels.append(_packed(np.packbits(bits, bitorder="little")))
                    yield pa.RecordBatch.from_pydict({"block": pa.array([row << 16 | block], pa.int32()), "once": [levels[0]], "twice": [levels[1]], "hot": [levels[2]]})

    return run


def _packed(bits: np.ndarray) -> bytes:
    return pa.compress(bits.tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, BLOCK_CELLS >> 3, codec="zstd", asbytes=True), np.uint8)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up sketches block by block; a task holds the blocks dealt to it, however many sketches come.

    In how many sketches a cell is set is counted bitwise, in one bit map for each binary digit.
    """
    digits = HOT.bit_length() - 1
    held: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for block, *levels in zip(batch.column("block").to_pylist(), *(batch.column(c) for c in ("once", "twice", "hot"))):
            once, twice, hot = (_unpacked(x.as_py()) for x in levels)
            if block not in held:
                held[block] = [np.zeros_like(once) for _ in range(digits + 3)]
            mine = held[block]
            mine[1] = mine[1] | twice | (mine[0] & once)
            mine[0] = mine[0] | once
            carry = once
            for i in range(3, digits + 3):
                mine[i], carry = mine[i] ^ carry, mine[i] & carry
            mine[2] = mine[2] | hot | carry
    for block, (_, twice, hot, *_) in held.items():
        yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "twice": [twice.tobytes()], "hot": [hot.tobytes()]})


def sketch(docs: DataFrame, length: int = LENGTH) -> np.ndarray:
    """For each cell of the merged sketch of all texts, a bit for a count of two or more, and one for HOT.

    Its size follows from the texts' and is bounded; as many tasks merge it as it has blocks or the session shuffles into.
    """
    log_cells = log_cells_for(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    parts = map_arrow(docs.select("text"), _sketched(length, log_cells), "block int, once binary, twice binary, hot binary")
    blocks = (1 << log_cells) // BLOCK_CELLS
    tasks = min(DEPTH * blocks, max(48, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    merged = map_arrow(parts.repartition(tasks, "block"), _merged, "block int, twice binary, hot binary")
    bits = np.zeros((2, DEPTH, blocks, BLOCK_CELLS >> 3), np.uint8)
    for x in merged.toLocalIterator():
        bits[0, x.block >> 16, x.block & 0xFFFF] = np.frombuffer(x.twice, np.uint8)
        bits[1, x.block >> 16, x.block & 0xFFFF] = np.frombuffer(x.hot, np.uint8)
    return bits.reshape(2, DEPTH, -1)


def _counted(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether all of a key's cells have their bit."""
    found, log_cells = np.ones(len(keys), bool), bits.shape[-1].bit_length() + 2
    for row in range(DEPTH):
        cells = _cells(keys, row, log_cells)
        found &= (bits[row, cells >> 3] >> (cells & 7).astype(np.uint8) & 1).astype(bool)
    return found


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))


SUSPECTS = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int32()), ("n", pa.int32()), ("hashes", pa.list_(pa.int64())), ("known", pa.list_(pa.bool_()))])


def _suspects(length: int, shared):
    """Windows that the sketch holds for repeated: one row per run of windows with one key, with the windows' hashes.

    `known` tells which windows already recur within this batch. A run without a window that is unknown, or the first of
    those that recur here, need not meet its group: it is sent as finished runs of n windows, with no hashes and any key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for piece in pieces(batches):
            words = Words(piece.column("text"))
            at, gram_at, grams = _windows(words, length)
            if not len(at):
                continue
            fresh = np.diff(gram_at, prepend=-1) != 0
            keys = grams[gram_at[fresh]]
            likely = _counted(bits[0], keys)
            runs, lengths, keys = np.flatnonzero(fresh)[likely], np.diff(np.flatnonzero(fresh), append=len(at))[likely], keys[likely]
            if not len(runs):
                continue
            window, of = _ragged(runs, lengths), np.repeat(np.arange(len(runs)), lengths)
            hashes, hot = words.grams(length)[0][window], _counted(bits[1], keys)
            starts = np.flatnonzero((np.diff(of, prepend=-1) != 0) | hot[of])
            keys = np.where(hot[of[starts]], mixed(keys[of[starts]] ^ hashes[starts]), keys[of[starts]])
            runs, lengths = window[starts], np.diff(starts, append=len(window))
            of = np.repeat(np.arange(len(runs)), lengths)
            _, first, inverse, counts = np.unique(hashes ^ (keys[of] * _SALTS[0]), return_index=True, return_inverse=True, return_counts=True)
            known = counts[inverse] > 1
            told = np.zeros(len(hashes), bool)
            told[first] = True
            sent = np.bincount(of, weights=told | ~known, minlength=len(runs)) > 0
            row = words.row[at[runs]]
            whole = pa.RecordBatch.from_arrays(
                [
                    pa.array(keys.view(np.int64)),
                    piece.column("doc_id").take(pa.array(row)),
                    piece.column("text_hash").take(pa.array(row)),
                    pa.array((at[runs] - words.first[row]).astype(np.int32)),
                    pa.array(np.zeros(len(runs), np.int32)),
                    _lists(lengths, pa.array(hashes.view(np.int64))),
                    _lists(lengths, pa.array(known)),
                ],
                schema=SUSPECTS,
            )
            if sent.any():
                yield whole.filter(pa.array(sent))
            if not sent.all():
                rest = whole.filter(pa.array(~sent))
                marks = _marks(rest, np.ones(int(lengths[~sent].sum()), bool), lengths[~sent])
                empty = _lists(np.zeros(marks.num_rows, np.int64), pa.array([], pa.int64())), _lists(np.zeros(marks.num_rows, np.int64), pa.array([], pa.bool_()))
                spread = mixed(marks.column("text_hash").to_numpy().view(np.uint64) + pc.fill_null(marks.column("doc_id"), 0).to_numpy().view(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(spread), *marks.columns, *empty], schema=SUSPECTS)

    return run


def _lists(lengths: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)), values)


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key: the windows whose hash occurs twice under the key. `known` ones count twice already."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        done = batch.filter(pc.greater(batch.column("n"), 0))
        if done.num_rows:
            yield done.select(["doc_id", "text_hash", "start", "n"])
        batch = batch.filter(pc.equal(batch.column("n"), 0))
        if not batch.num_rows:
            continue
        keys = batch.column("key").to_numpy()
        if held and held[-1].column("key")[-1].as_py() != keys[0]:
            yield from _repeated(held)
            held = []
        turn = np.flatnonzero(np.diff(keys))
        if len(turn):  # up to the last change of key, all is there
            yield from _repeated([*held, batch.slice(0, int(turn[-1]) + 1)])
            held = [batch.slice(int(turn[-1]) + 1)]
        else:
            held.append(batch)
    if held:
        yield from _repeated(held)


def _repeated(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = pa.Table.from_batches(batches).combine_chunks().to_batches()[0]
    hashes = rows.column("hashes")
    counts = np.diff(hashes.offsets.to_numpy())
    keys = np.repeat(rows.column("key").to_numpy().view(np.uint64), counts)
    known = rows.column("known").flatten().to_numpy(zero_copy_only=False)
    _, inverse = np.unique(hashes.flatten().to_numpy().view(np.uint64) ^ (keys * _SALTS[0]), return_inverse=True)
    repeated = np.bincount(inverse, weights=1 + known)[inverse] > 1
    if repeated.any():
        yield _marks(rows, repeated, counts)


def _marks(rows: pa.RecordBatch, repeated: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """Runs of repeated windows as (doc_id, text_hash, start, n)."""
    of = np.repeat(np.arange(len(counts)), counts)
    follows = np.concatenate(([False], repeated[:-1] & (np.diff(of) == 0)))
    begins = np.flatnonzero(repeated & ~follows)
    ends = np.flatnonzero(repeated & ~np.concatenate((follows[1:] & repeated[1:], [False])))
    row = of[begins]
    start = rows.column("start").to_numpy()[row] + (begins - (np.cumsum(counts) - counts)[row])
    return pa.RecordBatch.from_arrays(
        [rows.column("doc_id").take(pa.array(row)), rows.column("text_hash").take(pa.array(row)), pa.array(start.astype(np.int32)), pa.array((ends - begins + 1).astype(np.int32))],
        ["doc_id", "text_hash", "start", "n"],
    )


def repeated_windows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, text_hash, start, n): runs of n windows, from the start-th word of the text (0 first), that occur elsewhere."""
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text").where("text is not null")
    shared = docs.sparkSession.sparkContext.broadcast(sketch(docs, length))
    schema = "key long, doc_id long, text_hash long, start int, n int, hashes array<long>, known array<boolean>"
    suspects = map_arrow(keyed, _suspects(length, shared), schema)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_arrow(suspects.repartition(parts, "key").sortWithinPartitions("key"), _settled, "doc_id long, text_hash long, start int, n int")


def _kept(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"n_words": [], "n_removed": [], "kept": []}
            for text, runs in zip(batch.column("text"), batch.column("runs")):
                words = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                gone = np.zeros(len(words) + 1, np.int64)
                if runs.is_valid and len(runs):
                    starts = runs.values.field("start").to_numpy()
                    np.add.at(gone, starts, 1)
                    np.add.at(gone, starts + runs.values.field("n").to_numpy() + length - 1, -1)
                gone = np.cumsum(gone)[:-1] > 0
                out["n_words"].append(len(words))
                out["n_removed"].append(int(gone.sum()))
                out["kept"].append(b" ".join(words if not gone.any() else [words[i] for i in np.flatnonzero(~gone)]).decode("utf-8", "surrogatepass"))
            rest = [batch.column(c) for c in batch.schema.names if c not in ("text", "runs")]
            names = [c for c in batch.schema.names if c not in ("text", "runs")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()), pa.array(out["kept"], pa.string())], [*names, "n_words", "n_removed", "kept"])

    return run


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for each row of docs (doc_id, text, ...); other columns are not read.

    A word goes if a window of `length` words that covers it occurs anywhere else, the same text included; kept holds the
    remaining words, joined by one space. A null text has no words. A text is known by id and content, so ids may be null or
    repeat; repeated rows count as elsewhere. Texts of fewer words than `length` lose nothing.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    marks = repeated_windows(docs, length).groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "n")).alias("runs"))
    both = rows.join(marks.withColumnsRenamed({"doc_id": "d", "text_hash": "h"}), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
    return map_arrow(both.select("doc_id", "text", "runs"), _kept(length), "doc_id long, n_words long, n_removed long, kept string")


def digest(words: DataFrame) -> DataFrame:
    """The columns of the query: kept as the SHA-256 of its UTF-8 bytes."""
    return words.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
