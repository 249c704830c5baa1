"""Streams of samples cut into blocks of a fixed number, an incomplete last block waiting for what comes next."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, BooleanType, DoubleType, FloatType, IntegralType, LongType, StructField, StructType

#: State of this kind needs the store that keeps it on disk.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
#: Keys share so many states by their hash, as a call costs more than a key's samples do. A checkpoint holds for one number.
PLACES = 1024


def _processor(names: list[str], size: int, sorting: list[str]) -> StatefulProcessor:
    """The processor, of a class that is sent along with it: Spark also opens it beside the driver, where this package need not be installed."""

    class Blocks(StatefulProcessor):
        """Holds the samples of a place's keys until the watermark has passed them, then puts them into blocks in order."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            table = StructType([StructField("rows", BinaryType())])
            self.waiting = handle.getListState("waiting", table)
            self.blocks = handle.getValueState("blocks", table)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
            pieces = [piece[names] for piece in rows]
            yield from self._due(pd.concat(pieces, ignore_index=True), timerValues)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
            yield from self._due(None, timerValues)

        def close(self) -> None:
            pass

        def _packed(self, rows: pd.DataFrame) -> tuple[bytes]:
            batch = pa.RecordBatch.from_pandas(rows, preserve_index=False)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema) as out:
                out.write_batch(batch)
            return (sink.getvalue().to_pybytes(),)

        def _unpacked(self, held) -> pd.DataFrame:
            return pa.ipc.open_stream(held[0]).read_pandas()

        def _due(self, fresh, timers) -> Iterator[pd.DataFrame]:
            tables = [self._unpacked(held) for held in self.waiting.get()]
            tables += [] if fresh is None else [fresh]
            if not tables:
                return
            waiting = pd.concat(tables, ignore_index=True).sort_values(["k", *sorting], kind="stable", na_position="first", ignore_index=True)
            # Keys are sorted: each one's samples follow each other, by time.
            of = pd.factorize(waiting["k"], use_na_sentinel=False)[0]
            first = np.flatnonzero(np.diff(of, prepend=-1))
            us = waiting["us"].to_numpy()
            whole = np.bincount(of[us <= timers.getCurrentWatermarkInMs() * 1000], minlength=len(first)) // size
            at = np.arange(len(of)) - first[of]
            gone = at < whole[of] * size
            due = us[at == whole[of] * size + size - 1]
            if len(due):
                # The watermark counts milliseconds; by this one the next block is due.
                self.handle.registerTimer(-(-int(due.min()) // 1000))
            if not gone.any():
                if fresh is not None:
                    self.waiting.appendValue(self._packed(fresh))
                return
            if gone.all():
                self.waiting.clear()
            else:
                self.waiting.put([self._packed(waiting[~gone])])
            keys = waiting["k"].iloc[first].reset_index(drop=True)
            before = np.zeros(len(first), np.int64)
            counts = pd.DataFrame({"k": keys, "n": whole})
            if self.blocks.exists():
                held = self._unpacked(self.blocks.get())
                before = keys.map(held.set_index("k")["n"]).fillna(0).to_numpy(np.int64)
                counts["n"] += before
                counts = pd.concat([held[~held["k"].isin(keys)], counts], ignore_index=True)
            self.blocks.update(self._packed(counts[counts["n"] > 0]))
            out = waiting[gone]
            yield pd.DataFrame({"k": out["k"], "block": before[of[gone]] + at[gone] // size, "place": at[gone] % size} | {n: out[n] for n in names[1:]})

    return Blocks()


def stream_blocks(samples: DataFrame, key: str, order: list[str], values: list[str], size: int, late: str) -> DataFrame:
    """A stream's samples in blocks of `size` for each key: key, block, place (both from 0), ts, order columns and values.

    Samples go by ts, then by the order columns (nulls first), over all that comes within `late`, however it is spread over
    files and triggers; what comes later may be left out. Blocks come out whole, once the watermark has passed them: the
    samples of an incomplete one and those that it hasn't passed stay in the state, and a run that goes on from the same
    checkpoint takes them up. Samples without a key or a ts are left out; repeated samples count each time and values may
    be null. Other columns are ignored. Keys share PLACES states, and a place's waiting samples meet in one task: what a trigger
    reads (maxFilesPerTrigger) and what comes within `late` bound them.
    """
    kept = [*order, *values]
    short, some = [f"c{i}" for i in range(len(kept))], [f"some{i}" for i in range(len(kept))]
    kinds = [samples.schema[n].dataType for n in kept]
    # Whole numbers with nulls between them would be read as floating point, so what is null is a column of its own.
    filled = [F.coalesce(n, F.lit(0).cast(k)) if isinstance(k, (IntegralType, BooleanType)) else F.col(n) for n, k in zip(kept, kinds)]
    rows = samples.where(F.col(key).isNotNull() & F.col("ts").isNotNull()).select(
        F.pmod(F.xxhash64(key), F.lit(PLACES)).alias("at"), F.col(key).alias("k"), "ts", F.unix_micros("ts").alias("us"),
        *(c.alias(s) for c, s in zip(filled, short)), *(F.col(n).isNotNull().alias(s) for n, s in zip(kept, some)),
    )
    rows = rows.withWatermark("ts", late)
    names = ["k", "us", *short, *some]
    held = [StructField(n, rows.schema[n].dataType) for n in names]
    schema = StructType([held[0], StructField("block", LongType()), StructField("place", LongType()), *held[1:]])
    # A null comes before all values, as False does before True.
    sorting = ["us", *(c for pair in zip(some, short[: len(order)]) for c in pair)]
    made = rows.groupBy("at").transformWithStateInPandas(_processor(names, size, sorting), schema, "append", "eventTime")
    # pandas takes NaN for null.
    back = [F.coalesce(s, F.lit(float("nan")).cast(k)) if isinstance(k, (DoubleType, FloatType)) else F.col(s) for s, k in zip(short, kinds)]
    return made.select(F.col("k").alias(key), "block", "place", F.timestamp_micros("us").alias("ts"), *(F.when(F.col(n), c).alias(name) for n, c, name in zip(some, back, kept)))
