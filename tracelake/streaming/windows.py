"""Streams of events: bouts as session windows and rates in tumbling windows, with watermarks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.functions.shared import shared_folder
from tracelake.streaming.blocks import STORE


def stream_bouts(events: DataFrame, key: str, gap: str, late: str) -> DataFrame:
    """Events of a key less than `gap` apart, merged: key, first and last event time (ts), n. Emitted once `late` has passed."""
    session = F.session_window("ts", gap)
    merged = events.withWatermark("ts", late).groupBy(key, session).agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count("*").alias("n"))
    return merged.drop("session_window")


def stream_rates(events: DataFrame, key: str, value: str, width: str, late: str) -> DataFrame:
    """Number and mean of `value` by key and tumbling window of ts."""
    made = events.withWatermark("ts", late).groupBy(key, F.window("ts", width).alias("w")).agg(F.count("*").alias("n"), F.avg(value).alias("mean_value"))
    return made.select(key, F.col("w.start").alias("window_start"), "n", "mean_value")


def stream_percentiles(events: DataFrame, key: str, value: str, share: float, width: str, shift: str, late: str) -> DataFrame:
    """Number and exact percentile (share from 0 to 1) of `value` by key and window of ts, a window every `shift`.

    Null values don't count; a window is emitted once `late` has passed its end. A window's values meet in one task as
    counts of distinct values.
    """
    made = events.where(F.col(value).isNotNull()).withWatermark("ts", late).groupBy(key, F.window("ts", width, shift).alias("w")).agg(F.count("*").alias("n"), F.percentile(value, F.lit(share)).alias("low"))
    return made.select(key, F.col("w.start").alias("window_start"), "n", "low")


def drained(stream: DataFrame, base: str | None = None) -> DataFrame:
    """What a stream yields of the input that is there now, appended to Parquet in the shared checkpoint folder and read back.

    With a folder of its own (base), a later call goes on from the state that the one before left there, and returns the
    rows of both.
    """
    spark = stream.sparkSession
    base = base or f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    before = spark.conf.get(STORE[0])
    spark.conf.set(*STORE)
    try:
        query = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start(f"{base}/rows")
    finally:
        spark.conf.set(STORE[0], before)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table, file by file, with ts as a timestamp."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]").withColumn("ts", F.col("ts").cast("timestamp"))
