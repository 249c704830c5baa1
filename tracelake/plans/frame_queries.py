"""Queries on names, frame order, channels, chunks, scaling and metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracelake.operators import frames as R
from tracelake.operators import series as S
from tracelake.plans.registry import Registry
from tracelake.plans.signal_queries import _EV, DAY, _events, r6
from tracelake.plans.table_queries import _LONG, _read

REGISTRY = Registry()
query = REGISTRY.query

_NAMES = "x AS (SELECT o_orderkey, o_custkey || '_' || o_orderkey || '_' || length(o_orderpriority) || '_' || strftime(o_orderdate, '%Y') AS name FROM orders)"


def _long(spark, sf_dir, *more):
    return _read(spark, sf_dir, "embeddings").select("vec_id", "label", F.posexplode("embedding").alias("p", "e")).select("vec_id", "label", (F.col("p") + 1).cast("long").alias("i"), F.col("e").cast("double").alias("v"), *more)


@query(f"""WITH {_NAMES}, p AS (SELECT o_orderkey, string_split(name, '_') AS p FROM x)
SELECT o_orderkey, p[1] AS s0, try_cast(p[2] AS INT) AS n0, try_cast(p[3] AS INT) AS r0, p[1] || '_' || p[2] AS s1, try_cast(p[3] AS INT) AS r1, p[1] || '_' || p[2] || '_' || p[3] AS s2, try_cast(p[4] AS INT) AS r3 FROM p""")
def name_layouts(spark, sf_dir):
    name = F.concat_ws("_", "o_custkey", "o_orderkey", F.length("o_orderpriority"), F.date_format("o_orderdate", "yyyy"))
    rows = _read(spark, sf_dir, "orders").select("o_orderkey", *[R.name_keys(name, k).alias(f"k{k}") for k in range(4)])
    return rows.select("o_orderkey", F.col("k0.subject").alias("s0"), F.col("k0.subject_number").alias("n0"), F.col("k0.repetition").alias("r0"), F.col("k1.subject").alias("s1"), F.col("k1.repetition").alias("r1"), F.col("k2.subject").alias("s2"), F.col("k3.repetition").alias("r3"))


@query(f"""WITH {_EV}, i AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM ev)
SELECT event_id, i // 4 AS stack, i % 4 AS plane FROM i WHERE i // 4 < n // 4""")
def complete_stacks(spark, sf_dir):
    return R.stacked(_events(spark, sf_dir), "user_id", ["t", "event_id"], 4).select("event_id", "stack", "plane")


@query("SELECT p_partkey, round(round(p_retailprice::DOUBLE / (p_size * 32.0) / 0.05) * 0.05, 6) AS voxel FROM part")
def voxel_sizes(spark, sf_dir):
    size = R.voxel_size(F.col("p_retailprice").cast("double"), F.col("p_size").cast("double"), F.lit(32.0), 0.05)
    return _read(spark, sf_dir, "part").select("p_partkey", r6(size).alias("voxel"))


@query(f"WITH {_LONG} SELECT i, vec_id // 4 AS block, round(sum(greatest(v + 0.1, 0)), 6) AS total FROM e GROUP BY 1, 2")
def volume_sums(spark, sf_dir):
    return R.clipped_sums(_long(spark, sf_dir), ["i"], "vec_id", 4, "v", 0.1).withColumn("total", r6("total"))


@query("SELECT p_partkey, p_size::DOUBLE AS setting FROM part WHERE p_partkey % 3 <> 0")
def protocol_rows(spark, sf_dir):
    line = F.concat(F.when(F.col("p_partkey") % 3 == 0, "# ").otherwise(";"), "p_partkey", F.lit("\t[1, "), "p_size", F.lit(", 0]"))
    lines = _read(spark, sf_dir, "part").select(F.split(line, "\t").alias("f")).where(F.get("f", F.lit(0)).startswith(";"))
    return lines.select(F.expr("cast(substring(f[0], 2) as bigint)").alias("p_partkey"), R.bracketed(F.get("f", F.lit(1)), 1).alias("setting"))


@query("SELECT 'c' AS kind, c_custkey AS k, c_acctbal::DOUBLE AS acctbal, c_mktsegment AS segment FROM customer UNION ALL SELECT 's', s_suppkey, s_acctbal::DOUBLE, NULL FROM supplier")
def union_by_name(spark, sf_dir):
    made = lambda t, p: _read(spark, sf_dir, t).withColumnsRenamed({f"{p}_{a}": b for a, b in (("custkey", "K"), ("suppkey", "K"), ("acctbal", "Acctbal"), ("mktsegment", "segment"))}).withColumn("kind", F.lit(p))
    return R.union_all([made("customer", "c"), made("supplier", "s")], ["kind", "k", "acctbal", "segment"]).withColumn("acctbal", F.col("acctbal").cast("double"))


@query("SELECT vec_id, label FROM embeddings WHERE vec_id BETWEEN 20 AND 79 AND (vec_id - 20) % 3 = 0")
def frame_slice(spark, sf_dir):
    return _read(spark, sf_dir, "embeddings").where(F.col("vec_id").between(20, 79) & ((F.col("vec_id") - 20) % 3 == 0)).select("vec_id", "label")


@query("SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS found FROM customer")
def key_exists(spark, sf_dir):
    there = _read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("_there", F.lit(True))
    return _read(spark, sf_dir, "customer").select("c_custkey").join(there, "c_custkey", "left").select("c_custkey", F.coalesce("_there", F.lit(False)).alias("found"))


@query(f"WITH {_EV} SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY t) - 1 AS index FROM ev a WHERE NOT EXISTS (SELECT 1 FROM ev b WHERE b.user_id = a.user_id AND b.t = a.t AND b.value > 40)")
def prune_times(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return R.without(ev, "user_id", "t", ev.where("value > 40")).select("event_id", "index")


@query(f"WITH {_LONG} SELECT vec_id, CASE WHEN i > 3 THEN i - 1 ELSE i END AS i, round(v, 6) AS v FROM e WHERE i <> 3")
def drop_plane(spark, sf_dir):
    return R.without_plane(_long(spark, sf_dir), "i", F.lit(3)).select("vec_id", "i", r6("v").alias("v"))


@query(f"WITH {_LONG}, c AS (SELECT * FROM e WHERE i % 2 = 1) SELECT vec_id, i, round(v - min(v) OVER (PARTITION BY label), 6) AS v FROM c")
def channel_split(spark, sf_dir):
    rows = _long(spark, sf_dir).withColumn("channel", F.col("i") % 2)
    return R.shifted_channel(rows, "channel", 1, "v", ["label"]).select("vec_id", "i", r6("v").alias("v"))


@query(f"WITH {_LONG} SELECT vec_id, round(avg(v) FILTER (i % 2 = 1), 6) AS red, round(avg(v) FILTER (i % 2 = 0), 6) AS green FROM e GROUP BY 1")
def channel_merge(spark, sf_dir):
    rows = _long(spark, sf_dir).withColumn("channel", F.when(F.col("i") % 2 == 1, "red").otherwise("green"))
    return R.merged_channels(rows, ["vec_id"], "channel", "v", ["red", "green"]).select("vec_id", r6("red").alias("red"), r6("green").alias("green"))


@query("""WITH m AS (SELECT l_orderkey, l_linenumber, l_extendedprice::DOUBLE AS v, (SELECT max(l_extendedprice)::DOUBLE FROM lineitem) AS m FROM lineitem)
SELECT l_orderkey, l_linenumber, least(255, greatest(0, round(v / m * 256)))::BIGINT AS u8, least(65535, greatest(0, round(v / m * 65536)))::BIGINT AS u16, least(65535, greatest(0, round(v)))::BIGINT AS plain FROM m""")
def to_unsigned(spark, sf_dir):
    rows = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").cast("double").alias("v"))
    most = rows.agg(F.max("v").alias("most"))  # a single row
    rows = rows.crossJoin(F.broadcast(most))
    return rows.select("l_orderkey", "l_linenumber", R.scaled_to(F.col("v"), F.col("most"), 8).alias("u8"), R.scaled_to(F.col("v"), F.col("most"), 16).alias("u16"), R.scaled_to(F.col("v"), None, 16).alias("plain"))


@query(f"WITH {_EV} SELECT event_id, ceil(row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) / 7)::BIGINT AS chunk FROM ev")
def chunks(spark, sf_dir):
    return _events(spark, sf_dir).select("event_id", R.chunk(["t", "event_id"], 7, ["user_id"]).alias("chunk"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, string_agg(DISTINCT year(l_shipdate)::VARCHAR, ',' ORDER BY year(l_shipdate)::VARCHAR) AS years FROM lineitem GROUP BY 1, 2")
def group_arrays(spark, sf_dir):
    sets = _read(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_set(F.year("l_shipdate").cast("string"))), ",").alias("years"))
    return sets


@query(f"WITH {_LONG} SELECT vec_id AS source, i - 1 AS position, round(v, 6) AS value FROM e")
def concat_sources(spark, sf_dir):
    rows = R.concatenated(_read(spark, sf_dir, "embeddings").select("vec_id", S.doubles("embedding").alias("x")), "vec_id", "x")
    return rows.select("source", F.col("position").cast("long").alias("position"), r6("value").alias("value"))


@query(f"WITH {_LONG} SELECT vec_id, i, round(CASE WHEN v = 0 THEN v ELSE v * exp((i - 10) / 20.0) END, 6) AS v FROM e")
def depth_correction(spark, sf_dir):
    return _long(spark, sf_dir).select("vec_id", "i", r6(R.depth_corrected(F.col("v"), F.col("i"), 10, 20.0)).alias("v"))


@query(f"""WITH {_LONG}, b AS (SELECT label, min(v) AS lo FROM e GROUP BY 1), s AS (SELECT vec_id, label, 65 - i AS z, greatest(v - lo - 0.05, 0) AS v FROM e JOIN b USING (label))
SELECT label, z, round(avg(v), 6) AS mean, bool_and(v = 0) AS empty, count(*) FILTER (v = 0) AS n_zero FROM s GROUP BY 1, 2""")
def prepared_planes(spark, sf_dir):
    rows = _long(spark, sf_dir)
    least = rows.groupBy("label").agg(F.min("v").alias("lo"))
    rows = rows.join(least, "label").select("label", (65 - F.col("i")).alias("z"), F.greatest(F.col("v") - F.col("lo") - 0.05, F.lit(0.0)).alias("v"))
    return rows.groupBy("label", "z").agg(r6(F.avg("v")).alias("mean"), F.bool_and(F.col("v") == 0).alias("empty"), F.count_if(F.col("v") == 0).alias("n_zero"))


@query("SELECT event_id, round(value / 1000, 6) AS seconds, event_type AS stimulus FROM events")
def stimulus_info(spark, sf_dir):
    return _read(spark, sf_dir, "events").select("event_id", r6(F.col("value") / 1000).alias("seconds"), F.col("event_type").alias("stimulus"))


@query(f"WITH {_EV}, s AS (SELECT user_id, t, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS frame, count(*) OVER (PARTITION BY user_id) AS n, t - lag(t) OVER (PARTITION BY user_id ORDER BY t, event_id) AS d FROM ev)\nSELECT user_id, frame, t AS time FROM s WHERE frame <= 60 UNION ALL SELECT user_id, n + k, t + d * k FROM s, range(1, 60) AS r(k) WHERE frame = n AND n < 60 AND k <= 60 - n")
def frame_times(spark, sf_dir):
    return R.homogenised(_events(spark, sf_dir), "user_id", "t", F.lit(60))


@query(f"""WITH {_EV}, d AS (SELECT user_id, t // {DAY} AS day, t, value FROM ev), e AS (SELECT user_id, day, max(t) AS t FROM d GROUP BY 1, 2), g AS (SELECT user_id, day, t, lead(day) OVER (PARTITION BY user_id ORDER BY day) AS nx FROM e),
a AS (SELECT user_id, day, t, value, 0 AS gap FROM d UNION ALL SELECT user_id, day, t, NULL, k FROM g, range(1, 3) AS r(k) WHERE nx IS NOT NULL)
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY day, t, gap) - 1 AS clock, round(value, 6) AS value FROM a""")
def gap_rows(spark, sf_dir):
    rows = _events(spark, sf_dir).select("user_id", F.floor(F.col("t") / DAY).alias("day"), "t", "value")
    return R.with_gaps(rows, "user_id", "day", "t", 2).select("user_id", "clock", r6("value").alias("value"))


@query(f"""WITH {_EV}, a AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS position FROM ev WHERE event_type = 'click'),
b AS (SELECT event_id AS pulse, user_id, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS position FROM ev WHERE event_type = 'view') SELECT event_id, pulse, position FROM a JOIN b USING (user_id, position)""")
def positional_join(spark, sf_dir):
    ev = _events(spark, sf_dir)
    pulses = ev.where("event_type = 'view'").select("user_id", F.col("t").alias("pulse_t"), F.col("event_id").alias("pulse"))
    return R.by_position(ev.where("event_type = 'click'"), pulses, "user_id", ["t", "event_id"], ["pulse_t", "pulse"]).select("event_id", "pulse", "position")


@query("WITH f AS (SELECT event_type, min(event_id) AS a FROM events GROUP BY 1), g AS (SELECT event_type, row_number() OVER (ORDER BY a, event_type) AS id FROM f) SELECT event_id, id FROM events JOIN g USING (event_type)")
def global_ids(spark, sf_dir):
    ev = _read(spark, sf_dir, "events").select("event_id", "event_type")
    return ev.join(R.first_seen_ids(ev, "event_type", "event_id"), "event_type").select("event_id", "id")


@query("""WITH a AS (SELECT DISTINCT split_part(p_name, ' ', 1) AS k FROM part), b AS (SELECT DISTINCT split_part(c_mktsegment, ' ', 1) AS k FROM customer UNION SELECT k FROM a WHERE length(k) > 4), k AS (SELECT k FROM a INTERSECT SELECT k FROM b),
m AS (SELECT p_partkey, k FROM part JOIN k ON contains(p_name, k)) SELECT p_partkey, min(k) AS key, count(*) AS n_keys, count(*) > 1 AS ambiguous FROM m GROUP BY 1""")
def shared_keys(spark, sf_dir):
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_name")
    first = lambda df, c: df.select(F.get(F.split(c, " "), F.lit(0)).alias("k")).distinct()
    a = first(part, "p_name")
    b = first(_read(spark, sf_dir, "customer"), "c_mktsegment").union(a.where(F.length("k") > 4))
    found = R.containing(part, "p_name", a.intersect(b))
    return found.groupBy("p_partkey").agg(F.min("k").alias("key"), F.count("*").alias("n_keys"), (F.count("*") > 1).alias("ambiguous"))
