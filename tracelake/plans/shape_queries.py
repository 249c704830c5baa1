"""Queries on trees of series, registration, spaced peaks, meshes and spectra."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracelake.operators import graphs, linkage, meshes, peaks, registration, space, spectra
from tracelake.operators.columns import ticks
from tracelake.plans.registry import Registry
from tracelake.plans.signal_queries import r6

REGISTRY = Registry()
query = REGISTRY.query


def _vectors(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))


@query()
def hclust(spark, sf_dir):
    """Complete linkage on correlation distance within each label, cut into three clusters, with the order of leaves."""
    rows = _vectors(spark, sf_dir)
    leaves, merges = linkage.linked_series(rows, "label", "vec_id", "x")
    return linkage.clusters(leaves, merges, "label", "vec_id", count=3)


_PAIRS = """z AS (SELECT vec_id, label, list_transform(embedding, lambda v: (v - list_avg(embedding)) / list_stddev_pop(embedding)) AS z FROM embeddings),
d AS (SELECT a.label, a.vec_id AS a, b.vec_id AS b, round(1 - list_dot_product(a.z, b.z) / len(a.z), 12) AS d FROM z a JOIN z b ON a.label = b.label AND a.vec_id < b.vec_id)"""


@query(f"""WITH {_PAIRS}, e AS (SELECT label, a AS k, a, b, d FROM d UNION ALL SELECT label, b, a, b, d FROM d),
n AS (SELECT label, k, arg_min({{'a': a, 'b': b, 'd': d}}, d) AS p FROM e GROUP BY 1, 2)
SELECT label, p.a AS a, p.b AS b, round(p.d, 6) AS height FROM n GROUP BY 1, 2, 3, 4 HAVING count(*) = 2""")
def first_merges(spark, sf_dir):
    """The pairs that are each other's nearest: what the first round of the clustering merges."""
    rows = _vectors(spark, sf_dir)
    found, kind = linkage.reciprocal_series(rows, "label", "vec_id", "x"), rows.schema["vec_id"].dataType
    return found.select("label", F.col("a").cast(kind).alias("a"), F.col("b").cast(kind).alias("b"), r6("height").alias("height"))


@query()
def phase_corr(spark, sf_dir):
    """Each vector as an 8 by 8 frame, registered to the mean frame of its label."""
    rows = _vectors(spark, sf_dir)
    return registration.offsets(rows, registration.template(rows, "label", "x"), "label", "vec_id", "x", 8, 8, most=3)


_FRAME = """f AS (SELECT vec_id, label, (i - 1) // 8 AS y, (i - 1) % 8 AS x, v FROM (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, unnest(range(1, 65)) AS i FROM embeddings)),
m AS (SELECT label, y, x, avg(v) AS m FROM f GROUP BY 1, 2, 3), k AS (SELECT ky, kx FROM (SELECT unnest(range(0, 8)) AS ky), (SELECT unnest(range(0, 8)) AS kx)),
c AS (SELECT k1, k2, cos(pi() * (k1 * k2 % 8) / 4) AS c, sin(pi() * (k1 * k2 % 8) / 4) AS s FROM (SELECT unnest(range(0, 8)) AS k1), (SELECT unnest(range(0, 8)) AS k2)),
b AS (SELECT a.k1 AS ky, a.k2 AS y, d.k1 AS kx, d.k2 AS x, a.c * d.c - a.s * d.s AS c, a.s * d.c + a.c * d.s AS s FROM c a, c d),
i AS (SELECT vec_id, label, ky, kx, sum(v * c) AS re, -sum(v * s) AS im FROM f JOIN b USING (y, x) WHERE ky + kx > 0 GROUP BY 1, 2, 3, 4),
t AS (SELECT label, ky, kx, sum(m * c) AS re, -sum(m * s) AS im FROM m JOIN b USING (y, x) WHERE ky + kx > 0 GROUP BY 1, 2, 3),
x AS (SELECT vec_id, i.label, ky, kx, i.re * t.re + i.im * t.im AS re, i.im * t.re - i.re * t.im AS im FROM i JOIN t USING (label, ky, kx)),
s AS (SELECT vec_id, label, y, x, sum((re * c - im * s) / sqrt(re * re + im * im)) / 64 AS p FROM x JOIN b USING (ky, kx) GROUP BY 1, 2, 3, 4)"""


@query(f"WITH {_FRAME} SELECT vec_id, label, round(max(p), 6) AS peak FROM s WHERE least(y, 8 - y) <= 3 AND least(x, 8 - x) <= 3 GROUP BY 1, 2")
def phase_peak(spark, sf_dir):
    """How high the phase correlation of phase_corr is at its peak."""
    return phase_corr(spark, sf_dir).select("vec_id", "label", r6("peak").alias("peak"))


DISTANCE = 12


def _hours(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type", F.floor(ticks() / 3_600_000_000).alias("hour")).agg(F.sum("value").alias("v"))
    limits = rows.groupBy("event_type").agg((F.percentile("v", F.lit(0.998)) * 0.5).alias("least"))
    return rows.join(limits, "event_type")


@query(f"""WITH RECURSIVE s AS (SELECT event_type, epoch_us(ts) // 3600000000 - epoch_us(TIMESTAMP '2024-01-01') // 3600000000 AS hour, sum(value) AS v FROM events GROUP BY 1, 2),
n AS (SELECT a.*, b.v AS before, c.v AS after FROM s a JOIN s b ON b.event_type = a.event_type AND b.hour = a.hour - 1 JOIN s c ON c.event_type = a.event_type AND c.hour = a.hour + 1),
h AS (SELECT event_type, 0.5 * quantile_cont(v, 0.998) AS least FROM s GROUP BY 1),
c AS (SELECT event_type, hour, v, row_number() OVER (PARTITION BY event_type ORDER BY v DESC, hour) AS r FROM n JOIN h USING (event_type) WHERE v > before AND v >= after AND v >= least),
k(event_type, r, kept) AS (SELECT DISTINCT event_type, 0::BIGINT, []::BIGINT[] FROM c
  UNION ALL SELECT k.event_type, k.r + 1, CASE WHEN len(list_filter(kept, lambda x: abs(x - hour) <= {DISTANCE})) = 0 THEN list_append(kept, hour) ELSE kept END FROM k JOIN c ON c.event_type = k.event_type AND c.r = k.r + 1)
SELECT event_type, hour, round(v, 6) AS v FROM (SELECT event_type, unnest(arg_max(kept, r)) AS hour FROM k GROUP BY 1) JOIN s USING (event_type, hour)""")
def spaced_peaks(spark, sf_dir):
    """Peaks of hourly values, half as high as the 99.8th percentile or more, twelve hours apart."""
    found = peaks.peaks(_hours(spark, sf_dir), "event_type", "hour", "v", F.col("least"), DISTANCE)
    return found.select("event_type", "hour", r6("v").alias("v"))


_SECTIONS = """p AS (SELECT vec_id, label, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings),
m AS (SELECT label, avg(x) AS mx, avg(y) AS my, avg(z) AS mz, 1.5 * stddev_pop(x) AS rx, 1.5 * stddev_pop(y) AS ry, 1.5 * stddev_pop(z) AS rz FROM p GROUP BY 1)"""


@query(f"WITH {_SECTIONS} SELECT vec_id, label, abs(x - mx) / rx + abs(y - my) / ry + abs(z - mz) / rz < 1 AS inside FROM p JOIN m USING (label)")
def inside_mesh(spark, sf_dir):
    """Whether each point lies in an eight-sided mesh around its label's mean."""
    points = _vectors(spark, sf_dir).select("label", "vec_id", *[F.get("x", F.lit(i)).alias(c) for i, c in enumerate("xyz")])
    middle = points.groupBy("label").agg(*[F.avg(c).alias(f"m{c}") for c in "xyz"], *[(1.5 * F.stddev_pop(c)).alias(f"r{c}") for c in "xyz"])
    corner = lambda c, s: [(F.col(f"m{a}") + (s * F.col(f"r{a}") if a == c else F.lit(0.0))).alias(a) for a in "xyz"]
    sides = [F.struct(*[F.struct(*corner(c, s)).alias(f"p{i + 1}") for i, (c, s) in enumerate(zip("xyz", signs))]) for signs in ((a, b, c) for a in (-1, 1) for b in (-1, 1) for c in (-1, 1))]
    mesh = middle.select("label", F.inline(F.array(*sides))).select("label", *[F.col(f"p{i}.{a}").alias(f"{a}{i}") for i in (1, 2, 3) for a in "xyz"])
    return meshes.inside(points, mesh, "label", "vec_id", 0.05).select("vec_id", "label", "inside")


_POWER = """e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, unnest(range(0, 64)) AS i FROM embeddings), k AS (SELECT unnest(range(0, 17)) AS k),
s AS (SELECT vec_id, label, p, i - 16 * p AS j, (v - avg(v) OVER (PARTITION BY vec_id, p)) * (0.5 - 0.5 * cos(2 * pi() * (i - 16 * p) / 32)) AS v FROM e, (SELECT unnest(range(0, 3)) AS p) WHERE i BETWEEN 16 * p AND 16 * p + 31),
q AS (SELECT vec_id, label, p, k, (sum(v * cos(2 * pi() * (j * k % 32) / 32)) ** 2 + sum(v * sin(2 * pi() * (j * k % 32) / 32)) ** 2) / (SELECT sum((0.5 - 0.5 * cos(2 * pi() * j / 32)) ** 2) FROM (SELECT unnest(range(0, 32)) AS j)) AS power FROM s, k GROUP BY 1, 2, 3, 4),
w AS (SELECT vec_id, label, k, avg(power) AS power FROM q GROUP BY 1, 2, 3)"""


@query(f"WITH {_POWER} SELECT label, k AS cycles, round(avg(power), 6) AS power FROM w GROUP BY 1, 2")
def mean_spectrum(spark, sf_dir):
    """The mean power spectrum of each label's series, in half-overlapping segments of 32."""
    rows = _vectors(spark, sf_dir)
    power = spectra.spectra(rows, "vec_id", "x", 32).join(rows.select("vec_id", "label"), "vec_id")
    return power.select("label", F.posexplode("power").alias("cycles", "p")).groupBy("label", F.col("cycles").cast("long").alias("cycles")).agg(r6(F.avg("p")).alias("power"))


@query(f"WITH {_POWER} SELECT vec_id, round(exp(avg(ln(power)) FILTER (k >= 8)), 6) AS noise, round(sum(power) FILTER (k < 8), 6) AS below FROM w GROUP BY 1")
def noise_level(spark, sf_dir):
    """Power above 8 cycles a segment as its geometric mean, and the sum of the power below."""
    levels = spectra.spectra(_vectors(spark, sf_dir), "vec_id", "x", 32).select("vec_id", spectra.above_as_floor("power", 8).alias("p"))
    return levels.select("vec_id", r6(F.element_at("p", -1)).alias("noise"), r6(F.aggregate(F.slice("p", 1, 8), F.lit(0.0), lambda a, v: a + v)).alias("below"))


@query()
def spectral_classes(spark, sf_dir):
    return spectra.classes(spectra.spectra(_vectors(spark, sf_dir), "vec_id", "x", 32), "vec_id", 8)


@query("""WITH RECURSIVE t AS (SELECT vec_id AS node, vec_id AS root, 0::BIGINT AS depth FROM embeddings WHERE vec_id % 100 = 0
UNION ALL SELECT e.vec_id, t.root, t.depth + 1 FROM t JOIN embeddings e ON e.vec_id % 100 > 0 AND e.vec_id - 1 - (e.vec_id % 100 - 1) % 3 = t.node)
SELECT node, root, depth FROM t""")
def tree_depths(spark, sf_dir):
    """Depth and root of every node of trees of up to 34 levels, a hundred nodes each."""
    v = F.col("vec_id").cast("long")
    parent = F.when(v % 100 > 0, v - 1 - (v % 100 - 1) % 3)
    return graphs.depths(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(v.alias("node"), parent.alias("parent"))).select("node", "root", "depth")


_XYZ = "p AS (SELECT vec_id, label, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings)"


def _nodes(spark, sf_dir):
    return _vectors(spark, sf_dir).select("label", "vec_id", *[F.get("x", F.lit(i)).alias(c) for i, c in enumerate("xyz")])


@query(f"""WITH {_XYZ} SELECT label, vec_id, round(x - lead(x, 2) OVER w, 6) AS t_x, round(y - lead(y, 2) OVER w, 6) AS t_y, round(z - lead(z, 2) OVER w, 6) AS t_z
FROM p WINDOW w AS (PARTITION BY label ORDER BY vec_id)""")
def tangent_steps(spark, sf_dir):
    rows = space.tangents(_nodes(spark, sf_dir), "label", "vec_id", list("xyz"), 2)
    return rows.select("label", "vec_id", *[r6(f"t_{c}").alias(f"t_{c}") for c in "xyz"])


@query(f"WITH {_XYZ} SELECT label, vec_id, round(max(x) OVER w - x + min(x) OVER w, 6) AS x, round(y, 6) AS y FROM p WINDOW w AS (PARTITION BY label)")
def mirrored_points(spark, sf_dir):
    """Points mirrored in x within the box of their label."""
    rows = _nodes(spark, sf_dir)
    box = rows.groupBy("label").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    return rows.join(box, "label").select("label", "vec_id", r6(space.mirrored(F.col("x"), F.col("low"), F.col("high"))).alias("x"), r6("y").alias("y"))


@query(f"""WITH {_XYZ}, g AS (SELECT label * 1000 + vec_id // 50 AS path, vec_id, CASE WHEN x <= 0.15 THEN x END AS x FROM p),
n AS (SELECT *, lag(x) OVER w AS before, lead(x) OVER w AS after, lag(vec_id) OVER w IS NULL AS first, lead(vec_id) OVER w IS NULL AS last, x IS NULL AND lag(vec_id) OVER w IS NOT NULL AND lag(x) OVER w IS NULL AS two
  FROM g WINDOW w AS (PARTITION BY path ORDER BY vec_id))
SELECT path, vec_id, round(coalesce(x, (before + after) / 2), 6) AS x FROM n WHERE path NOT IN (SELECT path FROM n WHERE two) AND NOT (x IS NULL AND (first OR last))""")
def gapless_paths(spark, sf_dir):
    """Paths of a label's neighbouring nodes without two missing coordinates in a row, isolated ones filled in."""
    rows = _nodes(spark, sf_dir).select((F.col("label") * 1000 + F.floor(F.col("vec_id") / 50)).alias("path"), "vec_id", F.when(F.col("x") <= 0.15, F.col("x")).alias("x"))
    return space.without_gaps(rows, "path", "vec_id", "x").select("path", "vec_id", r6("x").alias("x"))


@query(f"""WITH {_XYZ}, c AS (SELECT vec_id, 100 * x AS u, 100 * y AS v, 20 + 10 * abs(z) AS r, 240 / tan(radians(22.5)) AS f FROM p)
SELECT vec_id, round(u / sqrt(u * u + v * v + f * f), 6) AS x, round(v / sqrt(u * u + v * v + f * f), 6) AS y, round(f / sqrt(u * u + v * v + f * f), 6) AS z,
round(acos((u * (u + r) + v * v + f * f) / sqrt(u * u + v * v + f * f) / sqrt((u + r) * (u + r) + v * v + f * f)), 6) AS angle FROM c""")
def sphere_views(spark, sf_dir):
    """Where a camera of 640 by 480 pixels and 45 degrees sees spheres, and under which angle."""
    rows = _nodes(spark, sf_dir)
    view = space.sphere_view(320 + 100 * F.col("x"), 240 + 100 * F.col("y"), 20 + 10 * F.abs("z"), F.lit(640.0), F.lit(480.0), F.lit(45.0))
    return rows.withColumn("s", view).select("vec_id", *[r6(F.col(f"s.{c}")).alias(c) for c in ("x", "y", "z", "angle")])
