"""Queries on arrays of samples, groups, tests, geometry and names."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tracelake.operators import images as I
from tracelake.operators import series as S
from tracelake.operators import stats as T
from tracelake.operators.columns import long_form, ratio, safe_corr
from tracelake.plans.signal_queries import r6

QUERIES: dict = {}
ORACLE: dict = {}


def query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def _read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LONG = "e AS (SELECT vec_id, label, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings)"


def _array_query(spark, sf_dir, made):
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", S.doubles("embedding").alias("x")).select("vec_id", F.posexplode(made).alias("i", "v"))
    return rows.select("vec_id", (F.col("i") + 1).cast("long").alias("i"), r6("v").alias("v"))


@query(f"WITH {_LONG} SELECT vec_id, i, round((v - avg(v) OVER w) / nullif(stddev_pop(v) OVER w, 0), 6) AS v FROM e WINDOW w AS (PARTITION BY vec_id)")
def zscore_series(spark, sf_dir):
    return _array_query(spark, sf_dir, S.zscored(F.col("x")))


@query(f"WITH {_LONG} SELECT vec_id, i, round(v / nullif(sqrt(sum(v * v) OVER (PARTITION BY vec_id)), 0), 6) AS v FROM e")
def unit_norm(spark, sf_dir):
    return _array_query(spark, sf_dir, S.p_normed(F.col("x")))


@query(f"WITH {_LONG} SELECT vec_id, i, round(v - avg(v) OVER (PARTITION BY vec_id), 6) AS v FROM e")
def centred_series(spark, sf_dir):
    return _array_query(spark, sf_dir, S.centred(F.col("x")))


@query(f"WITH {_LONG} SELECT vec_id, i, round(v / nullif(sqrt(avg(v * v) OVER (PARTITION BY vec_id)), 0), 6) AS v FROM e")
def rms_norm(spark, sf_dir):
    return _array_query(spark, sf_dir, S.rms_normed(F.col("x")))


@query(f"""WITH {_LONG} SELECT vec_id, i, round((v + exp(-0.5) * (coalesce(lag(v, 1) OVER w, 0) + coalesce(lead(v, 1) OVER w, 0)) + exp(-2.0) * (coalesce(lag(v, 2) OVER w, 0) + coalesce(lead(v, 2) OVER w, 0)))
 / (1 + 2 * exp(-0.5) + 2 * exp(-2.0)), 6) AS v FROM e WINDOW w AS (PARTITION BY vec_id ORDER BY i)""")
def gauss_blur(spark, sf_dir):
    return _array_query(spark, sf_dir, S.blurred(F.col("x"), 1.0, 5))


@query(f"""WITH {_LONG}, k AS (SELECT vec_id, i, least(2, i - 1, max(i) OVER (PARTITION BY vec_id) - i) AS h FROM e)
SELECT k.vec_id, k.i, round(avg(e.v), 6) AS v FROM k JOIN e ON e.vec_id = k.vec_id AND e.i BETWEEN k.i - k.h AND k.i + k.h GROUP BY 1, 2""")
def moving_average(spark, sf_dir):
    return _array_query(spark, sf_dir, S.moving_average(F.col("x"), 5))


@query(f"""WITH {_LONG}, s AS (SELECT vec_id, sum(v * v) AS q FROM e GROUP BY 1), l AS (SELECT unnest(range(0, 11)) AS lag)
SELECT a.vec_id, lag::BIGINT AS lag, round(sum(a.v * b.v) / any_value(q), 6) AS r FROM e a CROSS JOIN l JOIN e b ON a.vec_id = b.vec_id AND b.i = a.i + lag JOIN s ON s.vec_id = a.vec_id GROUP BY 1, 2""")
def autocorr(spark, sf_dir):
    rows = _array_query(spark, sf_dir, S.lagged_products(F.col("x"), 10))
    return rows.select("vec_id", (F.col("i") - 1).alias("lag"), F.col("v").alias("r"))


@query(f"""WITH {_LONG}, c AS (SELECT vec_id, i, v - avg(v) OVER (PARTITION BY vec_id) AS x FROM e), l AS (SELECT a.k AS d, b.k AS k FROM (SELECT unnest(range(0, 4)) AS k) a, (SELECT unnest(range(0, 4)) AS k) b WHERE a.k <= b.k)
SELECT a.vec_id, l.d::INT AS d, l.k::INT AS k, round(sum(a.x * b.x * c2.x) / 64, 6) AS m FROM c a CROSS JOIN l JOIN c b ON b.vec_id = a.vec_id AND b.i = a.i + l.d JOIN c c2 ON c2.vec_id = a.vec_id AND c2.i = a.i + l.k GROUP BY 1, 2, 3""")
def third_moment(spark, sf_dir):
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", S.doubles("embedding").alias("x"))
    made = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(k).alias("k"), r6(S.third_moment(F.col("x"), d, k)).alias("m")) for d in range(4) for k in range(d, 4)])
    return rows.select("vec_id", F.inline(made))


@query(f"WITH {_LONG} SELECT label, round(sqrt(sum(m * m)), 6) AS crispness FROM (SELECT label, i, avg(abs(v)) AS m FROM e GROUP BY 1, 2) GROUP BY 1")
def crispness(spark, sf_dir):
    e = _read(spark, sf_dir, "embeddings")
    mean = long_form(e, "label", "embedding").groupBy("label", "i").agg(F.avg(F.abs("v")).alias("m"))
    return mean.groupBy("label").agg(r6(F.sqrt(F.sum(F.col("m") * F.col("m")))).alias("crispness"))


@query(f"WITH {_LONG}, m AS (SELECT i, avg(v) AS m FROM e GROUP BY 1) SELECT vec_id, round(corr(v, m), 6) AS r FROM e JOIN m USING (i) GROUP BY 1")
def template_corr(spark, sf_dir):
    e = long_form(_read(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    both = e.join(F.broadcast(e.groupBy("i").agg(F.avg("v").alias("m"))), "i")  # one row for each position in a series
    return both.groupBy("vec_id").agg(r6(safe_corr(F.col("v"), F.col("m"))).alias("r"))


@query("SELECT label, count(*) FILTER (list_max(embedding) < 0.3) AS dark, count(*) AS n FROM embeddings GROUP BY 1")
def saturation_score(spark, sf_dir):
    dark = F.array_max("embedding") < F.lit(0.3).cast("float")
    return _read(spark, sf_dir, "embeddings").groupBy("label").agg(F.count(F.when(dark, 1)).alias("dark"), F.count("*").alias("n"))


@query(f"""WITH {_LONG}, s AS (SELECT vec_id, max(v) * pow(sum(v * v * v * v), 0.25) AS score FROM e GROUP BY 1)
SELECT vec_id, round(score, 6) AS score, row_number() OVER (ORDER BY score DESC, vec_id) AS rank FROM s QUALIFY rank <= 20""")
def rank_components(spark, sf_dir):
    top = _read(spark, sf_dir, "embeddings").select("vec_id", _score().alias("s")).orderBy(F.desc("s"), "vec_id").limit(20)
    return top.select("vec_id", r6("s").alias("score"), F.row_number().over(Window.orderBy(F.desc("s"), "vec_id")).cast("long").alias("rank"))


def _score():
    return F.transform(F.array(S.doubles("embedding")), lambda x: F.array_max(x) * F.pow(F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v * v * v), F.lit(0.25)))[0]


@query(f"""WITH {_LONG}, c AS (SELECT vec_id, i, sum(v * v) OVER (PARTITION BY vec_id ORDER BY v * v, i) / sum(v * v) OVER (PARTITION BY vec_id) AS share FROM e) SELECT vec_id, count(*) AS kept FROM c WHERE share > 0.01 GROUP BY 1""")
def energy_cut(spark, sf_dir):
    e = long_form(_read(spark, sf_dir, "embeddings"), "vec_id", "embedding").withColumn("q", F.col("v") * F.col("v"))
    w = Window.partitionBy("vec_id")
    share = ratio(F.sum("q").over(w.orderBy("q", "i").rowsBetween(Window.unboundedPreceding, 0)), F.sum("q").over(w))
    return e.withColumn("share", share).where("share > 0.01").groupBy("vec_id").agg(F.count("*").alias("kept"))


@query(f"""WITH {_LONG}, g AS (SELECT vec_id AS t, (i - 1) // 8 AS y, (i - 1) % 8 AS x, v FROM e),
n AS (SELECT a.y, a.x, b.y AS y2, b.x AS x2, corr(a.v, b.v) AS r FROM g a JOIN g b ON a.t = b.t AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 AND (a.y <> b.y OR a.x <> b.x) GROUP BY 1, 2, 3, 4)
SELECT y::BIGINT AS y, x::BIGINT AS x, round(avg(coalesce(r, 0)), 6) AS rho FROM n GROUP BY 1, 2""")
def neighbour_corr_2d(spark, sf_dir):
    frames = _read(spark, sf_dir, "embeddings").select(S.doubles("embedding").alias("x"))
    return I.neighbour_correlation(frames, "x", (8, 8)).select(F.floor(F.col("cell") / 8).alias("y"), F.pmod("cell", F.lit(8)).cast("long").alias("x"), r6("rho").alias("rho"))


@query(f"""WITH {_LONG}, h AS (SELECT label, i, avg(v) FILTER (vec_id % 2 = 0) AS a, avg(v) FILTER (vec_id % 2 = 1) AS b FROM e GROUP BY 1, 2) SELECT label, round(corr(a, b), 6) AS r FROM h GROUP BY 1""")
def split_half(spark, sf_dir):
    e = _read(spark, sf_dir, "embeddings").select("label", "vec_id", F.posexplode("embedding").alias("i", "f")).withColumn("v", F.col("f").cast("double"))
    halves = e.groupBy("label", "i").agg(F.avg(F.when(F.col("vec_id") % 2 == 0, F.col("v"))).alias("a"), F.avg(F.when(F.col("vec_id") % 2 == 1, F.col("v"))).alias("b"))
    return T.correlation_by(halves, ["label"], "a", "b").withColumn("r", r6("r"))


@query("SELECT year(l_shipdate)::INT AS y, month(l_shipdate)::INT AS m, l_returnflag, round(median(l_extendedprice::DOUBLE), 6) AS price FROM lineitem GROUP BY 1, 2, 3")
def median_trend(spark, sf_dir):
    li = _read(spark, sf_dir, "lineitem")
    return li.groupBy(F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("m"), "l_returnflag").agg(r6(F.percentile(F.col("l_extendedprice").cast("double"), F.lit(0.5))).alias("price"))


@query("""WITH b AS (SELECT l_returnflag, least(19, floor(l_extendedprice::DOUBLE / 5500))::BIGINT AS bin, count(*) AS n FROM lineitem GROUP BY 1, 2) SELECT l_returnflag, bin, n, round(n / sum(n) OVER (PARTITION BY l_returnflag), 6) AS p FROM b""")
def hist_norm(spark, sf_dir):
    b = F.least(F.lit(19).cast("long"), F.floor(F.col("l_extendedprice").cast("double") / 5500))
    counts = _read(spark, sf_dir, "lineitem").groupBy("l_returnflag", b.alias("bin")).agg(F.count("*").alias("n"))
    return counts.select("l_returnflag", "bin", "n", r6(F.col("n") / F.sum("n").over(Window.partitionBy("l_returnflag"))).alias("p"))


@query("""WITH b AS (SELECT least(15, floor(l_quantity::DOUBLE / 3.2))::BIGINT AS bx, least(15, floor(l_extendedprice::DOUBLE / 7000))::BIGINT AS y, count(*) AS n FROM lineitem GROUP BY 1, 2),
g AS (SELECT gx::BIGINT AS x, gy::BIGINT AS y FROM (SELECT unnest(range(16)) AS gx), (SELECT unnest(range(16)) AS gy))
SELECT g.x, g.y, coalesce(n, 0)::BIGINT AS n, round(coalesce(n, 0) / max(n) OVER (), 6) AS by_max, round(coalesce(n, 0) / sum(n) OVER (), 6) AS by_sum FROM g LEFT JOIN b ON b.bx = g.x AND b.y = g.y""")
def density_2d(spark, sf_dir):
    cell = lambda c, w: F.least(F.lit(15).cast("long"), F.floor(F.col(c).cast("double") / w))
    counts = _read(spark, sf_dir, "lineitem").groupBy(cell("l_quantity", 3.2).alias("x"), cell("l_extendedprice", 7000).alias("y")).agg(F.count("*").alias("n"))
    grid = spark.range(256).select(F.floor(F.col("id") / 16).alias("x"), F.pmod("id", F.lit(16)).alias("y"))  # at most 256 rows from here on
    rows = grid.join(counts, ["x", "y"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))
    w = Window.partitionBy(F.lit(0))
    return rows.select("x", "y", "n", r6(F.col("n") / F.max("n").over(w)).alias("by_max"), r6(F.col("n") / F.sum("n").over(w)).alias("by_sum"))


@query("SELECT l_returnflag, l_linestatus, round(stddev_samp(l_quantity::DOUBLE) / sqrt(count(*)), 6) AS sem, count(*) AS n FROM lineitem GROUP BY 1, 2")
def sem_by_group(spark, sf_dir):
    return _read(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(r6(F.stddev_samp(F.col("l_quantity").cast("double")) / F.sqrt(F.count("*"))).alias("sem"), F.count("*").alias("n"))


@query("""WITH d AS (SELECT n_chars::DOUBLE AS v, quality = 1 AS g FROM documents JOIN labels USING (doc_id)),
s AS (SELECT count(*) FILTER (g) AS n1, count(*) FILTER (NOT g) AS n2, avg(v) FILTER (g) AS m1, avg(v) FILTER (NOT g) AS m2, var_samp(v) FILTER (g) AS v1, var_samp(v) FILTER (NOT g) AS v2 FROM d)
SELECT n1, n2, round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2)), 6) AS d FROM s""")
def cohen_d(spark, sf_dir):
    rows = _read(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").cast("double").alias("v")).join(_read(spark, sf_dir, "labels"), "doc_id")
    return T.cohen_d(rows, F.col("quality") == 1, "v").withColumn("d", r6("d"))


_P = "p AS (SELECT label, vec_id, greatest(1e-6, abs(list_sum(embedding[1:8])::DOUBLE) / 8) AS p0 FROM embeddings), f AS (SELECT label, vec_id, least(1.0, round(p0, 4)) AS p FROM p)"


def _family(spark, sf_dir):
    p0 = F.greatest(F.lit(1e-6), F.abs(F.aggregate(F.slice(S.doubles("embedding"), 1, 8), F.lit(0.0), lambda a, v: a + v)) / 8)
    return _read(spark, sf_dir, "embeddings").select("label", "vec_id", F.least(F.lit(1.0), F.round(p0, 4)).alias("p"))


_FDR = """WITH {p}, r AS (SELECT *, count(*) OVER (PARTITION BY label) AS m, count(*) OVER (PARTITION BY label ORDER BY p) AS k FROM f), c AS (SELECT *, {c} AS c FROM r),
a AS (SELECT *, min(p * m * c / k) OVER (PARTITION BY label ORDER BY p DESC) AS adj, max(CASE WHEN p <= k / m * 0.2 / c THEN p END) OVER (PARTITION BY label) AS crit FROM c)
SELECT vec_id, round(adj, 6) AS adjusted, round(coalesce(crit, 0), 6) AS critical_p, p <= coalesce(crit, 0) AS reject FROM a"""


@query(_FDR.format(p=_P, c="1.0"))
def fdr_bh(spark, sf_dir):
    return T.false_discovery(_family(spark, sf_dir), ["label"], "p", 0.2).select("vec_id", r6("adjusted").alias("adjusted"), r6("critical_p").alias("critical_p"), "reject")


@query(_FDR.format(p=_P, c="list_sum(list_transform(range(1, m + 1), lambda i: 1 / i))"))
def fdr_by(spark, sf_dir):
    return T.false_discovery(_family(spark, sf_dir), ["label"], "p", 0.2, dependent=True).select("vec_id", r6("adjusted").alias("adjusted"), r6("critical_p").alias("critical_p"), "reject")


@query(f"""WITH {_P}, a AS (SELECT *, p * (count(*) OVER (PARTITION BY label) - row_number() OVER (PARTITION BY label ORDER BY p, vec_id) + 1) AS x FROM f),
b AS (SELECT vec_id, least(1.0, max(x) OVER (PARTITION BY label ORDER BY p, vec_id)) AS adj FROM a) SELECT vec_id, round(adj, 6) AS adjusted, adj < 0.05 AS reject FROM b""")
def holm(spark, sf_dir):
    return T.holm(_family(spark, sf_dir), ["label"], "p", "vec_id").select("vec_id", r6("adjusted").alias("adjusted"), "reject")


@query("""WITH v AS (SELECT DISTINCT l_linestatus, l_extendedprice FROM lineitem), c AS (SELECT l_linestatus, l_extendedprice, l_returnflag = 'A' AS a FROM lineitem),
s AS (SELECT l_linestatus, l_extendedprice, sum(a::INT) AS na, sum((NOT a)::INT) AS nb FROM c GROUP BY 1, 2),
w AS (SELECT l_linestatus, abs(sum(na) OVER u / sum(na) OVER t - sum(nb) OVER u / sum(nb) OVER t) AS g FROM s WINDOW u AS (PARTITION BY l_linestatus ORDER BY l_extendedprice), t AS (PARTITION BY l_linestatus))
SELECT l_linestatus, round(max(g), 6) AS d FROM w GROUP BY 1""")
def ks_stat(spark, sf_dir):
    return T.ks_statistic(_read(spark, sf_dir, "lineitem"), ["l_linestatus"], F.col("l_returnflag") == "A", "l_extendedprice").withColumn("d", r6("d"))


@query(f"""WITH {_LONG}, s AS (SELECT unnest(range(11, 54)) AS k), o AS (SELECT a.vec_id, s.k, corr(a.v, b.v) AS r FROM e a CROSS JOIN s JOIN e b ON b.vec_id = a.vec_id AND b.i = (a.i - 1 + s.k) % 64 + 1 GROUP BY 1, 2)
SELECT vec_id, round(max(r), 6) AS best, count(*) AS shifts FROM o GROUP BY 1""")
def circular_perm(spark, sf_dir):
    x = S.zscored(S.doubles("embedding"))
    rows = _read(spark, sf_dir, "embeddings").select("vec_id", x.alias("z"))
    dot = lambda k: F.aggregate(F.zip_with("z", F.concat(F.slice(F.col("z"), k + 1, 64), F.slice(F.col("z"), F.lit(1), k)), lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v) / F.size("z")
    rows = rows.select("vec_id", F.transform(F.sequence(F.lit(11), F.lit(53)), dot).alias("r"))
    return rows.select("vec_id", r6(F.array_max("r")).alias("best"), F.size("r").cast("long").alias("shifts"))


@query("""WITH s AS (SELECT l_returnflag, regr_slope(l_extendedprice::DOUBLE, l_quantity::DOUBLE) AS m, regr_intercept(l_extendedprice::DOUBLE, l_quantity::DOUBLE) AS b FROM lineitem GROUP BY 1),
r AS (SELECT l_returnflag, m, b, l_extendedprice::DOUBLE - m * l_quantity::DOUBLE - b AS e FROM lineitem JOIN s USING (l_returnflag))
SELECT l_returnflag, round(any_value(m), 6) AS slope, round(any_value(b), 6) AS intercept, round(quantile_cont(e, 0.95) FILTER (e > 0), 4) AS hi, round(quantile_cont(e, 0.05) FILTER (e < 0), 4) AS lo FROM r GROUP BY 1""")
def ols_residual_cut(spark, sf_dir):
    li = _read(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_quantity").cast("double").alias("x"), F.col("l_extendedprice").cast("double").alias("y"))
    fit = li.groupBy("l_returnflag").agg(F.regr_slope("y", "x").alias("m"), F.regr_intercept("y", "x").alias("b"))
    e = F.col("y") - F.col("m") * F.col("x") - F.col("b")
    rows = li.join(fit, "l_returnflag").withColumn("e", e)
    cut = lambda c, p: F.round(F.percentile(F.when(c, F.col("e")), F.lit(p)), 4)
    return rows.groupBy("l_returnflag").agg(r6(F.first("m")).alias("slope"), r6(F.first("b")).alias("intercept"), cut(F.col("e") > 0, 0.95).alias("hi"), cut(F.col("e") < 0, 0.05).alias("lo"))


@query(f"""WITH {_LONG}, p AS (SELECT vec_id, any_value(label) AS label, max(v) FILTER (i = 1) AS x, max(v) FILTER (i = 2) AS y FROM e GROUP BY 1),
m AS (SELECT *, x - avg(x) OVER w AS u, y - avg(y) OVER w AS v, avg(x) OVER w AS mx, avg(y) OVER w AS my FROM p WINDOW w AS (PARTITION BY label)),
s AS (SELECT label, count(*) AS n, any_value(mx) AS mx, any_value(my) AS my, sum(u * u) AS uu, sum(v * v) AS vv, sum(u * v) AS uv, sum(u * (u * u + v * v)) AS uz, sum(v * (u * u + v * v)) AS vz FROM m GROUP BY 1),
c AS (SELECT *, (uz * vv - vz * uv) / (2 * (uu * vv - uv * uv)) AS a, (vz * uu - uz * uv) / (2 * (uu * vv - uv * uv)) AS b FROM s)
SELECT label, round(mx + a, 6) AS xc, round(my + b, 6) AS yc, round(sqrt(a * a + b * b + (uu + vv) / n), 6) AS r FROM c""")
def circle_fit(spark, sf_dir):
    x = S.doubles("embedding")
    points = _read(spark, sf_dir, "embeddings").select("label", F.get(x, F.lit(0)).alias("x"), F.get(x, F.lit(1)).alias("y"))
    return T.circle(points, ["label"], "x", "y").select("label", r6("xc").alias("xc"), r6("yc").alias("yc"), r6("r").alias("r"))


@query("""WITH u AS (SELECT page_id, regexp_extract(url, '://([^/?#]*)', 1) AS host, regexp_extract(url, '://[^/?#]*(/[^?#]*)', 1) AS path FROM pages)
SELECT page_id, host, split_part(path, '/', 2) AS k1, try_cast(regexp_extract(split_part(path, '/', 3), '^([0-9]+)', 1) AS INT) AS k2 FROM u""")
def name_parse(spark, sf_dir):
    host, path = F.regexp_extract("url", r"://([^/?#]*)", 1), F.regexp_extract("url", r"://[^/?#]*(/[^?#]*)", 1)
    key = lambda i: F.coalesce(F.get(F.split("path", "/"), F.lit(i)), F.lit(""))
    rows = _read(spark, sf_dir, "pages").select("page_id", host.alias("host"), path.alias("path"))
    return rows.select("page_id", "host", key(1).alias("k1"), F.regexp_extract(key(2), r"^([0-9]+)", 1).try_cast("int").alias("k2"))


@query("SELECT p_partkey, p_name FROM part WHERE (contains(p_name, 'a') OR contains(p_name, 'e')) AND NOT (contains(p_name, '1') OR contains(p_name, '7'))")
def substring_match(spark, sf_dir):
    has = lambda *s: F.array_contains(F.array(*[F.contains(F.col("p_name"), F.lit(x)) for x in s]), True)
    return _read(spark, sf_dir, "part").where(has("a", "e") & ~has("1", "7")).select("p_partkey", "p_name")


@query("""WITH h AS (SELECT l_returnflag, l_linestatus, avg(l_quantity::DOUBLE) - 25 AS obs FROM lineitem GROUP BY 1, 2),
n AS (SELECT l_returnflag, l_linestatus, l_suppkey, avg(l_quantity::DOUBLE) - 25 AS v FROM lineitem GROUP BY 1, 2, 3)
SELECT l_returnflag, l_linestatus, round(any_value(obs), 6) AS obs, CASE WHEN any_value(obs) >= 0 THEN round(avg((v >= obs)::INT), 6) ELSE 1.0 END AS p FROM h JOIN n USING (l_returnflag, l_linestatus) GROUP BY 1, 2""")
def perm_pvalue(spark, sf_dir):
    li, key = _read(spark, sf_dir, "lineitem").withColumn("q", F.col("l_quantity").cast("double")), ["l_returnflag", "l_linestatus"]
    observed = li.groupBy(*key).agg((F.avg("q") - 25).alias("obs"))
    null = li.groupBy(*key, "l_suppkey").agg((F.avg("q") - 25).alias("null_value")).drop("l_suppkey")
    return T.permutation_p(observed, null, key).select(*key, r6("obs").alias("obs"), r6("p").alias("p"))
