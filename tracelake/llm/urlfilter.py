"""URL rules: host-suffix and path-prefix expressions, joined on short hash prefixes. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits of the digest that are joined on; the rest is compared after.
SHORT = 8
#: Rules are broadcast up to this many; beyond, both sides are shuffled by the short prefix.
BROADCAST_RULES = 100_000
#: (host and path, verdict). Fixed values of the query.
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to / ? # or the end, A-Z lower-cased; path: then up to ? or #. Null, or no ://: both empty."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1)
    return host, path


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Each row of pages with host, path, rule (its host and path, null if none fits) and verdict.

    rules: rule (host, then a path that begins with /) and verdict. A rule fits its host and all subdomains if the path
    starts with the rule's. The longest rule wins; of equally long ones that with the longer host, then block. Rows that no
    rule fits get `default`. A rule that is null, or lacks a host or path, fits nothing; repeated rules count once.

    Every distinct (host, path) is judged once: it is expanded into each suffix of the host's labels with each prefix of
    the path that is as long as some rule's path; the expressions meet the rules by the first digits of their SHA-256, and
    the full digests are compared. The verdicts return to the pages by an equi-join on host and path, so that a hot host is
    split by its paths; pages without a host or path fit no rule and take no part in it. Null urls have an empty host and
    path. Columns of pages named host, path, rule or verdict are replaced.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host, "path": path})
    cut_at = F.instr("rule", "/")
    known = (
        rules.where(cut_at > 1)
        .groupBy("rule")
        .agg(F.max("verdict").alias("verdict"))
        .select("rule", "verdict", (cut_at - 1).alias("host_length"), (F.length("rule") - cut_at + 1).alias("path_length"), F.sha2(F.col("rule"), 256).alias("digest"))
        .withColumn("short", F.substring("digest", 1, SHORT))
    )
    # The different lengths of the rules' paths: few, whatever the number of rules, and at most the longest path's length.
    lengths = [r.path_length for r in known.select("path_length").distinct().orderBy("path_length").collect()]
    known = F.broadcast(known) if rules.count() <= BROADCAST_RULES else known
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.array_distinct(F.transform(F.array(*map(F.lit, lengths)) if lengths else F.array().cast("array<int>"), lambda n: F.when(n <= F.length("path"), F.substring(F.col("path"), F.lit(1), n))))
    judged = (F.col("host") != "") & (F.col("path") != "")
    urls = rows.where(judged).groupBy("host", "path").agg(F.lit(1).alias("_one"))
    expressions = (
        urls.select("host", "path", F.explode(F.array_compact(prefixes)).alias("prefix"), suffixes.alias("suffixes"))
        .select("host", "path", "prefix", F.explode("suffixes").alias("suffix"))
        .select("host", "path", F.sha2(F.concat("suffix", "prefix"), 256).alias("seen"))
        .withColumn("seen_short", F.substring("seen", 1, SHORT))
    )
    fits = expressions.join(known, (F.col("seen_short") == F.col("short")) & (F.col("seen") == F.col("digest")))
    best = F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "host_length", F.col("verdict") == "block")).alias("best")
    verdicts = fits.groupBy("host", "path").agg(best).select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    found = rows.where(judged).join(verdicts, ["host", "path"], "left").select(*rows.columns, "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
    rest = rows.where(~judged).select(*rows.columns, F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    return found.unionByName(rest)


def default_rules(spark) -> DataFrame:
    return spark.createDataFrame(RULES, "rule string, verdict string")
