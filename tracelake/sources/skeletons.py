"""Skeletons of cells: text files of nodes, one line each (id, kind, x, y, z, radius, parent; -1 for no parent; # begins a comment)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names of trees: the file's name without its ending, or what the writer below makes of it.
NAME = r"(?:tree=([^/]+)/[^/]+|([^/]+?)(?:\.[^./]*)?)$"
FIELDS = {"node": "long", "kind": "int", "x": "double", "y": "double", "z": "double", "radius": "double", "parent": "long"}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = F.trim(F.regexp_replace(F.regexp_replace("value", "#.*", ""), r"\s+", " "))
    rows = spark.read.option("recursiveFileLookup", True).text(path)
    # Paths come encoded, names of folders that Spark made twice; a plus stands for itself.
    part = lambda i: F.nullif(F.regexp_extract(F.col("_metadata.file_path"), NAME, i), F.lit(""))
    plain = lambda c: F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    parts = rows.select(F.coalesce(plain(plain(part(1))), plain(part(2))).alias("tree"), F.split(text, " ").alias("f")).where("f[0] <> ''")
    at = lambda i, kind: F.get("f", F.lit(i)).try_cast(kind)
    made = parts.select("tree", *[at(i, kind).alias(name) for i, (name, kind) in enumerate(FIELDS.items())], (F.size("f") >= len(FIELDS)).alias("full"))
    bad = ~F.col("full") | F.greatest(*[F.col(c).isNull().cast("int") for c in FIELDS]).cast("boolean")
    return made.select("tree", *FIELDS, bad.alias("bad")).withColumn("parent", F.when(F.col("parent") >= 0, F.col("parent")))


def _checked(lines: DataFrame) -> DataFrame:
    """A row for each tree: its lines and what is wrong with it, null if nothing is."""
    known = lines.groupBy("tree", F.col("node").alias("parent")).agg(F.count("*").alias("_n"))
    sums = lines.groupBy("tree").agg(F.count("*").alias("n_lines"), F.sum(F.col("bad").cast("long")).alias("bad"), F.sum(F.when(F.col("parent").isNull(), 1).otherwise(0)).alias("roots"))
    twice = known.where("_n > 1 AND parent IS NOT NULL").select("tree", F.lit(True).alias("twice")).distinct()
    lost = lines.where("parent IS NOT NULL").join(known, ["tree", "parent"], "left_anti").select("tree", F.lit(True).alias("lost")).distinct()
    why = F.when(F.col("bad") > 0, "line").when(F.col("twice"), "repeated node").when(F.col("lost"), "unknown parent").when(F.col("roots") != 1, "roots")
    return sums.join(twice, "tree", "left").join(lost, "tree", "left").select("tree", "n_lines", why.alias("why"))


def skeletons(spark: SparkSession, path: str) -> DataFrame:
    """Nodes of the skeletons at path (a file, a folder to any depth or a glob): tree, node, kind, x, y, z, radius, parent (null: root).

    A skeleton with a line that isn't seven numbers (more fields are ignored), a node twice, an unknown parent, or no or several
    roots is left out whole, as `rejected` lists. Lines without anything but comments count for nothing; a file without
    nodes has no rows. Files of one name are one skeleton.
    """
    lines = _lines(spark, path)
    good = _checked(lines).where("why IS NULL").select("tree")
    return lines.join(good, "tree", "left_semi").drop("bad")


def rejected(spark: SparkSession, path: str) -> DataFrame:
    """(tree, n_lines, why) of the skeletons that `skeletons` leaves out: line, repeated node, unknown parent or roots, the first that holds."""
    return _checked(_lines(spark, path)).where("why IS NOT NULL")


def write_skeletons(nodes: DataFrame, path: str) -> None:
    """Write nodes as text, a folder tree=<name> for each tree, in which its lines are in order of nodes. Fields that are null are written as -1."""
    line = F.concat_ws(" ", *[F.coalesce(F.col(c).cast(kind).cast("string"), F.lit("-1")) for c, kind in FIELDS.items()])
    nodes.repartition("tree").sortWithinPartitions("tree", "node").select("tree", line.alias("value")).write.partitionBy("tree").text(path)


def write_table(df: DataFrame, path: str) -> None:
    """Write a table as tab-separated text with a header in each part; nulls are empty fields."""
    df.write.csv(path, sep="\t", header=True)
