"""Points inside closed meshes of triangles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _crosses(y: Column, z: Column, a: str, b: str) -> Column:
    """Whether the ray to greater y from (y, z) crosses the edge between two corners; computed alike for both triangles of an edge."""
    up = (F.col(f"z{a}") < F.col(f"z{b}")) | ((F.col(f"z{a}") == F.col(f"z{b}")) & (F.col(f"y{a}") <= F.col(f"y{b}")))
    low = lambda c: F.when(up, F.col(f"{c}{a}")).otherwise(F.col(f"{c}{b}"))
    high = lambda c: F.when(up, F.col(f"{c}{b}")).otherwise(F.col(f"{c}{a}"))
    between = (low("z") <= z) & (z < high("z"))
    return F.when(between, y < low("y") + (high("y") - low("y")) * (z - low("z")) / (high("z") - low("z"))).otherwise(False)


def inside(points: DataFrame, triangles: DataFrame, mesh: str, key: str, cell: float) -> DataFrame:
    """(mesh, key, inside) of each point: whether a ray from it to greater x leaves its mesh an odd number of times.

    points: mesh, key, x, y, z; triangles: mesh, x1, y1, z1 to x3, y3, z3, a closed surface for each mesh. Triangles are sent to
    the cells of side `cell` in y and z that their box touches, points to their own, so only those that may meet do. A point
    whose ray runs through an edge or corner belongs to one of the triangles there; one on the surface may count either way. A
    point with a missing coordinate, or of an unknown mesh, is outside. One row for each point.
    """
    axis = lambda c: [F.col(f"{c}{i}") for i in (1, 2, 3)]
    at = lambda v: F.floor(v / cell)
    spread = triangles.withColumn("_cy", F.explode(F.sequence(at(F.least(*axis("y"))), at(F.greatest(*axis("y"))))))
    spread = spread.withColumn("_cz", F.explode(F.sequence(at(F.least(*axis("z"))), at(F.greatest(*axis("z"))))))
    own = points.select(mesh, key, "x", "y", "z", at(F.col("y")).alias("_cy"), at(F.col("z")).alias("_cz"))
    met = own.join(spread, [mesh, "_cy", "_cz"])
    y, z = F.col("y"), F.col("z")
    odd = _crosses(y, z, "1", "2") != _crosses(y, z, "2", "3")
    odd = odd != _crosses(y, z, "3", "1")
    # The plane's x above (y, z).
    side = lambda a, b: (F.col(f"y{a}") - F.col("y1")) * (F.col(f"z{b}") - F.col("z1"))
    det = side(2, 3) - side(3, 2)
    u = F.try_divide((y - F.col("y1")) * (F.col("z3") - F.col("z1")) - (F.col("y3") - F.col("y1")) * (z - F.col("z1")), det)
    v = F.try_divide((F.col("y2") - F.col("y1")) * (z - F.col("z1")) - (y - F.col("y1")) * (F.col("z2") - F.col("z1")), det)
    hit = F.col("x1") + u * (F.col("x2") - F.col("x1")) + v * (F.col("x3") - F.col("x1"))
    hits = met.where(odd & (hit > F.col("x"))).groupBy(mesh, key).agg(F.count("*").alias("_n"))
    return points.select(mesh, key).join(hits, [mesh, key], "left").select(mesh, key, (F.coalesce("_n", F.lit(0)) % 2 == 1).alias("inside"))
