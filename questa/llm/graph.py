"""Connected components by alternating large-star and small-star steps.

Each step is a grouped minimum (combined before the shuffle) and an equi-join
back to the edges, so no node's neighbours are ever gathered in one place.
The number of rounds grows with the logarithm of the longest path.  Each round
is written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: A hub's edges are dealt to this many tasks when its minimum is joined back.
SALTS = 8


def _join_min(edges: DataFrame, low: DataFrame) -> DataFrame:
    """``edges`` (u, v) with ``m`` of their ``u``; a hot ``u`` is salted."""
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    copies = low.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, ["u", "salt"]).drop("salt")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (_join_min(both, low).filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = _join_min(down, low).filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return low.select("u", F.col("m").alias("v")).union(moved).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of at least one edge between two different
    nodes; ``root`` is the smallest node reachable.  Edges with a null end and
    loops are left out.  Empty input gives an empty result."""
    e = (edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
         .filter("u IS NOT NULL AND v IS NOT NULL AND u != v").distinct())
    e = stored(e, "edges")
    seen = None
    while True:
        mark = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if seen == tuple(mark):
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        seen = tuple(mark)
        e = stored(_small_star(_large_star(e)), "star")
