"""Connected components of an edge list as Spark joins.

Alternating large-star and small-star steps turn any edge list into stars
around the smallest vertex of each component. A step only needs each vertex's
smallest neighbour (a grouped minimum, combined before the shuffle), so no
neighbour list is ever gathered. The edges are checkpointed after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(vertex, root) for every vertex that has an edge to another vertex;
    ``root`` is the smallest vertex of its component. Loops, nulls and
    repeated edges are ignored; no edges give no rows. Runs one job per round.
    """
    checkpoint_dir(edges.sparkSession)
    star = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
            .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct())
    star = star.checkpoint()
    before = _state(star)
    while before[0]:
        both = star.union(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where(F.col("v") != F.col("m"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).distinct())
        star = small.checkpoint()
        now = _state(star)
        if now == before:
            break
        before = now
    return (star.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
            .union(star.select(F.col("v").alias("vertex"), F.col("v").alias("root")).distinct()))


def _state(star: DataFrame) -> tuple:
    r = star.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r.n, r.x
