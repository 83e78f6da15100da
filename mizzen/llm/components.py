"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import cut, removed, stored

#: Edges of a vertex from which on it counts as hot, and the parts its edges are then dealt into.
HOT, SALTS = 2_000, 64
#: Hot vertices up to which their list is broadcast, 8 bytes each.
BROADCAST_HOT = 1_000_000


def _with_least(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) with ``m``, the least of u and all its v.

    The minimum is aggregated before the shuffle and joined back. Only vertices with more than ``HOT``
    edges have their edges dealt by a salt and their minimum copied to every salt.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("v"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "v").alias("m"), "n")
    hot = cut(least.where(F.col("n") > HOT).select("u"))
    n_hot = hot.count()
    if not n_hot:
        return edges.join(least.select("u", "m"), "u")
    marks = hot.withColumn("hot", F.lit(True))
    dealt = F.when(F.col("hot"), F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).otherwise(0).alias("salt")
    salted = edges.join(F.broadcast(marks) if n_hot <= BROADCAST_HOT else marks, "u", "left").select("u", "v", dealt)
    copies = least.where(F.col("n") > HOT).select("u", "m", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return salted.join(least.where(F.col("n") <= HOT).select("u", "m", F.lit(0).alias("salt")).unionByName(copies), ["u", "salt"]).drop("salt")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = _with_least(edges)
    moved = down.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(down.select("u", F.col("m").alias("v"))).distinct()


def connected_components(pairs: DataFrame) -> DataFrame:
    """Rows (vertex, component) for the vertices of ``pairs`` (columns a, b): the least vertex reachable.

    Each half round is written and its predecessor deleted, so a lost executor costs at most that
    half and the folder holds two of them. Pairs with a null end are ignored; without pairs the
    result is empty.
    """
    spark = pairs.sparkSession
    ends = pairs.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    (edges, path), seen = stored(ends.distinct()), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        for star in (_large_star, _small_star):
            (edges, later), old = stored(star(edges)), path
            removed(spark, old)
            path = later
    roots = edges.select(F.col("v").alias("vertex")).distinct()
    members = edges.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
    return members.unionByName(roots.select("vertex", F.col("vertex").alias("component")))
