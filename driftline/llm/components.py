"""Connected components by alternating stars, distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, remove


#: Parts to which the neighbours of a node are dealt.
SALTS = 16


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", most: int = 60) -> DataFrame:
    """(node, component): the smallest node that each node of ``edges`` reaches.

    Large-star links every larger neighbour to the smallest neighbour, small-star every smaller one; the edges shrink to stars
    in a logarithmic number of rounds. Each round is written to the shared folder. Self-loops and nulls are ignored, so a node without
    other edges is absent. Empty edges give an empty result.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(f"{a} is not null and {b} is not null and {a} <> {b}").distinct()
    held: list[str] = []
    e = materialize(e, "edges", held)
    for _ in range(most):
        if _settled(e):
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # repeated edges go at the end of the round; there are two for each of its start at most
        large = _with_least(both.where("v > u"), low).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _with_least(large, low)
        done = list(held)
        held.clear()
        e = materialize(small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges", held)
        remove(e.sparkSession, done)
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _with_least(edges: DataFrame, low: DataFrame) -> DataFrame:
    """(u, v, m): edges (u, v) with what ``low`` (u, m) has for u. The middle of a star has many edges: they are dealt by a salt, and its row goes to all salts."""
    spread = low.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(spread, ["u", "salt"]).drop("salt")


def _settled(e: DataFrame) -> bool:
    """Whether the edges are stars: every larger end has one edge, and no smaller end is a larger one."""
    ends = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(e.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    seen = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not seen.where("up > 1 or (up = 1 and down = 1)").limit(1).count()
