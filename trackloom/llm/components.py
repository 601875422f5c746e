"""Connected components of a graph that is given by its links.

Every round hangs each node's larger neighbours, and then its smaller ones, on the smallest node it knows
(large star, small star) until nothing changes; the number of rounds grows with the logarithm of the longest
chain. A node's neighbours are never gathered: its smallest one is an aggregate, which comes back by a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.storage import stored


def _hung(links: DataFrame, both: bool) -> DataFrame:
    """One star step over links ``u > v``."""
    near = links
    if both:
        near = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = near.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_m"))
    joined = near.join(least, F.col("u") == F.col("_u"))
    if both:  # larger neighbours go to the smallest node known, this one included
        moved = joined.where("v > u").select(F.col("v").alias("u"), F.least("u", "_m").alias("v"))
        return moved.distinct()
    # smaller neighbours and the node itself go to the smallest neighbour
    moved = joined.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("_m").alias("v")), F.struct("u", F.col("_m").alias("v")))).alias("_l"))
    return moved.select("_l.*").where("u > v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """``node, component``: the smallest node that each linked node can reach, itself included.

    Direction, repeats and self-links don't matter; links with a null end are ignored. A node without a link to
    another has no row. Fails if the rounds don't end, which takes chains beyond 2**most_rounds.
    """
    now = stored(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    mark = F.struct(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"))
    seen = now.select(mark.alias("m")).first()["m"]
    for _ in range(most_rounds):
        now = stored(_hung(_hung(now, True), False))
        mark_now = now.select(mark.alias("m")).first()["m"]
        if mark_now == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        seen = mark_now
    raise RuntimeError(f"components not settled after {most_rounds} rounds")
