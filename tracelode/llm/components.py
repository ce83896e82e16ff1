"""Connected components of an edge table by alternating large and small stars.

Each round, every node first points its larger neighbours at the smallest one it knows, then its
smaller neighbours; when a round changes nothing every node points at the smallest of its
component. All of it is grouping and joining, no adjacency list is ever gathered. The neighbour
minima are written before they are joined, so both join sides are plain exchanges and a node with
very many neighbours is split over tasks by the skew handling of the adaptive planner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelode.llm.common import cut


def _print_of(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)),
            F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)),
        ).first()
    )


def connected_components(edges: DataFrame, most_rounds: int = 200) -> DataFrame:
    """(node, root) for every node that has an edge to another node; root is the component's smallest.

    `edges` has long columns u and v, in any direction; repeated edges, loops and rows with nulls
    do no harm; an empty table gives an empty one. Rounds grow with the logarithm of the longest
    chain; running out of `most_rounds` raises.
    """
    now = cut(
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    seen = _print_of(now)
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = (
            both.join(least.hint("merge"), "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = cut(large)
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(lowest.select("u", F.col("m").alias("v")))
            .distinct()
        )
        now = cut(small)
        if (found := _print_of(now)) == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        seen = found
    raise RuntimeError(f"no fixed point after {most_rounds} rounds")
