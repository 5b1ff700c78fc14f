"""Connected components of an edge list, as joins and aggregates.

Large-star and small-star rounds alternate (Kiveris et al., "Connected Components in MapReduce and
Beyond", 2014): every node hands its smallest known neighbour to its larger neighbours, then to the
smaller ones. Smallest neighbours are plain aggregates that Spark combines before the shuffle, and
they come back to the edges in a join: written first, so that Spark can split the edges of a node with very many
of them. Each round is a table in the shared folder, and the tables of the round before are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.common import remove_folders, written
from eventlake.sources.scratch import new_folder


def downward(edges: DataFrame) -> DataFrame:
    """Edges as (high, low), each once, without loops."""
    return edges.select(
        F.greatest("high", "low").alias("high"), F.least("high", "low").alias("low")
    ).where("high <> low").distinct()


def large_star(edges: DataFrame, folder: str, name: str) -> DataFrame:
    both = edges.select(F.col("high").alias("node"), F.col("low").alias("near")).unionAll(
        edges.select(F.col("low").alias("node"), F.col("high").alias("near"))
    )
    least = written(both.groupBy("node").agg(F.min(F.least("near", "node")).alias("least")), folder, name)
    # Only the larger neighbours of a node are moved.
    return downward(
        edges.select(F.col("low").alias("node"), "high").join(least, "node").select("high", F.col("least").alias("low"))
    )


def small_star(edges: DataFrame, folder: str, name: str) -> DataFrame:
    least = written(edges.groupBy("high").agg(F.min("low").alias("least")), folder, name)
    moved = edges.join(least, "high").select(F.col("low").alias("high"), F.col("least").alias("low"))
    return downward(moved.unionAll(least.select("high", F.col("least").alias("low"))))


def signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; the root is the smallest node of its component.

    `edges` has two columns of one ordered type; loops, repeats and either direction are fine.
    """
    first, second = edges.columns
    folder = new_folder(edges.sparkSession, "components")
    current = written(downward(edges.select(F.col(first).alias("high"), F.col(second).alias("low"))), folder, "edges-0")
    seen, turn = signature(current), 0
    while seen[0]:
        turn += 1
        large = written(large_star(current, folder, f"large-{turn}"), folder, f"stars-{turn}")
        current = written(small_star(large, folder, f"small-{turn}"), folder, f"edges-{turn}")
        remove_folders(edges.sparkSession, folder, f"edges-{turn - 1}", f"large-{turn}", f"stars-{turn}", f"small-{turn}")
        now = signature(current)
        if now == seen:
            break
        seen = now
    # All edges are now (member, root).
    return current.select(F.col("high").alias("node"), F.col("low").alias("root")).unionAll(
        current.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    )
