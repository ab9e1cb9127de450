"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataroll.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (``a bigint, b bigint``): the label is a node of its component.

    Each round orders nodes by a new hash, sends each to its smallest neighbour if that is smaller,
    and rewrites the links. A constant part of the nodes goes in each round on average, whatever
    the shape. Rounds are written to the shared folder; no links or labels reach the driver.
    """
    moves: list[DataFrame] = []
    while True:
        links = saved(links.filter("a != b").distinct(), "links")
        if links.isEmpty():
            break
        order = lambda c: F.xxhash64(F.col(c), F.lit(len(moves)))  # noqa: B023, E731
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min(F.struct(order("b").alias("rank"), F.col("b"))).alias("least"))
        lower = F.col("least.rank") < order("a")
        move = least.select(F.col("a").alias("node"), F.when(lower, F.col("least.b")).otherwise(F.col("a")).alias("to"))
        moves.append(saved(move, "moves"))
        a, b = (moves[-1].select(F.col("node").alias(c), F.col("to").alias(f"{c}_to")) for c in "ab")
        links = links.join(a, "a").join(b, "b").select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
    if not moves:
        return links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    labels = moves[0].withColumnRenamed("to", "label")
    for move in moves[1:]:
        step = move.select(F.col("node").alias("label"), "to")
        labels = labels.join(step, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return saved(labels, "labels")
