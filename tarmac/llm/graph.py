"""Connected components of an edge table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import written


def components(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """id, comp for every end of an edge (columns a, b, not null); comp is the smallest id of its component.

    Each round maps every node to its smallest neighbour's choice, puts the choices for the ends
    of the edges and drops what has become a loop, so the table of edges shrinks and stars are
    done in one round. Nothing is collected; all rounds are written.
    """
    left = written(edges.filter("a <> b").select("a", "b").distinct(), folder, f"{name}-edges")
    nodes = left.select(F.col("a").alias("id")).union(left.select("b")).distinct()
    labels = written(nodes.withColumn("comp", F.col("id")), folder, f"{name}-labels")
    round_ = 0
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        choice = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("to"))
        choice = written(choice, folder, f"{name}-choice{round_}")
        # the choice of the choice; a node that chose itself ends there
        jump = choice.select(F.col("node").alias("to"), F.col("to").alias("further"))
        choice = written(
            choice.join(jump, "to").select("node", F.least("to", "further").alias("to")), folder, f"{name}-jump{round_}")
        at = choice.withColumnRenamed("node", "comp")
        labels = written(
            labels.join(at, "comp", "left").select("id", F.coalesce("to", "comp").alias("comp")), folder, f"{name}-labels{round_}")
        moved = left.join(choice.select(F.col("node").alias("a"), F.col("to").alias("to_a")), "a").join(
            choice.select(F.col("node").alias("b"), F.col("to").alias("to_b")), "b")
        left = written(
            moved.filter("to_a <> to_b").select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(),
            folder, f"{name}-edges{round_}")
        round_ += 1
    return labels
