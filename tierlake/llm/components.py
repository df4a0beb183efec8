"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .work import stored

#: Edges in a file of a round.
PART = 200_000


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b); the label is the smallest node reachable.

    Each round writes the edges to the shared folder, so lineage stays short. A star of any size is a minimum per
    node, combined in map tasks, and a join whose large side Spark can split. Rounds grow with the logarithm of the
    longest path.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if state == before:
            break
        before = state
        parts = -(-state[0] // PART) or 1  # rounds never add edges

        def kept(df: DataFrame, name: str) -> DataFrame:
            return stored(df.coalesce(parts), name)

        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("m"))
        least = kept(least, "least")  # beside a read table Spark can split a large star
        large = both.join(least, F.col("a") == F.col("c")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = kept(large.distinct(), "edges")
        least = kept(large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "c"), "least")
        small = large.join(least, F.col("a") == F.col("c"))
        turned = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = kept(turned.unionAll(least.select(F.col("c").alias("a"), F.col("m").alias("b"))).distinct(), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
