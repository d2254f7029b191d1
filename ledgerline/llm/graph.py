"""Connected components of an edge table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.store import stored


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label) for each node of an edge; label is the smallest node that it reaches.

    Each round every root takes its smallest neighbouring root, chains of such steps are shortened by doubling, and the edges
    are renamed to the new roots; edges inside a root go. At least half of the roots that still have an edge go each round.
    Edges with a null end are left out. Minima are written before they are joined, so that a hub's rows can be split.
    """
    left = stored(
        edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v").distinct(), "edges"
    )
    labels = stored(
        left.select(F.explode(F.array("u", "v")).alias("node")).distinct().select("node", F.col("node").alias("label")),
        "labels",
    )
    while not left.isEmpty():
        both = left.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        least = both.select("col.*").groupBy("u").agg(F.min("v").alias("v"))
        parents = stored(least.select(F.col("u").alias("root"), F.least("u", "v").alias("parent")), "parents")
        while True:
            up = parents.select(F.col("root").alias("parent"), F.col("parent").alias("next"))
            jumped = parents.join(up, "parent").select("root", "parent", "next")
            if jumped.where("next < parent").isEmpty():
                break
            parents = stored(jumped.select("root", F.col("next").alias("parent")), "parents")
        labels = stored(
            labels.join(parents, F.col("label") == F.col("root"), "left").select(
                "node", F.coalesce("parent", "label").alias("label")
            ),
            "labels",
        )
        left = stored(
            left.join(parents.select(F.col("root").alias("u"), F.col("parent").alias("pu")), "u")
            .join(parents.select(F.col("root").alias("v"), F.col("parent").alias("pv")), "v")
            .select(F.col("pu").alias("u"), F.col("pv").alias("v"))
            .where("u <> v")
            .distinct(),
            "edges",
        )
    return labels
