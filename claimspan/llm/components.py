"""Connected components of a graph that is given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from claimspan.llm.common import discard, written


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node with the least of the node and its neighbours."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each smaller neighbour of a node, and the node, with the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (id, label) after links (a, b) between the labels: each label moves to the least one it is linked with.

    One step only, so labels that are connected by longer chains may stay apart; equal labels are always connected.
    """
    least = links.groupBy(F.greatest("a", "b").alias("label")).agg(F.min(F.least("a", "b")).alias("to"))
    return labels.join(least, "label", "left").select("id", F.coalesce("to", "label").alias("label"))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) of each node that has an edge; ``component`` is the least id it is connected with.

    ``edges`` has two long columns; repeated edges, loops and nulls do no harm. Alternates large and
    small stars, whose minima fold before the shuffle, so a hub with very many neighbours is one row
    per task; the rounds grow with the logarithm of the longest chain. Each round is written to the
    shared folder.
    """
    a, b = edges.columns[:2]
    now = written(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct(), name)
    before = None
    while True:
        last, now = now, written(_small_star(_large_star(now)), name)
        discard(last)
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            break
        before = state
    least = now.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    found = now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(least)
    found.written_to = now.written_to  # for ``discard``
    return found
