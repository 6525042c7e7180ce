"""Connected components of a link table, by alternating star contractions.

A large-star step links every larger neighbour of a node to the smallest node of its neighbourhood, a small-star step
does the same for the node itself and its smaller neighbours. The links turn into stars around each component's smallest
node after about log(n) rounds. Neighbourhoods are never collected: their minimum is an aggregate that is joined back,
so a node with very many links is one more row, and adaptive execution can split its join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlode.session import materialize


def _star(edges: DataFrame, small: bool) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if small:
        near = both.where("b < a")
        least = near.groupBy("a").agg(F.min("b").alias("m"))
        linked = near.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        linked = linked.unionByName(least.select("a", F.col("m").alias("b")))
    else:
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
        linked = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.where("a <> b").distinct()


def components(edges: DataFrame, label: str = "components", most_rounds: int = 60) -> DataFrame:
    """Node and component (its smallest node) for each node of ``edges`` (a long, b long; any order, repeats allowed).

    Nodes without a link don't appear; null ends and self-links are ignored. An empty table gives an empty table.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now = materialize(now, label)
    before = None
    for _ in range(most_rounds):
        now = materialize(_star(_star(now, small=False), small=True), label)
        # Stars that no longer change: as many links, and the same sums of their ends.
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before == state:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    own = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(own)
