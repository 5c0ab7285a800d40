"""Connected components of links between keys, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fieldledger.llm.store import keep


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``key`` and ``component`` (the smallest key reachable) for every key in ``links`` (``a``, ``b``).

    Each round joins every neighbour to the smallest one around a key, first the larger neighbours, then the
    smaller ones, until each component is a star. A hub's neighbours are reduced to their minimum on the map side and the
    minimum is joined back, which adaptive execution splits. Each round's links are written to the shared folder; the
    driver sees two numbers a round.
    """
    edges = keep(_oriented(links), "links")
    before = None
    for _ in range(most_rounds):
        large = keep(_star(edges, larger=True), "links")
        edges = keep(_star(large, larger=False), "links")
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (state["n"], state["h"]) == before:
            break
        before = (state["n"], state["h"])
    else:
        raise RuntimeError(f"links have not settled after {most_rounds} rounds")
    roots = edges.select(F.col("b").alias("key")).distinct()
    return edges.select(F.col("a").alias("key"), F.col("b").alias("component")).unionByName(
        roots.select("key", F.col("key").alias("component"))
    )


def _oriented(links: DataFrame) -> DataFrame:
    """Links from the larger to the smaller key, once each."""
    return links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Link the larger (or the smaller) neighbours of each key, and itself, to the smallest key around."""
    if larger:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges  # a's smaller neighbours
    # Written first: a join straight on an aggregate of the same key could not split a hub.
    least = keep(both.groupBy(F.col("a").alias("_a")).agg(F.min("b").alias("_least")), "least")
    joined = both.join(least, both["a"] == least["_a"])
    root = F.least("a", "_least")
    if larger:
        moved = joined.where("b > a").select(F.col("b").alias("a"), root.alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), root.alias("b")).unionByName(
            joined.select("a", root.alias("b"))
        )
    return moved.where("a <> b").distinct()
