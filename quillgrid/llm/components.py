"""Connected components by alternating large and small stars, all in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.llm import _store


def _large(e: DataFrame) -> DataFrame:
    """Links each node's larger neighbours to its least neighbour (or itself)."""
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small(e: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours to the least of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    over = e.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
    return over.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of edges (a, b), root being the least node of its component.

    Loops and repeated links do no harm, links to null count for nothing; no links
    give no rows. A round's links are never more than before it but for one a node.
    Minima are pre-aggregated before the shuffle, so a hub isn't gathered anywhere.
    Each round is written to the shared folder.
    """
    e = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, before = _store.keep(e, "links"), None
    for _ in range(rounds):
        mark = e.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"), F.bit_xor(F.xxhash64("v", "u")).alias("y")).first()
        if mark == before or not mark.n:
            break
        before, done = mark, e
        e = _store.keep(_small(_large(e)), "links")
        _store.forget(done)
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.withColumn("root", F.col("node")))
