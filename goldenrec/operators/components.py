"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldenrec.session import materialize


def _least(edges: DataFrame, far: bool) -> DataFrame:
    """One star step over edges (u, v), u > v. ``far``: every node's larger
    neighbours move to its least neighbour; else its smaller ones do."""
    both = edges.select("u", "v")
    if far:
        both = both.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Not a window: the minimum is taken before the shuffle. Written, so that
    # both sides of the join are exchanges of their own and a hot centre's
    # partition can be split.
    low = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "components")
    moved = both.join(low, "u")
    if far:
        moved = moved.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = moved.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))
    return moved.filter(F.col("u") > F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns u, v of one orderable
    type, any direction, repeats and loops allowed) that is not a root; root is
    the least node of its component. NULL ends are left out.

    Each round is written to the shared folder, so lineage stays short and a
    lost executor costs one round. Rounds grow with the logarithm of the
    component size; they end when a round changes nothing.
    """
    now = materialize(edges.filter(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "components")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = tuple(state)
        now = materialize(_least(materialize(_least(now, True), "components"), False), "components")
