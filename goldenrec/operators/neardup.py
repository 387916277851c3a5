"""Near-duplicate clusters of short identity strings.

Two values are neighbours when their edit distance is exactly 1; clusters
are the connected components of that relation (single linkage). The method
is exact and never forms all pairs inside a block:

* Exact duplicates are collapsed first: the graph has one node per distinct
  value.
* Substitution neighbours agree everywhere except one position ``i``, so
  deleting position ``i`` from both gives the same string. Nodes are grouped
  by (string with position i deleted, i); every member of such a group is a
  neighbour of every other, and a group holds at most one value per symbol
  of the alphabet. Each member is linked to the group's smallest value (a
  star, not a clique); the star spans the same component.
* Insertion/deletion neighbours: some deletion of the longer value equals the
  shorter value itself. Joining deletion variants with the node set emits
  one edge per matching variant (at most ``len(value)`` per node).
* Components: alternating stars over the edges (``operators/components.py``),
  whose rounds grow with the logarithm of a component's size, also for a long
  chain of values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldenrec.operators.components import components
from goldenrec.session import materialize


def deletion_variants(nodes: DataFrame, col: str = "value") -> DataFrame:
    """(value, pos, variant) for every single-character deletion."""
    v = F.col(col)
    pos = F.explode(F.sequence(F.lit(1), F.length(v))).alias("pos")
    exploded = nodes.filter(F.length(v) > 0).select(v.alias("value"), pos)
    variant = F.concat(F.expr("substring(value, 1, pos - 1)"), F.expr("substring(value, pos + 1)"))
    return exploded.select("value", "pos", variant.alias("variant"))


def neighbour_edges(nodes: DataFrame) -> DataFrame:
    """Undirected edges (a, b), a < b, between values at edit distance 1
    (substitutions as stars to the group minimum)."""
    var = deletion_variants(nodes)
    hub = F.min("value").over(Window.partitionBy("variant", "pos"))
    subst = var.select("value", hub.alias("other")).filter(F.col("value") != F.col("other"))
    indel = var.join(nodes.select(F.col("value").alias("variant")), "variant", "left_semi") \
        .select("value", F.col("variant").alias("other"))
    both = subst.unionByName(indel)
    return both.select(F.least("value", "other").alias("a"), F.greatest("value", "other").alias("b")).distinct()


def near_duplicate_clusters(df: DataFrame, col: str) -> DataFrame:
    """Per distinct non-NULL value of ``col``: its cluster (the least value of
    the component) and record count."""
    counts = materialize(df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(
        F.count(F.lit(1)).alias("records")), "neardup")
    edges = neighbour_edges(counts.select("value")).select(F.col("a").alias("u"), F.col("b").alias("v"))
    roots = components(edges).withColumnRenamed("node", "value")
    return counts.join(roots, "value", "left").select("value", "records", F.coalesce("root", "value").alias("cluster"))
