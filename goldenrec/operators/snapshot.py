"""Changes between two versions of a table (G7), for readers that follow it.

Both versions are reduced to key and row hash, in which one shuffle on the key
finds what differs; only those rows are fetched whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHANGE = "_change"


def row_hash(columns: Sequence[str]) -> Column:
    """Hash over all columns that tells NULL from empty and one column from the
    next (SHA-256 of the row as JSON with NULL fields written)."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return cond


def changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows that make ``new`` of ``old``: columns of ``new`` and ``_change``,
    ``inserted`` or ``changed`` with the new row, ``removed`` with the old one.

    ``keys`` tell the rows of each version apart (NULL is a value of its own).
    Both have the same columns.
    """
    if set(old.columns) != set(new.columns):
        raise ValueError("the two versions must have the same columns")
    columns = list(new.columns)
    before = old.select(*keys, row_hash(columns).alias("_hash"))
    after = new.select(*keys, row_hash(columns).alias("_hash"))
    tagged = before.withColumn("_old", F.lit(1)).withColumn("_new", F.lit(0)).unionByName(
        after.withColumn("_old", F.lit(0)).withColumn("_new", F.lit(1)))
    # One group for each key: no NULL-safe outer join, and combined map-side.
    kind = tagged.groupBy(*keys).agg(F.sum("_old").alias("_old"), F.sum("_new").alias("_new"), F.min("_hash").alias("_a"), F.max("_hash").alias("_b"))
    kind = kind.filter((F.col("_old") != F.col("_new")) | (F.col("_a") != F.col("_b"))).select(
        *keys, F.when(F.col("_old") == 0, "inserted").when(F.col("_new") == 0, "removed").otherwise("changed").alias(CHANGE))
    out = []
    for rows, kinds in ((new, ("inserted", "changed")), (old.select(*columns), ("removed",))):
        mine = kind.filter(F.col(CHANGE).isin(*kinds))
        out.append(rows.alias("r").join(mine.alias("k"), _same("r", "k", keys)).select("r.*", f"k.{CHANGE}"))
    return out[0].unionByName(out[1])


def apply_changes(old: DataFrame, diff: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` after ``changes``."""
    kept = old.alias("r").join(diff.select(*keys).alias("k"), _same("r", "k", keys), "left_anti")
    return kept.unionByName(diff.filter(F.col(CHANGE) != "removed").drop(CHANGE))


def write_changes(old: DataFrame | None, new: DataFrame, keys: Sequence[str], out: str, run: int) -> str:
    """Writes the changes of run ``run`` to its own folder under ``out`` (a rerun
    overwrites it); the first run inserts every row."""
    diff = changes(old, new, keys) if old is not None else new.withColumn(CHANGE, F.lit("inserted"))
    path = f"{out}/run={run}"
    diff.write.mode("overwrite").parquet(path)
    return path
