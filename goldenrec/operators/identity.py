"""Identity keys (K1-K4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldenrec import settings
from goldenrec.functions import normalize as N
from goldenrec.functions.hashing import data_columns, record_hash


def priority_identifier(
    priority: Sequence[str] = ("email", "phone"),
    fallback: Sequence[str] = ("name", "age"),
    blank_as_null: bool = False,
    sep: str = settings.FALLBACK_SEPARATOR,
) -> Column:
    """First non-missing column of ``priority``, else ``concat_ws(sep, fallback)``.

    ``blank_as_null=False`` is the layer behaviour (K1): only NULL is
    missing, so an empty email still wins. ``True`` (K2) also treats empty and
    all-space strings as missing. The fallback never yields NULL (concat_ws
    skips NULL parts), so every row gets a key.
    """
    parts = [N.blank_as_null(F.col(c)) if blank_as_null else F.col(c) for c in priority]
    tail = [F.col(c).cast("string") for c in fallback]
    tail = [N.blank_as_null(t) for t in tail] if blank_as_null else tail
    return F.coalesce(*parts, F.concat_ws(sep, *tail))


def with_identifier(df: DataFrame, blank_as_null: bool = False, priority: Sequence[str] = ("email", "phone"),
                    fallback: Sequence[str] = ("name", "age"), out: str = "unique_identifier") -> DataFrame:
    """K1 / K2 as a column append."""
    return df.withColumn(out, priority_identifier(priority, fallback, blank_as_null))


def entity_identifier(df: DataFrame, entity: str) -> Column:
    """K3: per-entity key.

    products -> sku; employees -> email; customers -> email, phone, then
    first_name_city (blanks missing); anything else -> first column whose
    name contains ``id``; a table without one -> the record hash (row numbers
    are not stable across Spark runs, the content hash is).
    """
    if entity == "products" and "sku" in df.columns:
        return F.col("sku")
    if entity == "employees" and "email" in df.columns:
        return F.col("email")
    if entity == "customers":
        return priority_identifier(("email", "phone"), ("first_name", "city"), blank_as_null=True)
    id_cols = [c for c in df.columns if "id" in c.lower()]
    if id_cols:
        return F.col(id_cols[0]).cast("string")
    return record_hash(data_columns(df))


def exact_duplicates(df: DataFrame, key_cols: Sequence[str], keep_col: str, keep: str = "min") -> DataFrame:
    """K4: exact grouping on configurable dedup keys.

    One row per distinct key with the surviving row id (smallest ``keep_col``
    by default, so the choice is deterministic) and the number of copies.
    A hash aggregate: map-side partial aggregation collapses hot keys before
    the shuffle.
    """
    pick = F.min(keep_col) if keep == "min" else F.max(keep_col)
    return df.groupBy(*key_cols).agg(pick.alias(keep_col), F.count(F.lit(1)).alias("copies"))


def drop_exact_duplicates(df: DataFrame, key_cols: Sequence[str], order_col: str) -> DataFrame:
    """Keep the whole first row (smallest ``order_col``) per dedup key."""
    from pyspark.sql import Window

    w = Window.partitionBy(*key_cols).orderBy(F.col(order_col).asc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
