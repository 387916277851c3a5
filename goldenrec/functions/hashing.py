"""Record fingerprint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldenrec import settings

NULL_MARKER = "\\N"


def data_columns(df: DataFrame) -> list[str]:
    """Columns that carry data: everything not starting with ``_``."""
    return [c for c in df.columns if not c.startswith("_")]


def record_hash(cols: Sequence[str], null_safe: bool = False, sep: str = settings.HASH_SEPARATOR) -> Column:
    """md5 of the columns cast to string and joined with ``sep``.

    The default reproduces concat_ws, which skips NULLs, so (a, NULL, b) and
    (a, b, NULL) collide. ``null_safe=True`` writes a marker for each NULL so
    positions are kept.
    """
    parts = [F.col(c).cast("string") for c in cols]
    if null_safe:
        parts = [F.coalesce(p, F.lit(NULL_MARKER)) for p in parts]
    return F.md5(F.concat_ws(sep, *parts))


def with_record_hash(df: DataFrame, cols: Sequence[str] | None = None, null_safe: bool = False,
                     name: str = "_record_hash") -> DataFrame:
    return df.withColumn(name, record_hash(list(cols) if cols is not None else data_columns(df), null_safe))
