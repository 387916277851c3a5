"""DataFrame-level cleaning operators.

Each function rewrites columns with a single ``select`` (one Project node,
no per-column ``withColumn`` chain), so plan size stays linear in the number
of columns and all work fuses into one codegen stage next to the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from goldenrec import settings
from goldenrec.functions import normalize as N

Transform = Callable[[DataFrame], DataFrame]


def replace_columns(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Replace (or append) columns in place, keeping column order, in one Project."""
    if not exprs:
        return df
    out = [exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns]
    out += [e.alias(n) for n, e in exprs.items() if n not in df.columns]
    return df.select(*out)


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every string column whose name does not start with ``_``."""
    return replace_columns(
        df,
        {f.name: F.trim(F.col(f.name)) for f in df.schema.fields
         if isinstance(f.dataType, StringType) and not f.name.startswith("_")},
    )


def normalize_email(df: DataFrame, col: str = "email") -> DataFrame:
    """C2."""
    return replace_columns(df, {col: N.email(col)}) if col in df.columns else df


def normalize_phone(df: DataFrame, col: str = "phone") -> DataFrame:
    """C3."""
    return replace_columns(df, {col: N.phone(col)}) if col in df.columns else df


def normalize_names(df: DataFrame, cols: Sequence[str] = settings.NAME_COLUMNS) -> DataFrame:
    """C4: initcap(trim()) on the name columns that exist."""
    return replace_columns(df, {c: N.proper_name(c) for c in cols if c in df.columns})


def boolean_like_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "is_" in c.lower() or "active" in c.lower()]


def standardize_boolean(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Three-state booleans for columns named like ``is_*`` / ``*active*``."""
    cols = boolean_like_columns(df) if cols is None else cols
    return replace_columns(df, {c: N.boolean_three_state(c) for c in cols})


def two_state_boolean(df: DataFrame, col: str = "is_active") -> DataFrame:
    """true/yes/1 -> true, anything else -> false."""
    return replace_columns(df, {col: N.boolean_two_state(col)}) if col in df.columns else df


def add_full_name(df: DataFrame, first: str = "first_name", last: str = "last_name",
                  out: str = "full_name") -> DataFrame:
    """Only when both parts exist."""
    if first in df.columns and last in df.columns:
        return replace_columns(df, {out: N.full_name(first, last)})
    return df


def parse_dates(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """to_date on each listed column that exists; malformed -> NULL."""
    return replace_columns(df, {c: N.parse_date(c) for c in cols if c in df.columns})


def normalize_company(df: DataFrame, col: str = "company_name") -> DataFrame:
    """C10."""
    return replace_columns(df, {col: N.company_name(col)}) if col in df.columns else df


def apply_transforms(df: DataFrame, transforms: Sequence[Transform]) -> DataFrame:
    """C14: user hooks in list order."""
    return reduce(lambda d, t: d.transform(t), transforms, df)


def silver_clean(bronze: DataFrame, path_col: str = "source_file_path",
                 mapping: Iterable[tuple[str, str]] = settings.SOURCE_SYSTEMS) -> DataFrame:
    """Derive the source system, keep the silver columns, normalize.

    One projection: person_id, name (initcap), email (lower/trim), phone
    (digits and +), age (try_cast int), source_system.
    """
    return bronze.select(
        F.col("person_id"),
        N.proper_name("name").alias("name"),
        N.email("email").alias("email"),
        N.phone("phone").alias("phone"),
        N.as_int("age").alias("age"),
        N.source_system(path_col, mapping).alias("source_system"),
    )
