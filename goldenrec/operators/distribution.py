"""Frequent values and quantiles of every column (PR1, PR7).

Frequent values are exact, in two scans without a shuffle of rows. The first
keeps one sketch of frequent hashes a column and task. With ``share`` s and at
least 7 / s tracked hashes a sketch is off by at most 3/8 of s of the rows, so
every value that holds s of them is among its first 2 / s hashes; those are all
that reaches the driver, whatever the values' length. The second scan counts
the values with such a hash, added up before the shuffle, and the threshold is
applied to the true counts. Quantiles come from one sketch a column, off by at
most ``1 / accuracy`` of the rows in rank.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from goldenrec import settings

SHARE = 0.01
QUANTILES = (0.0, 0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0)
ACCURACY = 10_000


def _passes(columns: Sequence[str]) -> list[list[str]]:
    size = settings.PROFILE_COLUMNS_PER_PASS
    return [list(columns[i:i + size]) for i in range(0, len(columns), size)]


def _stack(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _candidates(texts: DataFrame, columns: int, share: float) -> tuple[int, list[list[int]]]:
    """Rows, and for each column c0, c1, ... the hashes that may hold ``share``."""
    tracked, most = math.ceil(7 / share), math.ceil(2 / share)
    top = [F.expr(f"approx_top_k(xxhash64(c{i}), {most}, {tracked}) filter (where c{i} is not null)").alias(f"c{i}") for i in range(columns)]
    row = texts.agg(F.count(F.lit(1)).alias("n"), *top).first()
    return row["n"], [sorted(v["item"] for v in row[f"c{i}"] or [] if v["item"] is not None) for i in range(columns)]


def frequent_values(df: DataFrame, columns: Sequence[str] | None = None, share: float = SHARE) -> DataFrame:
    """(column_name, value, rows, total_rows): every value, as text, that holds at
    least ``share`` of all rows of its column, with its exact count.

    NULL is no value but its rows count in the total; a blank text is a value.
    Ties all stay. A table without rows gives none. Types without a text form
    (maps, variants) are not accepted.
    """
    if not 0.0001 <= share <= 1:
        raise ValueError("share must be from 0.0001 to 1")
    found = []
    for cols in _passes(list(columns or df.columns)):
        texts = df.select(*(F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(cols)))
        total, hashes = _candidates(texts, len(cols), share)
        cells = F.array(*(F.when(F.xxhash64(f"c{i}").isin(h) & F.col(f"c{i}").isNotNull(),
                                 F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("value")))
                          if h else F.lit(None).cast("struct<column_name:string,value:string>")
                          for i, (c, h) in enumerate(zip(cols, hashes))))
        held = texts.select(F.explode(cells).alias("cell")).filter(F.col("cell").isNotNull()).select("cell.*")
        counts = held.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("rows"))
        found.append(counts.withColumn("total_rows", F.lit(total).cast("long")).filter(F.col("rows") >= F.lit(share) * F.col("total_rows")))
    return _stack(found)


def column_quantiles(df: DataFrame, columns: Sequence[str] | None = None, at: Sequence[float] = QUANTILES,
                     accuracy: int = ACCURACY) -> DataFrame:
    """(column_name, quantile, value) of numeric columns (all of them by
    default) as doubles; NULLs are left out, and a column of NULLs, or of a table
    without rows, has NULL values. Off by at most 1 / ``accuracy`` of the column's
    rows in rank."""
    cols = list(columns or (f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)))
    if not cols:
        raise ValueError("no numeric columns")
    found = []
    for part in _passes(cols):
        points = F.array(*(F.lit(float(q)) for q in at))
        sketches = df.agg(*(F.percentile_approx(F.col(c).cast("double"), points, F.lit(accuracy)).alias(f"c{i}") for i, c in enumerate(part)))
        rows = F.array(*(F.struct(F.lit(c).alias("column_name"), F.lit(float(q)).alias("quantile"), F.col(f"c{i}")[j].alias("value"))
                         for i, c in enumerate(part) for j, q in enumerate(at)))
        found.append(sketches.select(F.inline(rows)))
    return _stack(found)
