"""Keys of one or more columns (PR5), by levels.

A set of columns is a key if no row has a NULL in it and no two rows agree on
it; wanted are the minimal ones. Sets are tried by size. Never tried are sets
with a column that has NULLs, sets that hold a smaller key, and sets whose
columns' distinct counts multiply to less than the number of rows, which cannot
tell all rows apart. What is left is first counted by one sketch pass over all
sets of a level; only sets whose sketch comes near the number of rows are
counted exactly.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations
from math import prod

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Relative standard deviation of the sketches, and how many of them a set's
#: estimate may miss the number of rows by and still be counted exactly.
SKETCH_ERROR, MARGIN = 0.02, 6

#: Sets that one pass sketches together.
SETS_A_PASS = 50


def _estimates(df: DataFrame, sets: Sequence[tuple[str, ...]]) -> dict[tuple[str, ...], int]:
    found = {}
    for at in range(0, len(sets), SETS_A_PASS):
        some = sets[at:at + SETS_A_PASS]
        row = df.agg(*(F.approx_count_distinct(F.xxhash64(*s), SKETCH_ERROR).alias(f"s{k}") for k, s in enumerate(some))).first()
        found.update(zip(some, row))
    return found


def _is_unique(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether no two rows agree on ``columns``: counts are combined map-side and
    only whether any is above one comes back."""
    twice = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").limit(1)
    return not twice.take(1)


def minimal_keys(df: DataFrame, columns: Sequence[str] | None = None, most_columns: int = 2) -> list[tuple[str, ...]]:
    """The minimal keys of up to ``most_columns`` of ``columns`` (all by default),
    in the order of size and columns. An empty table has none."""
    columns = list(columns or df.columns)
    head = df.agg(F.count(F.lit(1)).alias("rows"), *(F.count(F.col(c)).alias(f"c{k}") for k, c in enumerate(columns))).first()
    rows = head["rows"]
    if not rows:
        return []
    full = [c for k, c in enumerate(columns) if head[f"c{k}"] == rows]
    near = rows * (1 - MARGIN * SKETCH_ERROR)
    singles = _estimates(df, [(c,) for c in full])
    most = {c: min(rows, singles[c,] * (1 + MARGIN * SKETCH_ERROR) + 1) for c in full}
    keys: list[tuple[str, ...]] = []
    for size in range(1, most_columns + 1):
        sets = [s for s in combinations(full, size) if not any(set(k) <= set(s) for k in keys) and prod(most[c] for c in s) >= rows]
        estimates = singles if size == 1 else _estimates(df, sets)
        keys += [s for s in sets if estimates[s] >= near and _is_unique(df, s)]
    return keys


def key_report(df: DataFrame, columns: Sequence[str] | None = None, most_columns: int = 2) -> DataFrame:
    """(key_columns, n_columns, suggested): one row for each minimal key; the
    first one, of the fewest columns, is suggested."""
    keys = minimal_keys(df, columns, most_columns)
    rows = [(",".join(k), len(k), n == 0) for n, k in enumerate(keys)]
    return df.sparkSession.createDataFrame(rows, "key_columns string, n_columns int, suggested boolean")
