"""Ingestion summaries (A2-A4) and unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


SUMMARY = ("source_type", "total_records", "unique_records", "source_files", "last_ingestion")


def ingestion_summary(df: DataFrame, source_type: str, hash_col: str = "_record_hash",
                      file_col: str = "_source_file", time_col: str = "_ingestion_timestamp",
                      approx: bool = False) -> DataFrame:
    """A2: one row: total, distinct hashes, distinct files, latest ingestion.

    ``approx=True`` counts distinct hashes with HyperLogLog++ (fixed-size
    sketches merged map-side, ~1 % error) instead of shuffling every distinct
    hash, for monitors over very large tables."""
    whole = [F.count(F.lit(1)).alias("total_records"), F.max(time_col).alias("last_ingestion")]
    if approx:
        return df.agg(F.lit(source_type).alias("source_type"), *whole, F.approx_count_distinct(hash_col, 0.01).alias("unique_records"),
                      F.count_distinct(file_col).alias("source_files")).select(*SUMMARY)
    # A pass over its own column for each distinct count: two of them in one
    # aggregate would double every row. The one-row results are stacked.
    passes = [df.agg(*whole), df.select(hash_col).distinct().agg(F.count(hash_col).alias("unique_records")),
              df.select(file_col).distinct().agg(F.count(file_col).alias("source_files"))]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), passes)
    return stacked.agg(F.lit(source_type).alias("source_type"), *(F.max(c).alias(c) for c in SUMMARY[1:]))


def unified_summary(tables: Mapping[str, DataFrame], **kw) -> DataFrame:
    """The per-source summaries stacked (by name, duplicates kept)."""
    parts = [ingestion_summary(df, name, **kw) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def stack_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack several systems' records by column name; columns missing in
    one source become NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
