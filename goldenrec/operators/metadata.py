"""Lineage and ingestion metadata."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldenrec.functions.normalize import file_name_from_path


def file_path() -> Column:
    """Path of the file a row came from, from the scan's hidden ``_metadata``
    column (works for batch and streaming file sources, and survives
    projections, unlike input_file_name())."""
    return F.col("_metadata.file_path")


def with_file_columns(df: DataFrame, name_col: str = "source_file_name", path_col: str = "source_file_path") -> DataFrame:
    """Bronze lineage columns. Call directly on a file-source DataFrame."""
    return df.select("*", F.col("_metadata.file_name").alias(name_col), F.col("_metadata.file_path").alias(path_col))


def enrich(df: DataFrame, source_name: str, include_file_info: bool = True,
           ingested_at: dt.datetime | None = None) -> DataFrame:
    """S11 (+S10): ``_source_system``, ``_ingestion_timestamp`` and optionally
    ``_source_file`` / ``_source_file_name``. ``ingested_at`` pins the stamp
    (tests, replays); otherwise it is the query's current_timestamp()."""
    stamp = F.lit(ingested_at).cast("timestamp") if ingested_at is not None else F.current_timestamp()
    cols = [F.col(c) for c in df.columns]
    cols += [F.lit(source_name).alias("_source_system"), stamp.alias("_ingestion_timestamp")]
    if include_file_info:
        cols += [file_path().alias("_source_file"), file_name_from_path(file_path()).alias("_source_file_name")]
    return df.select(*cols)


def by_folder(df: DataFrame, file_col: str = "_source_file", name_col: str = "_source_file_name",
              out: str = "_source_folder") -> DataFrame:
    """Lineage by the folder a row's file lies in (one per feeding system),
    in place of its path and name: those differ from write to write."""
    folder = F.element_at(F.split(F.col(file_col), "/"), -2)
    return df.select(*(c for c in df.columns if c not in (file_col, name_col)), folder.alias(out))
