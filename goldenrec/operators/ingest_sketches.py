"""A monitor that adds up over ingests (A2, A3).

Each ingest leaves one row for its source and day: the number of records and a
HyperLogLog sketch of their hashes. Totals and unique records of any sources and
days come from these rows alone, by summing the counts and merging the sketches;
no data is read again. Sketches of ``LG_BUCKETS`` = 14 miss the exact count by
about 0.8 % (one standard deviation).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_BUCKETS = 14


def ingest_row(df: DataFrame, source: str, day: Column | str, columns: Sequence[str] | None = None) -> DataFrame:
    """(source_type, day, total_records, sketch): one row for each day of ``df``;
    ``columns`` (all by default) make up a record."""
    day = F.col(day) if isinstance(day, str) else day
    text = F.to_json(F.struct(*(columns or df.columns)), {"ignoreNullFields": "false"})
    return df.groupBy(day.cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("total_records"), F.hll_sketch_agg(F.xxhash64(text), F.lit(LG_BUCKETS)).alias("sketch")) \
        .select(F.lit(source).alias("source_type"), "day", "total_records", "sketch")


def save_ingest(rows: DataFrame, path: str) -> None:
    """Writes ``ingest_row`` rows; a day ingested again replaces its row."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_type", "day").parquet(path)


def totals(sketches: DataFrame, by: Sequence[str] = ("source_type",)) -> DataFrame:
    """(by, first_day, last_day, total_records, unique_records) over sketch rows."""
    return sketches.groupBy(*by).agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.sum("total_records").alias("total_records"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("unique_records"))
