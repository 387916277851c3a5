"""Table sinks (S16) and the source-file inventory."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_table(df: DataFrame, name: str, mode: str = "overwrite") -> str:
    """Batch sink into the session catalog (managed table)."""
    df.write.mode(mode).saveAsTable(name)
    return name


def csv_inventory(spark: SparkSession, path: str, expected: Sequence[str] = (), sep: str = ",") -> DataFrame:
    """(folder, file_name, rows, columns, present) of the CSV files under
    ``path``, each counted by its own header, and the ``expected`` file names
    that are not there (no folder, no rows, no columns).

    The files hold one record per line. One grouped aggregate: a file's header
    is its first line, the one of least (block, position in the block).
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    mark = re.escape(sep)
    # Separators followed by an even number of quotes stand outside of them.
    outside = F.lit(f'{mark}(?=(?:[^"]*"[^"]*")*[^"]*$)')
    files = lines.select(F.col("_metadata.file_path").alias("file"), "value", place.alias("place")).groupBy("file").agg(
        (F.count(F.lit(1)) - 1).alias("rows"), F.min_by("value", "place").alias("header"))
    parts = F.split("file", "/")
    found = files.select(F.element_at(parts, -2).alias("folder"), F.element_at(parts, -1).alias("file_name"), "rows",
                         (F.regexp_count("header", outside) + 1).alias("columns"), F.lit(True).alias("present"))
    if not expected:
        return found
    wanted = spark.createDataFrame([(e,) for e in expected], "file_name string")
    missing = wanted.join(found.select("file_name"), "file_name", "left_anti").select(
        F.lit(None).cast("string").alias("folder"), "file_name", F.lit(0).cast("long").alias("rows"), F.lit(0).alias("columns"),
        F.lit(False).alias("present"))
    return found.unionByName(missing)


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, mode: str = "overwrite") -> str:
    """Managed table of ``buckets`` files, hashed and sorted by ``key``.

    Counts, joins and golden records per ``key`` over the table need no shuffle:
    the scan already has each key's rows in one task. The rows are shuffled to
    the buckets once, when written, so each bucket is one file. A key that holds
    much of the table is one bucket; keep ``save_table`` for such tables.
    """
    df.repartition(buckets, key).write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return name
