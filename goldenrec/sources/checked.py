"""Reads that keep malformed records, and schemas that follow their sources
(S5, S6, Q5)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DataType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType)

from goldenrec.operators import quality
from goldenrec.sources import readers
from goldenrec.sources.spec import SourceSpec

CORRUPT, FILE, REASONS = "_corrupt_record", "_source_file", "_failed_rules"
MALFORMED = "malformed_record"


def read_checked(spark: SparkSession, spec: SourceSpec, streaming: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """The source's rows with ``_corrupt_record``, the text of a record that does
    not fit the schema (its columns are NULL or as far as read), and
    ``_source_file``. CSV and JSON of one record per line; ``spec.schema`` must
    be given, as what is malformed depends on it."""
    if spec.schema is None or spec.file_format not in ("csv", "json"):
        raise ValueError("a checked read needs a csv or json source with a schema")
    schema = StructType([*spec.schema.fields, StructField(CORRUPT, StringType())])
    options = {k: v for k, v in spec.read_options.items() if k not in ("inferSchema", "multiLine")}
    reader = (spark.readStream if streaming else spark.read).format(spec.file_format).options(**options).options(
        mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, recursiveFileLookup="true")
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.schema(schema).load(spec.source_path).select("*", F.col("_metadata.file_path").alias(FILE))


def split_checked(rows: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """(kept, quarantined) of ``read_checked`` rows: kept are well-formed rows
    that pass every rule; quarantined all others, with their reasons in
    ``_failed_rules``. Every row is in exactly one of them."""
    well_formed = F.col(CORRUPT).isNull()
    reasons = F.when(well_formed, quality.failed_rules(rules)).otherwise(F.array(F.lit(MALFORMED)))
    marked = rows.withColumn(REASONS, reasons)
    return marked.filter(F.size(REASONS) == 0).drop(CORRUPT, REASONS), marked.filter(F.size(REASONS) > 0)


# Types that hold all values of the ones before them.
_WIDER = {IntegerType: (LongType, DoubleType), LongType: (DoubleType,), DateType: (TimestampType,)}


def _common(a: DataType, b: DataType) -> DataType:
    if a == b:
        return a
    for x, y in ((a, b), (b, a)):
        if type(y) in _WIDER.get(type(x), ()):
            return y
    return StringType()


def merge_schemas(known: StructType, found: StructType) -> StructType:
    """``known`` with the new columns of ``found`` behind its own. A column whose
    type changed takes a type that holds both, else string; none is removed, so
    rows written before stay readable."""
    types = {f.name: f.dataType for f in found.fields}
    fields = [StructField(f.name, _common(f.dataType, types.get(f.name, f.dataType))) for f in known.fields]
    return StructType([*fields, *(StructField(f.name, f.dataType) for f in found.fields if f.name not in known.names)])


def evolving_schema(spark: SparkSession, spec: SourceSpec, path: str) -> tuple[StructType, int]:
    """(schema, version) for the next run of a JSON or Parquet source: the latest
    version saved under ``path`` merged with what the files hold now; a merged
    schema that differs is saved as the next version. Columns go by name. (CSV
    columns go by place, so a CSV source keeps one declared schema.)"""
    if spec.file_format not in ("json", "parquet"):
        raise ValueError("columns must go by name: json or parquet")
    version, known = 0, None
    while (saved := readers.load_schema(spark, f"{path}/version={version + 1}")) is not None:
        version, known = version + 1, saved
    found = readers.read_batch(spark, spec).schema
    merged = merge_schemas(known, found) if known is not None else found
    if known is None or merged != known:
        version += 1
        readers.save_schema(spark, merged, f"{path}/version={version}")
    return merged, version
