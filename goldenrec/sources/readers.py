"""Batch and incremental reads of a source."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from goldenrec.sources.spec import SourceRegistry, SourceSpec


def read_batch(spark: SparkSession, spec: SourceSpec, recursive: bool = True) -> DataFrame:
    """``spark.read.format().options().schema().load()``.

    ``recursive`` reads every file under the source folder (several systems'
    files as one table). Parquet pushes filters and column pruning into the
    scan; for CSV/JSON a given ``schema`` avoids the inference pass.
    """
    reader = spark.read.format(spec.file_format).options(**spec.read_options)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if spec.schema is not None:
        reader = reader.schema(spec.schema)
    return reader.load(spec.source_path)


def save_schema(spark: SparkSession, schema: StructType, path: str) -> None:
    """Persist a schema as one JSON text row (any filesystem Spark can write)."""
    spark.createDataFrame([(schema.json(),)], "schema string").coalesce(1).write.mode("overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema saved at ``path``; None if there is nothing. Other errors
    (permissions, network) are raised: a new inference would hide them."""
    try:
        row = spark.read.text(path).first()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return StructType.fromJson(json.loads(row[0])) if row else None


def stream_schema(spark: SparkSession, spec: SourceSpec, schema_path: str | None = None) -> StructType:
    """A file stream needs a schema up front: the spec's; else one persisted
    at ``schema_path``; else the one a batch read infers (one extra pass over
    the files), persisted at ``schema_path`` for the next run."""
    if spec.schema is not None:
        return spec.schema
    if schema_path:
        saved = load_schema(spark, schema_path)
        if saved is not None:
            return saved
    inferred = read_batch(spark, spec).schema
    if schema_path:
        save_schema(spark, inferred, schema_path)
    return inferred


def read_stream(spark: SparkSession, spec: SourceSpec, max_files_per_trigger: int | None = None,
                recursive: bool = True, schema: StructType | None = None,
                schema_path: str | None = None) -> DataFrame:
    """S6/S7/ST1: incremental file source over the same folder.

    Each file is read exactly once per checkpoint; run with
    ``trigger(availableNow=True)`` for a catch-up batch job.
    """
    opts = {k: v for k, v in spec.read_options.items() if k != "inferSchema"}
    reader = spark.readStream.format(spec.file_format).options(**opts)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.schema(schema or stream_schema(spark, spec, schema_path)).load(spec.source_path)


def read_source(spark: SparkSession, registry: SourceRegistry, name: str, streaming: bool = False) -> DataFrame:
    """Dispatch by registered name; an unknown name raises ValueError."""
    spec = registry.get(name)
    return read_stream(spark, spec) if streaming else read_batch(spark, spec)
