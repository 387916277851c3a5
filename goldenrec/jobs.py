"""Batch and streaming jobs (``spark-submit`` entry point).

    spark-submit --py-files goldenrec.zip goldenrec/jobs.py identity --bronze s3a://bucket/raw --out s3a://bucket/tables
    python -m goldenrec.jobs identity --bronze /data/raw --out /data/tables
    python -m goldenrec.jobs sources  --base /data/sources --out /data/tables
    python -m goldenrec.jobs stream   --bronze /data/raw --out /data/tables --checkpoint /shared/ckpt
    python -m goldenrec.jobs profile  --path /data/new.csv --out /data/profile

Each job writes whole tables (or dynamic partitions) with overwrite, so a
rerun after a failure reproduces the same output; streaming jobs keep their
progress in the checkpoint folder (default: ``_checkpoint`` under ``--out``).
"""

from __future__ import annotations

import argparse
import sys
import datetime as dt
import os

from pyspark.sql import SparkSession

if __package__ in (None, ""):  # run as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from goldenrec import settings
from goldenrec.operators import metadata, profile, quality
from goldenrec.plans import layers as ip
from goldenrec.plans import source_tables as st
from goldenrec.session import apply_base_conf
from goldenrec.sources import readers
from goldenrec.sources.spec import SourceSpec, all_specs
from goldenrec.streaming import jobs as sj
from goldenrec.streaming.state import GoldState


def _params(a: argparse.Namespace) -> ip.PipelineParams:
    return ip.PipelineParams(blank_as_null=a.blank_as_null, partition_by=(a.partition_by,),
                             survivorship=a.survivorship, rule_mode=a.rule_mode, how=a.how,
                             hot_keys=a.hot_keys or None)


def _bronze_spec(a: argparse.Namespace) -> SourceSpec:
    opts = {"multiLine": "false"} if a.format == "csv" else {}
    return SourceSpec("bronze", a.bronze, file_format=a.format, read_options=opts)


def run_identity(spark: SparkSession, a: argparse.Namespace) -> dict[str, str]:
    """Bronze files -> silver -> gold tables, plus the bronze rule report."""
    bronze = metadata.with_file_columns(readers.read_batch(spark, _bronze_spec(a)))
    paths = ip.run_identity_job(spark, bronze, a.out, _params(a))
    report_path = os.path.join(a.out, "dd_bronze_quality")
    quality.report(quality.typed_for_rules(spark.read.parquet(paths["bronze"])), settings.BRONZE_QUALITY_RULES) \
        .write.mode("overwrite").parquet(report_path)
    paths["bronze_quality"] = report_path
    return paths


def run_sources(spark: SparkSession, a: argparse.Namespace) -> dict[str, str]:
    """The five predefined sources -> pre-bronze tables (the generic builder's,
    or with ``--fixed`` the fixed ones), their rule reports and the unified
    ingestion monitor."""
    stamp = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    out: dict[str, str] = {}
    written = {}
    for spec in all_specs(a.base):
        name = f"pre_bronze_{spec.name}"
        if a.fixed:
            df, rules = st.FIXED_TABLES[spec.name](spark, a.base, ingested_at=stamp), st.FIXED_RULES[spec.name]
        else:
            df = st.build_source_table(spark, st.line_oriented(spec) if a.line_oriented else spec, ingested_at=stamp)
            rules = spec.expectations()
        path = os.path.join(a.out, name)
        df.write.mode("overwrite").parquet(path)
        written[spec.name] = spark.read.parquet(path)
        rep = os.path.join(a.out, f"{name}_quality")
        quality.report(written[spec.name], rules).write.mode("overwrite").parquet(rep)
        out[name], out[f"{name}_quality"] = path, rep
    from goldenrec.operators import monitor

    mon = os.path.join(a.out, "pre_bronze_unified_metadata")
    monitor.unified_summary(written).write.mode("overwrite").parquet(mon)
    out["pre_bronze_unified_metadata"] = mon
    return out


def run_stream(spark: SparkSession, a: argparse.Namespace) -> dict[str, str]:
    """Incremental gold over new bronze files (availableNow trigger)."""
    spec = _bronze_spec(a)
    schema = readers.stream_schema(spark, spec, os.path.join(a.out, "_bronze_schema"))
    bronze = readers.read_stream(spark, spec, max_files_per_trigger=a.max_files, schema=schema)
    identified = sj.silver_stream(metadata.with_file_columns(bronze), _params(a))
    if a.merge_state:
        state = GoldState(root=a.out, params=_params(a))
        sj.run_incremental_gold(identified, state, a.checkpoint or os.path.join(a.out, "_checkpoint"))
        return state.publish(spark)
    handler = sj.IncrementalGold(root=a.out, params=_params(a), buckets=a.buckets, name_buckets=a.buckets)
    # Progress and tables belong together: a rerun goes on where the last one
    # stopped. Tables without their progress would count every file again.
    ckpt = a.checkpoint or os.path.join(a.out, "_checkpoint")
    if sj.exists(spark, handler.silver_path) and not sj.exists(spark, ckpt):
        raise ValueError(f"{handler.silver_path} exists but its checkpoint {ckpt} does not: pass the checkpoint it was made with, or a new --out")
    sj.run_incremental_gold(identified, handler, ckpt)
    return {"silver_identified": handler.silver_path, "gold_confidence_scored": handler.scored_path,
            "gold_by_identifier": handler.golden_id_path, "gold_final": handler.golden_name_path}


def run_profile(spark: SparkSession, a: argparse.Namespace) -> dict[str, str]:
    """Type/semantic profile of a CSV read as text."""
    profile.profile_csv(spark, a.path, delimiter=a.delimiter, semantic=True, widen=a.widen) \
        .write.mode("overwrite").parquet(a.out)
    return {"profile": a.out}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="goldenrec.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("identity", "stream"):
        s = sub.add_parser(name)
        s.add_argument("--bronze", required=True)
        s.add_argument("--format", default="csv", choices=settings.SUPPORTED_FORMATS)
        s.add_argument("--out", required=True)
        s.add_argument("--blank-as-null", action="store_true")
        s.add_argument("--partition-by", default="name", choices=("name", "unique_identifier"))
        s.add_argument("--survivorship", default="row", choices=("row", "attribute"))
        s.add_argument("--rule-mode", default="warn", choices=("warn", "drop"))
        s.add_argument("--how", default="inner", choices=("inner", "left"))
        s.add_argument("--hot-keys", type=int, default=settings.HOT_KEY_MAX_KEYS,
                       help="broadcast-join up to this many hot identifiers (bounded: rows >= N/K); 0: off")
        if name == "stream":
            s.add_argument("--checkpoint")
            s.add_argument("--max-files", type=int, default=None)
            s.add_argument("--buckets", type=int, default=64)
            s.add_argument("--merge-state", action="store_true",
                           help="keep mergeable state in place of silver and scored tables: a batch's cost does not grow with the history")
    s = sub.add_parser("sources")
    s.add_argument("--base", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--fixed", action="store_true", help="the five fixed tables and their rules instead of the generic builder's")
    s.add_argument("--line-oriented", action="store_true", help="one record per line: large files split into many tasks")
    s = sub.add_parser("profile")
    s.add_argument("--path", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--delimiter", default=",")
    s.add_argument("--widen", action="store_true")
    return p


RUNNERS = {"identity": run_identity, "sources": run_sources, "stream": run_stream, "profile": run_profile}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, str]:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"goldenrec-{a.job}").getOrCreate()
    apply_base_conf(spark)
    return RUNNERS[a.job](spark, a)


if __name__ == "__main__":
    for k, v in main().items():
        print(f"{k}\t{v}")
