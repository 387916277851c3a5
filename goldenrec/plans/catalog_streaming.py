"""Streaming queries: the person feed is written by Spark as parquet files,
then consumed incrementally (``availableNow``, one file per micro-batch).
Results are read back as batch DataFrames; each has the same oracle as its
batch twin, since a stream over all files must end in the batch answer."""

from __future__ import annotations

from goldenrec.plans import catalog, catalog_quality  # noqa: F401  (register the batch oracles reused below)
from goldenrec.plans.persons import persons
from goldenrec.plans.registry import ORACLE, register
from goldenrec.session import shared_dir
from goldenrec.streaming import jobs
from goldenrec.streaming.state import GoldState

#: Micro-batches over the feed; its files follow the number of shuffle partitions.
BATCHES = 4


def _feed(spark, sf_dir) -> tuple[str, object]:
    path = shared_dir(spark, "stream", "feed")
    persons(spark, sf_dir).repartition(_files(spark)).write.mode("overwrite").parquet(path)
    return path, spark.read.parquet(path).schema


def _files(spark) -> int:
    return max(BATCHES, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _identified_stream(spark, sf_dir):
    path, schema = _feed(spark, sf_dir)
    bronze = jobs.bronze_stream(spark, path, schema, max_files_per_trigger=-(-_files(spark) // BATCHES))
    return jobs.silver_stream(bronze)


def _silver_table(spark, sf_dir) -> str:
    out = shared_dir(spark, "stream", "silver")
    jobs.run_to_parquet(_identified_stream(spark, sf_dir), out, shared_dir(spark, "stream", "ckpt"))
    return out


@register("stream_silver", ORACLE["silver_identified"])
def q_stream_silver(spark, sf_dir):
    """ST1/ST2: incremental bronze -> silver -> identified, parquet sink."""
    return spark.read.parquet(_silver_table(spark, sf_dir))


@register("stream_duplicate_count", ORACLE["duplicate_count"])
def q_stream_duplicate_count(spark, sf_dir):
    """ST3: stateful streaming count per identifier (complete mode)."""
    out = shared_dir(spark, "stream", "counts")
    jobs.run_complete(jobs.count_stream(_identified_stream(spark, sf_dir)), out, shared_dir(spark, "stream", "ckpt"))
    return spark.read.parquet(out)


@register("stream_confidence_scored", ORACLE["confidence_scored"])
def q_stream_confidence_scored(spark, sf_dir):
    """ST4: streaming counts joined with a static snapshot of the records."""
    silver = _silver_table(spark, sf_dir)
    users = spark.read.parquet(silver)
    # Every micro-batch rewrites the whole joined table, so their number must not
    # follow that of the files, which grows with the feed.
    files = -(-len(users.inputFiles()) // BATCHES)
    counts = jobs.count_stream(jobs.bronze_stream(spark, silver, users.schema, max_files_per_trigger=max(1, files)))
    scored = jobs.scored_stream(counts, users)
    out = shared_dir(spark, "stream", "scored")
    jobs.run_complete(scored, out, shared_dir(spark, "stream", "ckpt"))
    return spark.read.parquet(out)


def _gold_state(spark, sf_dir) -> GoldState:
    state = GoldState(root=shared_dir(spark, "stream", "state"), fan_in=3)
    jobs.run_incremental_gold(_identified_stream(spark, sf_dir), state, shared_dir(spark, "stream", "ckpt"))
    return state


@register("stream_golden", ORACLE["golden_by_name"])
def q_stream_golden(spark, sf_dir):
    """ST5: golden record per name from mergeable state; a micro-batch adds its
    own aggregate and reads no earlier record."""
    return _gold_state(spark, sf_dir).golden(spark)


@register("stream_golden_by_identifier", ORACLE["golden_by_identifier"])
def q_stream_golden_by_identifier(spark, sf_dir):
    """ST5/G4: golden record per identifier from the same state."""
    return _gold_state(spark, sf_dir).golden_by_identifier(spark)


@register("stream_golden_buckets", ORACLE["golden_by_name"])
def q_stream_golden_buckets(spark, sf_dir):
    """ST5 with the scored table kept beside the golden one: the identity buckets
    that a micro-batch touches are recomputed from silver."""
    handler = jobs.IncrementalGold(root=shared_dir(spark, "stream", "gold"), buckets=16)
    jobs.run_incremental_gold(_identified_stream(spark, sf_dir), handler, shared_dir(spark, "stream", "ckpt"))
    return spark.read.parquet(handler.golden_name_path).drop(jobs.NAME_BUCKET)


@register("stream_quality_report", ORACLE["quality_report"])
def q_stream_quality_report(spark, sf_dir):
    """ST6/Q2: bronze rules on the person stream, counted per micro-batch and
    summed (same answer as the batch report)."""
    from goldenrec.operators import quality
    from goldenrec.plans.catalog_quality import PERSON_RULES

    path, schema = _feed(spark, sf_dir)
    bronze = quality.typed_for_rules(jobs.bronze_stream(spark, path, schema, max_files_per_trigger=1))
    out = shared_dir(spark, "stream", "quality")
    jobs.run_quality_report(bronze, PERSON_RULES, out, shared_dir(spark, "stream", "ckpt"))
    return jobs.quality_totals(spark, out)
