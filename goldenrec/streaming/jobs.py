"""Structured Streaming forms of the identity pipeline (ST1-ST6).

* ``silver_stream``: file source -> clean -> identify, stateless; append to a
  parquet sink with a checkpoint (exactly-once file commits).
* ``count_stream``: streaming ``groupBy(unique_identifier).count()`` (state
  store keyed by identifier; no watermark exists for this key, so the output
  mode is complete/update, never append).
* ``scored_stream``: the streaming counts joined with a static snapshot of the
  identified records (stream-static join), as the surveyed layer does.
* ``IncrementalGold``: ``foreachBatch`` handler that keeps silver, scored and
  golden-by-identifier tables partitioned by an identity bucket and, per
  micro-batch, recomputes only the buckets the batch touched (dynamic
  partition overwrite). A replayed batch rewrites the same partitions with the
  same content, so restarts after a lost executor or driver are harmless.
  Golden-by-name is not bucket-local (one name spans many identifiers): the
  name buckets that received re-scored rows are rebuilt from the scored table,
  which a replay rebuilds from silver; no table is rewritten from itself.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from goldenrec.operators import golden, quality
from goldenrec.plans import layers as ip

BUCKET = "bucket"


def identity_bucket(key: str = "unique_identifier", buckets: int = 64):
    """Stable bucket of an identifier (NULL keys land in one bucket)."""
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def bronze_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None, options: dict | None = None) -> DataFrame:
    """ST1: incremental file source (each file read once per checkpoint)."""
    r = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def silver_stream(bronze: DataFrame, params: ip.PipelineParams = ip.PipelineParams(),
                  observe_rules: dict | None = None) -> DataFrame:
    """ST2 (+ST6): the batch silver functions applied to a stream; optional
    warn-mode rule metrics ride along via ``observe``."""
    if observe_rules:
        bronze = quality.observe_rules_named(quality.typed_for_rules(bronze), observe_rules, "bronze_quality")
    return ip.silver_identified(bronze, params)


def run_to_parquet(df: DataFrame, out: str, checkpoint: str, partition_by: tuple[str, ...] = ()) -> StreamingQuery:
    """Append sink; ``availableNow`` processes everything present, then stops."""
    w = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start()
    q.awaitTermination()
    return q


def count_stream(identified: DataFrame) -> DataFrame:
    """ST3: streaming duplicate count (stateful, keyed by identifier)."""
    return golden.duplicate_count(identified)


def _overwrite(out: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out)
    return write


def run_complete(df: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Complete-mode result table, rewritten whole on every trigger."""
    q = (df.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
         .foreachBatch(_overwrite(out)).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def scored_stream(counts: DataFrame, users: DataFrame, params: ip.PipelineParams = ip.PipelineParams()) -> DataFrame:
    """ST4: streaming counts x static records (inner join on the identifier),
    confidence labelled, projected to the scored columns."""
    from goldenrec.functions import normalize as N
    from goldenrec import settings

    j = counts.join(users, on="unique_identifier", how="inner")
    j = j.withColumn("confidence", N.confidence("repetition", params.high_above, params.moderate_at))
    return j.select(*settings.SCORED_COLUMNS)


@dataclass
class IncrementalGold:
    """foreachBatch handler: bucketed silver / scored / golden tables.

    Tables (all parquet under ``root``):
    silver and scored partitioned by identity bucket; golden-by-identifier by
    identity bucket; golden-by-name by name bucket. Each micro-batch rewrites
    only the partitions it can change.
    """

    root: str
    params: ip.PipelineParams = ip.PipelineParams()
    buckets: int = 64
    name_buckets: int = 64

    @property
    def silver_path(self) -> str:
        return os.path.join(self.root, "silver_identified")

    @property
    def scored_path(self) -> str:
        return os.path.join(self.root, "gold_confidence_scored")

    @property
    def golden_id_path(self) -> str:
        return os.path.join(self.root, "gold_by_identifier")

    @property
    def golden_name_path(self) -> str:
        return os.path.join(self.root, "gold_final")

    def _name_key(self) -> str:
        return self.params.partition_by[0]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        keyed = batch.withColumn(BUCKET, identity_bucket(buckets=self.buckets)).withColumn("_batch", F.lit(batch_id))
        # 1. append the batch to silver; (bucket, _batch) partitions make a replay overwrite itself
        _overwrite_partitions(keyed, self.silver_path, (BUCKET, "_batch"))
        # 2. identity buckets this batch touched: at most `buckets` small ints
        touched = [r[0] for r in keyed.select(BUCKET).distinct().collect()]
        if not touched:
            return
        # 3. recompute those buckets from all of silver (partition-pruned read):
        #    identifiers never span buckets, so counts and winners are complete
        silver = spark.read.parquet(self.silver_path).filter(F.col(BUCKET).isin(touched)).drop("_batch")
        scored = golden.score(silver.drop(BUCKET), how=self.params.how, high_above=self.params.high_above,
                              moderate_at=self.params.moderate_at, hot_keys=self.params.hot_keys)
        name_bucket = F.pmod(F.xxhash64(F.col(self._name_key())), F.lit(self.name_buckets)).cast("int")
        scored = scored.withColumn(BUCKET, identity_bucket(buckets=self.buckets)).withColumn(NAME_BUCKET, name_bucket)
        _overwrite_partitions(scored, self.scored_path, (BUCKET,))
        by_id = golden.golden_by_key(silver, order=self.params.order, how=self.params.how,
                                     survivorship=self.params.survivorship, high_above=self.params.high_above, moderate_at=self.params.moderate_at)
        _overwrite_partitions(by_id, self.golden_id_path, (BUCKET,))
        # 4. golden by name: a name spans identity buckets. Rewrite only the
        #    name buckets that received re-scored rows, from all scored rows.
        self._update_by_name(spark, touched)

    def _update_by_name(self, spark: SparkSession, touched: list[int]) -> None:
        scored = spark.read.parquet(self.scored_path)
        affected = [r[0] for r in scored.filter(F.col(BUCKET).isin(touched)).select(NAME_BUCKET).distinct().collect()]  # at most name_buckets
        rows = scored.filter(F.col(NAME_BUCKET).isin(affected)).drop(BUCKET)
        p = self.params
        if p.survivorship == "attribute":
            best = golden.survivorship(rows.drop(NAME_BUCKET), p.partition_by, p.order)
            best = best.withColumn(NAME_BUCKET, F.pmod(F.xxhash64(F.col(self._name_key())), F.lit(self.name_buckets)).cast("int"))
        else:
            best = golden.golden_records(rows, p.partition_by, p.order)
        _overwrite_partitions(best, self.golden_name_path, (NAME_BUCKET,))


NAME_BUCKET = "name_bucket"


def _overwrite_partitions(df: DataFrame, path: str, cols: tuple[str, ...]) -> None:
    """Dynamic partition overwrite: only the partitions present in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table folder exists yet (Hadoop FileSystem API, any store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def run_incremental_gold(identified: DataFrame, handler: IncrementalGold, checkpoint: str) -> StreamingQuery:
    q = (identified.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handler)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def run_quality_report(df: DataFrame, rules: dict, out: str, checkpoint: str) -> StreamingQuery:
    """ST6/Q2 on a stream, exact across micro-batches: each batch writes its
    per-rule pass/fail counts into its own ``_batch`` partition (a replayed
    batch overwrites itself); ``quality_totals`` sums them."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rep = quality.report(batch, rules).withColumn("_batch", F.lit(batch_id))
        _overwrite_partitions(rep, out, ("_batch",))

    q = (df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def quality_totals(spark: SparkSession, out: str) -> DataFrame:
    rep = spark.read.parquet(out)
    return rep.groupBy("rule").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


class QualityListener(StreamingQueryListener):
    """ST6: collects the observed rule metrics of every micro-batch."""

    def __init__(self, name: str = "bronze_quality"):
        self.name = name
        self.batches: list[dict] = []

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            self.batches.append(row.asDict())

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass

    def totals(self) -> dict:
        out: dict = {}
        for b in self.batches:
            for k, v in b.items():
                out[k] = out.get(k, 0) + (v or 0)
        return out
