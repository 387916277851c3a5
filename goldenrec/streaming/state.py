"""Golden records from mergeable per-identifier state (ST5, G4, G5, G7).

``GoldState`` keeps, instead of the records, what the golden table needs of
them: for each (identifier, golden group) the number of rows and the best row,
or the best value of each column, with the preference that made it best. Such
rows merge: the state of two sets of records is the sum of the counts and the
minimum of the preferences. A micro-batch therefore adds its own aggregate and
reads nothing of what came before.

Aggregates of batches are kept as runs. ``fan_in`` runs of a level are merged to
one of the next, so a row is rewritten once a level (the logarithm of the number
of batches) and a reader merges at most ``fan_in - 1`` runs a level. Which runs
make up the state after batch N follows from N alone; a marker of N is written
last. A batch that is replayed after a lost driver or executor overwrites its
own run and merges the same runs again, and a reader sees a batch wholly or not
at all.

Confidence depends on an identifier's rows in all batches, so it is not state:
it is worked out from the merged counts when the golden table is read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldenrec import settings
from goldenrec.functions import normalize as N
from goldenrec.operators import golden
from goldenrec.operators.golden import KEY
from goldenrec.plans import layers
from goldenrec.session import materialize


@dataclass
class GoldState:
    """foreachBatch handler over identified records; state under ``root``.

    A NULL identifier is left out unless ``params.how`` is ``left``, as in the
    batch layers. Descending order keys must be numbers, booleans, dates or
    timestamps (as in ``golden_by_key``).
    """

    root: str
    params: layers.PipelineParams = layers.PipelineParams()
    fan_in: int = 8

    # --- runs ---------------------------------------------------------------

    def _run(self, level: int, number: int) -> str:
        return f"{self.root}/runs/level={level}/run={number}"

    def live_runs(self, batches: int) -> list[tuple[int, int]]:
        """(level, number) of the runs that hold the first ``batches`` batches:
        run k of level l holds the batches from k * fan_in**l on."""
        level = 0
        while self.fan_in ** (level + 1) <= batches:
            level += 1
        runs, at = [], 0
        for lv in range(level, -1, -1):
            size = self.fan_in ** lv
            while at + size <= batches:
                runs.append((lv, at // size))
                at += size
        return runs

    def _merged_at(self, batches: int) -> list[int]:
        """Levels whose next run is complete after ``batches`` batches."""
        levels, size = [], self.fan_in
        while batches and batches % size == 0:
            levels.append(len(levels) + 1)
            size *= self.fan_in
        return levels

    def _folder(self, spark: SparkSession, path: str):
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p

    def batches(self, spark: SparkSession) -> int:
        """Micro-batches whose state is complete."""
        fs, path = self._folder(spark, f"{self.root}/commits")
        if not fs.exists(path):
            return 0
        return max((int(f.getPath().getName()) + 1 for f in fs.listStatus(path)), default=0)

    def _commit(self, spark: SparkSession, batch_id: int) -> None:
        fs, path = self._folder(spark, f"{self.root}/commits/{batch_id}")
        fs.create(path, True).close()
        fs, old = self._folder(spark, f"{self.root}/commits/{batch_id - 2}")
        fs.delete(old, False)

    def _forget(self, spark: SparkSession, batches: int) -> None:
        """Removes the runs that were merged when ``batches`` were complete. They
        serve a reader of that time until two more batches have come."""
        for level in self._merged_at(batches):
            last = batches // self.fan_in ** (level - 1)
            for number in range(last - self.fan_in, last):
                fs, path = self._folder(spark, self._run(level - 1, number))
                fs.delete(path, True)

    # --- state --------------------------------------------------------------

    @property
    def groups(self) -> list[str]:
        return list(dict.fromkeys((KEY, *self.params.partition_by)))

    def _order(self) -> list[golden.OrderKey]:
        return [o for o in self.params.order if o.col not in golden._GROUP_CONSTANT]

    def partial(self, identified: DataFrame) -> DataFrame:
        """The state of one set of records: one aggregate, combined map-side."""
        rows = identified if self.params.how == "left" else identified.filter(F.col(KEY).isNotNull())
        pref = golden.preference_key(rows, self._order()).alias("pref")
        data = [c for c in rows.columns if c != KEY]
        if self.params.survivorship == "row":
            best = [F.min(F.struct(pref, F.struct(*data).alias("row"))).alias("best")]
        else:
            best = [F.min(pref).alias("top")] + [
                F.min(F.when(F.col(c).isNotNull(), F.struct(pref, F.col(c).alias("value")))).alias(f"best_{c}") for c in data]
        return rows.groupBy(*self.groups).agg(F.count(F.lit(1)).alias("n"), *best)

    def merge(self, state: DataFrame, groups: list[str] | None = None) -> DataFrame:
        """State rows of equal groups as one."""
        groups = groups or self.groups
        rest = [c for c in state.columns if c not in (*self.groups, "n")]
        return state.groupBy(*groups).agg(F.sum("n").alias("n"), *(F.min(c).alias(c) for c in rest))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = self.batches(spark)
        if batch_id not in (done, done - 1):
            raise ValueError(f"batch {batch_id} cannot follow {done} batches in {self.root}: state and checkpoint do not belong together")
        self._forget(spark, batch_id - 1)
        self.partial(batch).write.mode("overwrite").parquet(self._run(0, batch_id))
        for level in self._merged_at(batch_id + 1):
            last = (batch_id + 1) // self.fan_in ** (level - 1)
            runs = [self._run(level - 1, k) for k in range(last - self.fan_in, last)]
            self.merge(spark.read.parquet(*runs)).write.mode("overwrite").parquet(self._run(level, last // self.fan_in - 1))
        self._commit(spark, batch_id)

    def state(self, spark: SparkSession) -> DataFrame:
        """All rows of the live runs, not yet merged."""
        runs = self.live_runs(self.batches(spark))
        if not runs:
            raise ValueError(f"no batch in {self.root} yet")
        return spark.read.parquet(*(self._run(*r) for r in runs))

    # --- what the state tells -----------------------------------------------

    def counts(self, spark: SparkSession) -> DataFrame:
        """A1 over all batches: rows of each identifier."""
        return self.state(spark).groupBy(KEY).agg(F.sum("n").alias("repetition"))

    def _labelled(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``repetition`` as confidence and its rank."""
        repetition = F.when(F.col(KEY).isNotNull(), F.col("repetition"))
        label = N.confidence(repetition, self.params.high_above, self.params.moderate_at)
        out = rows.withColumn("confidence", label).drop("repetition")
        return out.withColumn("confidence_rank", N.confidence_rank("confidence"))

    def _full_preference(self, pref: str) -> Column:
        """A stored preference with the ranks that are the identifier's."""
        fields, stored = [], 0
        for o in self.params.order:
            if o.col in golden._GROUP_CONSTANT:
                rank = F.col("confidence_rank")
                fields += [F.lit(False), -rank if o.descending else rank]
            else:
                fields += [F.col(f"{pref}.p{stored}"), F.col(f"{pref}.v{stored}")]
                stored += 1
        return F.struct(*(f.alias(f"f{k}") for k, f in enumerate(fields)))

    def golden_by_identifier(self, spark: SparkSession) -> DataFrame:
        """G4/G5 per identifier: one aggregate over the state."""
        merged = self.merge(self.state(spark), [KEY]).withColumnRenamed("n", "repetition")
        if self.params.survivorship == "row":
            rows = self._labelled(merged.select("best.row.*", KEY, "repetition"))
            return rows.withColumn("row_num", F.lit(1))
        values = [F.col(f"{c}.value").alias(c.removeprefix("best_")) for c in merged.columns if c.startswith("best_")]
        return self._labelled(merged.select(*values, KEY, "repetition"))

    def golden(self, spark: SparkSession) -> DataFrame:
        """The golden table per ``params.partition_by``."""
        if self.groups == [KEY]:
            best = self.golden_by_identifier(spark)
            first = list(settings.SCORED_COLUMNS)
            return best.select(*first, *(c for c in best.columns if c not in first))
        pairs = self.merge(self.state(spark))
        # Written, so that both sides of the join are exchanges of their own and
        # an identifier with very many groups can be split.
        counts = materialize(self.counts(spark), "state")
        keyed = self._labelled(pairs.filter(F.col(KEY).isNotNull()).join(counts, KEY))
        keyless = self._labelled(pairs.filter(F.col(KEY).isNull()).withColumn("repetition", F.lit(None).cast("long")))
        rows = keyed.unionByName(keyless) if self.params.how == "left" else keyed
        if self.params.survivorship == "row":
            scored = rows.select("best.row.*", KEY, "confidence").select(*settings.SCORED_COLUMNS)
            return golden.golden_records(scored, self.params.partition_by, self.params.order)
        by = self.params.partition_by
        stored = [c.removeprefix("best_") for c in rows.columns if c.startswith("best_")]
        aggs = {c: F.min_by(F.col(f"best_{c}.value"), F.when(F.col(f"best_{c}").isNotNull(), self._full_preference(f"best_{c}.pref"))) for c in stored}
        for c in (KEY, "confidence", "confidence_rank"):
            aggs[c] = F.min_by(F.col(c), F.when(F.col(c).isNotNull(), self._full_preference("top")))
        columns = [c for c in (*settings.SCORED_COLUMNS, "confidence_rank") if c not in by]
        return rows.groupBy(*by).agg(*(aggs[c].alias(c) for c in columns))

    def publish(self, spark: SparkSession) -> dict[str, str]:
        """Writes counts and golden tables for readers; table -> path."""
        frames = {"gold_duplicate_count": self.counts(spark), "gold_by_identifier": self.golden_by_identifier(spark), "gold_final": self.golden(spark)}
        for name, frame in frames.items():
            frame.write.mode("overwrite").parquet(f"{self.root}/{name}")
        return {name: f"{self.root}/{name}" for name in frames}
