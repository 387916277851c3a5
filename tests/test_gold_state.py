"""Mergeable golden state: any cut into batches, replays and restarts."""

import os

import pytest
from pyspark.sql import functions as F

from goldenrec.operators.golden import OrderKey
from goldenrec.plans import layers
from goldenrec.plans.persons import persons
from goldenrec.streaming.state import GoldState
from shared_fixtures import SF0001


def rows(df):
    cols = sorted(df.columns)
    return sorted(map(repr, df.select(*cols).collect()))


@pytest.fixture(scope="module")
def identified(spark):
    p = persons(spark, SF0001)
    odd = p.limit(0).unionByName(p.filter("person_id % 50 = 0").select(
        (F.col("person_id") + 100000).alias("person_id"), "name", F.lit(None).cast("string").alias("email"), F.lit(None).cast("string").alias("phone"),
        F.lit(None).cast("string").alias("age"), "source_file_path"))
    df = layers.silver_identified(p.unionByName(odd)).cache()
    df.count()
    return df


def fed(spark, identified, root, n, params=layers.PipelineParams(), fan_in=3):
    state = GoldState(root=root, params=params, fan_in=fan_in)
    for k in range(n):
        state(identified.filter(F.pmod(F.xxhash64("person_id"), F.lit(n)) == k), k)
    return state


@pytest.mark.parametrize("n", [1, 3, 7])
def test_any_number_of_batches_gives_the_batch_answer(spark, identified, tmp_dir, n):
    state = fed(spark, identified, f"{tmp_dir}/s", n)
    whole = layers.gold_from_identified(identified)
    assert rows(state.golden(spark)) == rows(whole.golden)
    assert rows(state.counts(spark)) == rows(whole.counts)
    by_id = layers.gold_from_identified(identified, layers.PipelineParams(partition_by=("unique_identifier",))).golden
    assert rows(state.golden_by_identifier(spark)) == rows(by_id)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("survivorship", ["row", "attribute"])
@pytest.mark.parametrize("by", ["name", "unique_identifier"])
def test_parameters(spark, identified, tmp_dir, how, survivorship, by):
    some = identified.withColumn("unique_identifier", F.when(F.col("person_id") % 9 > 0, F.col("unique_identifier")))
    params = layers.PipelineParams(how=how, survivorship=survivorship, partition_by=(by,))
    state = fed(spark, some, f"{tmp_dir}/s", 3, params, fan_in=2)
    assert rows(state.golden(spark)) == rows(layers.gold_from_identified(some, params).golden)


def test_rank_may_come_after_another_key(spark, identified, tmp_dir):
    params = layers.PipelineParams(order=(OrderKey("age"), OrderKey("confidence_rank"), OrderKey("person_id", descending=False)))
    state = fed(spark, identified, f"{tmp_dir}/s", 3, params)
    assert rows(state.golden(spark)) == rows(layers.gold_from_identified(identified, params).golden)


def test_replay_and_a_stop_before_the_marker(spark, identified, tmp_dir):
    expect = rows(layers.gold_from_identified(identified).golden)
    state = fed(spark, identified, f"{tmp_dir}/s", 4, fan_in=2)
    last = identified.filter(F.pmod(F.xxhash64("person_id"), F.lit(4)) == 3)
    state(last, 3)  # replayed after its marker
    assert rows(state.golden(spark)) == expect
    os.remove(f"{tmp_dir}/s/commits/3")  # stopped just before its marker
    assert state.batches(spark) == 3
    seen = sum(r.repetition for r in state.counts(spark).collect())
    assert seen == identified.count() - last.count()  # a reader sees three whole batches
    state(last, 3)
    assert rows(state.golden(spark)) == expect
    for wrong in (0, 1, 2, 5):
        with pytest.raises(ValueError, match="cannot follow"):
            state(last, wrong)


def test_a_batch_reads_only_itself_and_runs_stay_few(spark, identified, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/in"
    identified.repartition(20).write.parquet(path)
    files = sorted(f"{path}/{f}" for f in os.listdir(path) if f.endswith(".parquet"))
    state = GoldState(root=f"{tmp_dir}/s", fan_in=3)
    read = []
    merge = GoldState.merge
    monkeypatch.setattr(GoldState, "merge", lambda self, df, groups=None: (read.append(len(df.inputFiles())), merge(self, df, groups))[1])
    for k, f in enumerate(files):
        batch = spark.read.parquet(f)
        assert {os.path.basename(x) for x in state.partial(batch).inputFiles()} == {os.path.basename(f)}
        before = len(read)
        state(batch, k)
        # besides itself, a batch reads runs only where a level is complete
        assert len(read) - before == len(state._merged_at(k + 1))
        assert len(state.live_runs(k + 1)) <= 2 * 3
    kept = [d for lv in os.listdir(f"{tmp_dir}/s/runs") for d in os.listdir(f"{tmp_dir}/s/runs/{lv}")]
    assert len(kept) <= len(state.live_runs(len(files))) + 2 * 3
    assert rows(state.golden(spark)) == rows(layers.gold_from_identified(identified).golden)


def test_live_runs_hold_every_batch_once():
    for fan_in in (2, 3, 8):
        state = GoldState(root="", fan_in=fan_in)
        for n in range(0, 200):
            held = [b for lv, k in state.live_runs(n) for b in range(k * fan_in ** lv, (k + 1) * fan_in ** lv)]
            assert held == list(range(n))


def test_empty_batch_and_no_batch(spark, identified, tmp_dir):
    state = GoldState(root=f"{tmp_dir}/s")
    with pytest.raises(ValueError, match="no batch"):
        state.golden(spark)
    state(identified.limit(0), 0)
    assert state.golden(spark).count() == 0
    state(identified, 1)
    assert rows(state.golden(spark)) == rows(layers.gold_from_identified(identified).golden)
