import os
import sys

import duckdb
import pytest

from shared_fixtures import ROOT, SF0001
from goldenrec.operators import golden
from goldenrec.plans import layers as ip
from goldenrec.plans.persons import TABLES, persons

sys.path.insert(0, os.path.join(ROOT, "scripts"))
from check_oracle import digest  # noqa: E402

import __spark_entry__ as entry_mod  # noqa: E402

# Queries that write and stream files first; covered by their own tests.
SIDE_EFFECT_PREFIXES = ("stream_", "source_table_", "pre_bronze_", "custom_dataset", "source_inventory",
                        "api_logs_quality")


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_physical(df) -> str:
    df.collect()  # AQE plans are final only after execution
    return executed(df)


def _identified(spark, tmp_dir):
    path = f"{tmp_dir}/identified"
    ip.silver_identified(persons(spark, SF0001)).write.parquet(path)
    return spark.read.parquet(path)


def test_duplicate_count_one_exchange_with_partial_aggregation(spark, tmp_dir):
    counts = golden.duplicate_count(_identified(spark, tmp_dir))
    plan = counts._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Exchange hashpartitioning(unique_identifier") == 0  # sparkPlan: before EnsureRequirements
    final = counts._jdf.queryExecution().executedPlan().toString()
    assert final.count("Exchange hashpartitioning(unique_identifier") == 1
    assert "partial_count" in final


def test_golden_uses_partial_window_group_limit(spark, tmp_dir):
    scored = golden.score(_identified(spark, tmp_dir), hot_keys=None)
    plan = executed(golden.golden_records(scored))
    assert plan.count("WindowGroupLimit") == 2  # before and after the exchange on name
    assert "Exchange hashpartitioning(name" in plan


def test_three_exchanges_without_broadcast(spark, tmp_dir):
    ided = _identified(spark, tmp_dir)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(golden.golden_records(golden.score(ided, hot_keys=None)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # aggregate on the id, the record side of the join on the id, the window on name
    assert plan.count("Exchange hashpartitioning(unique_identifier") == 2
    assert plan.count("Exchange hashpartitioning(name") == 1


def test_golden_by_identifier_is_one_aggregate(spark, tmp_dir):
    ided = _identified(spark, tmp_dir)
    for mode in ("row", "attribute"):
        res = ip.gold_from_identified(ided, ip.PipelineParams(partition_by=("unique_identifier",), survivorship=mode))
        plan = executed(res.golden)
        assert plan.count("Exchange") == 1 and "Join" not in plan and "Window" not in plan, mode
        assert "partial_min_by" in plan


def test_survivorship_is_an_aggregate_not_a_window(spark, tmp_dir):
    scored = golden.score(_identified(spark, tmp_dir))
    plan = executed(golden.survivorship(scored))
    assert "Window" not in plan and "min_by" in plan


def test_no_python_udf_in_registered_queries(spark):
    for name, fn in entry_mod.queries().items():
        if name.startswith(SIDE_EFFECT_PREFIXES):
            continue
        plan = executed(fn(spark, SF0001))
        assert "EvalPython" not in plan and "PythonUDF" not in plan, name


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() == 18
    assert df.columns[-2:] == ["confidence_rank", "row_num"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF0001}/{t}.parquet')")
    return con


def test_every_oracle_has_a_query():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", sorted(entry_mod.oracle_sql()))
def test_query_matches_oracle_sf0001(spark, duck, name):
    sdf = entry_mod.queries()[name](spark, SF0001).toPandas()
    ddf = duck.execute(entry_mod.oracle_sql()[name]).df()
    assert digest(sdf) == digest(ddf)


def test_hash_and_products_take_all_columns(spark, tmp_dir):
    from pyspark.sql import functions as F

    queries = entry_mod.queries()
    orders = spark.read.parquet(f"{SF0001}/orders.parquet")
    key = F.col("o_orderkey")
    orders.withColumn("o_totalprice", F.when(key % 3 == 1, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))).withColumn(
        "o_orderdate", F.when(key % 3 == 2, F.col("o_orderdate") + F.expr("interval 1 day")).otherwise(F.col("o_orderdate"))).write.parquet(f"{tmp_dir}/orders.parquet")
    before, after = ({r["o_orderkey"]: r["_record_hash"] for r in queries["record_hash_all_columns"](spark, d).collect()} for d in (SF0001, tmp_dir))
    assert len(before) == orders.count() and all((before[k] != after[k]) == (k % 3 != 0) for k in before)
    found = queries["products_standardized_all_columns"](spark, SF0001)
    assert {"brand", "price", "currency", "stock_quantity", "weight_kg"} < set(found.columns)


def test_hot_identifier_needs_the_explicit_split(spark, tmp_dir):
    """One identifier holds a third of all rows. AQE's skew-join rule does not
    split it (the count side reaches the join through an aggregate), so the
    pipeline splits hot identifiers out itself: their records join through a
    broadcast of at most K (key, count) rows and are never shuffled."""
    from pyspark.sql import functions as F

    n = 30_000
    rows = spark.range(n).select(
        F.col("id").alias("person_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot@x.io"))
        .otherwise(F.concat(F.lit("u"), (F.col("id") % 5000).cast("string"), F.lit("@x.io"))).alias("unique_identifier"),
        (F.col("id") % 97).cast("string").alias("name"),
        (F.col("id") % 80).cast("int").alias("age"),
    )
    rows.repartition(8).write.parquet(f"{tmp_dir}/hot")
    ided = spark.read.parquet(f"{tmp_dir}/hot")
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        cols = ["person_id", "name", "age", "unique_identifier", "confidence"]
        plain = golden.score(ided, columns=cols, hot_keys=None)
        assert "skew=true" not in optimized_physical(plain)
        split = golden.score(ided, columns=cols, hot_keys=1000)
        plan = optimized_physical(golden.golden_records(split))
        assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
        # the shuffle join sees no hot rows: its left side is the anti-join output
        assert sorted(repr(tuple(r)) for r in plain.collect()) == sorted(repr(tuple(r)) for r in split.collect())
        assert split.count() == n
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
