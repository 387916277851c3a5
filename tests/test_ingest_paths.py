"""Ways in and out: keys of several columns, table changes, stream dedup,
bucketed tables, malformed records, changing schemas, ingest sketches."""

import json
import os
import random
import time
import uuid
from itertools import combinations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from goldenrec.operators import composite_keys, golden, ingest_sketches, snapshot
from goldenrec.plans import layers
from goldenrec.plans.persons import persons
from goldenrec.sources import checked, readers, sinks
from goldenrec.sources.spec import custom_spec
from goldenrec.streaming import dedup, jobs
from shared_fixtures import SF0001, write_text


# --- keys of several columns -----------------------------------------------------

def slow_keys(rows, columns, most):
    found = []
    for n in range(1, most + 1):
        for s in combinations(range(len(columns)), n):
            values = [tuple(r[k] for k in s) for r in rows]
            if rows and all(None not in v for v in values) and len(set(values)) == len(values) and not any(set(f) <= set(s) for f in found):
                found.append(s)
    return [tuple(columns[k] for k in s) for s in found]


@pytest.mark.parametrize("seed", range(4))
def test_minimal_keys(spark, seed):
    rng = random.Random(seed)
    columns = ["a", "b", "c", "d", "e"]
    n, wide = 60, [4, 8, 15, 30, 400]
    rows = [tuple(None if rng.random() < 0.002 * seed else rng.randrange(w) for w in wide) for _ in range(n)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d int, e int")
    assert composite_keys.minimal_keys(df, columns, 3) == slow_keys(rows, columns, 3)


def test_keys_of_an_empty_table_and_of_repeated_rows(spark):
    assert composite_keys.minimal_keys(spark.createDataFrame([], "a int, b int")) == []
    twice = spark.createDataFrame([(1, 2), (1, 2), (1, 3)], "a int, b int")
    assert composite_keys.key_report(twice, most_columns=2).count() == 0


# --- changes between two tables -----------------------------------------------------

@pytest.mark.parametrize("seed", range(3))
def test_changes_make_the_new_table_of_the_old(spark, tmp_dir, seed):
    rng = random.Random(seed)

    def version():
        return [(k if k else None, rng.choice([None, "", "x", "y"]), rng.choice([None, 1.5, 2.0])) for k in range(40) if rng.random() < 0.7]

    old, new = version(), version()
    a, b = (spark.createDataFrame(v, "k int, s string, d double") for v in (old, new))
    diff = snapshot.changes(a, b, ["k"])
    got = [((r.k, r.s, r.d), r._change) for r in diff.collect()]
    was, now = {r[0]: r for r in old}, {r[0]: r for r in new}
    want = [(now[k], "inserted" if k not in was else "changed") for k in now if was.get(k) != now[k] or k not in was] + [(was[k], "removed") for k in was if k not in now]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert sorted(map(repr, (tuple(r) for r in snapshot.apply_changes(a, diff, ["k"]).collect()))) == sorted(map(repr, new))
    snapshot.write_changes(None, a, ["k"], f"{tmp_dir}/d", 0)
    snapshot.write_changes(a, b, ["k"], f"{tmp_dir}/d", 1)
    snapshot.write_changes(a, b, ["k"], f"{tmp_dir}/d", 1)  # a rerun
    counts = {r["run"]: r["count"] for r in spark.read.parquet(f"{tmp_dir}/d").groupBy("run").count().collect()}
    assert counts.get(0, 0) == len(old) and counts.get(1, 0) == len(want)


def test_changes_need_equal_columns(spark):
    with pytest.raises(ValueError):
        snapshot.changes(spark.range(2), spark.range(2).withColumn("x", F.lit(1)), ["id"])


# --- dedup of a stream -----------------------------------------------------------------

def test_repeats_late_rows_and_bounded_state(spark, tmp_dir):
    """Batches of ten minutes each; a delay of fifteen minutes."""
    schema = "k int, ts timestamp"
    batches = [[(100 * b + k, f"2024-01-01 {b // 6:02d}:{b % 6}{k % 10}:00") for k in range(10)] for b in range(12)]
    batches[1] += [(0, "2024-01-01 00:12:00"), (5, "2024-01-01 00:11:00")]  # repeats within the delay
    batches[9] += [(77777, "2024-01-01 00:01:00")]  # far too late
    batches[9] += [(None, "2024-01-01 01:31:00"), (None, "2024-01-01 01:32:00")]
    for rows in batches:
        df = spark.createDataFrame(rows, "k int, ts string").withColumn("ts", F.to_timestamp("ts"))
        df.coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
        time.sleep(0.05)
    stream = jobs.bronze_stream(spark, f"{tmp_dir}/in", StructType.fromDDL(schema), max_files_per_trigger=1)
    q = jobs.run_to_parquet(dedup.drop_repeats(stream, ["k"], "ts", "15 minutes"), f"{tmp_dir}/out", f"{tmp_dir}/ck")
    got = sorted((r.k is None, r.k or 0) for r in spark.read.parquet(f"{tmp_dir}/out").collect())
    assert got == sorted([(False, 100 * b + k) for b in range(12) for k in range(10)] + [(True, 0)])
    states = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert max(states) <= 45  # of 121 keys: about the delay and two batches
    with pytest.raises(ValueError):
        dedup.drop_repeats(stream, [], "ts", "1 minute")


# --- bucketed tables -----------------------------------------------------------------------

def test_bucketed_tables_need_no_exchange(spark):
    silver = layers.silver_identified(persons(spark, SF0001))
    name = sinks.save_bucketed(silver, f"t_{uuid.uuid4().hex}", golden.KEY, 4)
    try:
        kept = spark.read.table(name)
        by_id = layers.PipelineParams(partition_by=(golden.KEY,))
        for found, plain in ((golden.duplicate_count(kept), golden.duplicate_count(silver)),
                             (layers.gold_from_identified(kept, by_id).golden, layers.gold_from_identified(silver, by_id).golden)):
            assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
            assert sorted(map(repr, found.collect())) == sorted(map(repr, plain.collect()))
    finally:
        spark.sql(f"drop table {name}")


# --- malformed records ------------------------------------------------------------------------

@pytest.mark.parametrize("streaming", [False, True])
@pytest.mark.parametrize("fmt", ["json", "csv"])
def test_malformed_records_are_kept_with_their_text(spark, tmp_dir, fmt, streaming):
    if fmt == "json":
        good, bad = ['{"id":1,"n":"a"}', '{"id":2,"n":null}', '{"id":4}'], ['{"id":3,', "nonsense", '{"id":"x","n":"b"}']
        write_text(f"{tmp_dir}/in/a.json", "\n".join([good[0], bad[0], good[1]]) + "\n")
        write_text(f"{tmp_dir}/in/sub/b.json", "\n".join([bad[1], good[2], bad[2]]) + "\n")
    else:
        good, bad = ["1,a", "2,", "4,d"], ["3,b,more", "x,e"]
        write_text(f"{tmp_dir}/in/a.csv", "\n".join(["id,n", good[0], bad[0], good[1]]) + "\n")
        write_text(f"{tmp_dir}/in/sub/b.csv", "\n".join(["id,n", good[2], bad[1]]) + "\n")
    spec = custom_spec("s", f"{tmp_dir}/in", ["id"], file_format=fmt, schema=StructType.fromDDL("id int, n string"), quality_rules={"named": "n IS NOT NULL"})
    rows = checked.read_checked(spark, spec, streaming=streaming, max_files_per_trigger=1 if streaming else None)
    if streaming:
        jobs.run_to_parquet(rows, f"{tmp_dir}/out", f"{tmp_dir}/ck")
        rows = spark.read.parquet(f"{tmp_dir}/out")
    kept, quarantined = (x.collect() for x in checked.split_checked(rows, spec.expectations()))
    assert len(kept) + len(quarantined) == len(good) + len(bad)
    assert sorted(r._corrupt_record for r in quarantined if r._failed_rules == [checked.MALFORMED]) == sorted(bad)
    assert {r.id for r in quarantined if r._failed_rules == ["named"]} == ({2, 4} if fmt == "json" else {2})
    assert {os.path.basename(r._source_file) for r in quarantined} == {f"a.{fmt}", f"b.{fmt}"}
    assert checked.FILE in kept[0].__fields__ and checked.CORRUPT not in kept[0].__fields__


def test_checked_reads_need_a_schema(spark):
    with pytest.raises(ValueError):
        checked.read_checked(spark, custom_spec("s", "/x", ["id"], file_format="json"))


# --- schemas that follow their source ------------------------------------------------------------

def test_merge_schemas():
    of = StructType.fromDDL
    merged = checked.merge_schemas(of("a int, b string, c date, gone long, x boolean"), of("new double, a long, b int, c timestamp, x boolean"))
    assert merged == of("a long, b string, c timestamp, gone long, x boolean, new double")
    assert checked.merge_schemas(merged, of("a boolean")).fields[0].dataType.simpleString() == "string"


def test_schema_versions_over_restarts(spark, tmp_dir):
    spec = custom_spec("s", f"{tmp_dir}/in", ["id"], file_format="json", read_options={"multiLine": "false"})
    seen = []
    for at, lines in enumerate([[{"id": 1}, {"id": 2}], [{"id": 3}], [{"id": 4, "extra": "e"}], [{"id": 2.5, "other": True}]]):
        write_text(f"{tmp_dir}/in/{at}.json", "\n".join(map(json.dumps, lines)) + "\n")
        schema, version = checked.evolving_schema(spark, spec, f"{tmp_dir}/schema")
        seen.append(version)
        stream = readers.read_stream(spark, spec, schema=schema).select("id", *(c for c in ("extra", "other") if c in schema.names))
        jobs.run_to_parquet(stream.withColumn("id", F.col("id").cast("double")), f"{tmp_dir}/out", f"{tmp_dir}/ck")
    assert seen == [1, 1, 2, 3]
    rows = spark.read.schema("id double, extra string, other boolean").parquet(f"{tmp_dir}/out").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1.0, None, None), (2.0, None, None), (2.5, None, True), (3.0, None, None), (4.0, "e", None)]
    with pytest.raises(ValueError):
        checked.evolving_schema(spark, custom_spec("s", "/x", ["id"]), "/y")


# --- ingest sketches ----------------------------------------------------------------------------------

def test_sketches_add_up_and_a_day_is_replaced(spark, tmp_dir):
    feed = spark.range(30000).select((F.col("id") % 9000).alias("key"), F.expr("date_add(date'2024-01-01', cast(id % 6 as int))").alias("day"))
    rows = ingest_sketches.ingest_row(feed, "feed", "day", ["key"])
    ingest_sketches.save_ingest(rows, f"{tmp_dir}/s")
    ingest_sketches.save_ingest(rows.filter("day = date'2024-01-03'"), f"{tmp_dir}/s")  # ingested again
    ingest_sketches.save_ingest(ingest_sketches.ingest_row(feed.limit(10), "other", F.lit("2024-01-01"), ["key"]), f"{tmp_dir}/s")
    kept = spark.read.parquet(f"{tmp_dir}/s")
    assert kept.count() == 7
    whole = {r.source_type: r for r in ingest_sketches.totals(kept).collect()}
    assert (whole["feed"].total_records, whole["other"].total_records) == (30000, 10)
    assert abs(whole["feed"].unique_records - 9000) < 0.03 * 9000
    part = feed.filter("day < date'2024-01-03'")
    some = ingest_sketches.totals(kept.filter("source_type = 'feed' and day < date'2024-01-03'")).first()
    assert some.total_records == part.count() and abs(some.unique_records - part.select("key").distinct().count()) < 0.03 * 9000
