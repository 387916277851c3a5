"""The spark-submit job entry points, run in-process on small folders."""

import pytest
from pyspark.sql import functions as F

from shared_fixtures import write_text
from goldenrec import jobs

RAW = "person_id,name,email,phone,age\n{rows}"


def _raw(tmp_dir):
    write_text(f"{tmp_dir}/raw/SAP/a.csv", RAW.format(rows="1,ann,A@X.IO,+1-2,30\n2,ann,a@x.io,,41\n3,bo,,,n/a\n"))
    write_text(f"{tmp_dir}/raw/salesforce/b.csv", RAW.format(rows="4,Ann,a@x.io,5,50\n5,cy,,+7,22\n"))
    return f"{tmp_dir}/raw"


def test_identity_job(spark, tmp_dir):
    out = jobs.main(["identity", "--bronze", _raw(tmp_dir), "--out", f"{tmp_dir}/t"], spark)
    gold = {r["name"]: r["person_id"] for r in spark.read.parquet(out["gold_final"]).collect()}
    assert gold == {"Ann": 4, "Bo": 3, "Cy": 5}
    rep = {r["rule"]: (r["passed"], r["failed"]) for r in spark.read.parquet(out["bronze_quality"]).collect()}
    assert rep == {"valid_person_id": (5, 0), "valid_age": (4, 1)}
    scored = spark.read.parquet(out["gold_confidence_scored"])
    assert scored.filter(F.col("confidence") == "High").count() == 3


def test_stream_job_matches_identity_job(spark, tmp_dir):
    raw = _raw(tmp_dir)
    batch = jobs.main(["identity", "--bronze", raw, "--out", f"{tmp_dir}/b"], spark)
    stream = jobs.main(["stream", "--bronze", raw, "--out", f"{tmp_dir}/s", "--checkpoint", f"{tmp_dir}/ck",
                        "--max-files", "1", "--buckets", "4"], spark)
    a = sorted(tuple(r) for r in spark.read.parquet(batch["gold_final"]).collect())
    b = sorted(tuple(r) for r in spark.read.parquet(stream["gold_final"]).drop("name_bucket").collect())
    assert a == b


def test_sources_job(spark, tmp_dir):
    from shared_fixtures import SF0001
    from goldenrec.plans import source_tables as st

    base = st.write_sample_sources(spark, SF0001, f"{tmp_dir}/src")
    out = jobs.main(["sources", "--base", base, "--out", f"{tmp_dir}/pb"], spark)
    mon = {r["source_type"]: r["total_records"] for r in spark.read.parquet(out["pre_bronze_unified_metadata"]).collect()}
    assert mon == {"customers": 300, "products": 400, "orders": 6000, "employees": 10, "inventory": 200}
    rep = spark.read.parquet(out["pre_bronze_customers_quality"]).collect()
    assert {r["rule"] for r in rep} == {"valid_customer_id", "valid_email_format", "valid_name"}
    assert all(r["failed"] == 0 for r in rep)


def test_fixed_and_line_oriented_sources_jobs(spark, sample_sources, tmp_dir):
    from shared_fixtures import SF0001
    from goldenrec.plans import source_tables as st

    base = st.write_sample_sources(spark, SF0001, f"{tmp_dir}/src")
    fixed = jobs.main(["sources", "--base", base, "--out", f"{tmp_dir}/f", "--fixed"], spark)
    rep = {r["rule"] for r in spark.read.parquet(fixed["pre_bronze_products_quality"]).collect()}
    assert rep == {"valid_product_id", "valid_sku", "valid_price"}
    products = spark.read.parquet(fixed["pre_bronze_products"])
    want = st.products_table(spark, base).select("product_id", "category", "is_active")
    assert sorted(products.select(want.columns).collect()) == sorted(want.collect())
    lines = jobs.main(["sources", "--base", base, "--out", f"{tmp_dir}/l", "--line-oriented"], spark)
    assert spark.read.parquet(lines["pre_bronze_orders"]).count() == spark.read.parquet(fixed["pre_bronze_orders"]).count() == 6000


def test_identity_job_writes_every_layer(spark, tmp_dir):
    out = jobs.main(["identity", "--bronze", _raw(tmp_dir), "--out", f"{tmp_dir}/t", "--rule-mode", "drop"], spark)
    bronze, clean, known = (spark.read.parquet(out[k]) for k in ("bronze", "silver_clean", "silver_identified"))
    assert bronze.count() == 5 and "source_file_path" in bronze.columns
    assert clean.count() == known.count() == 4 and known.columns == [*clean.columns, "unique_identifier"]


def test_profile_job(spark, sample_sources, tmp_dir):
    out = jobs.main(["profile", "--path", f"{sample_sources}/customers/sap/customers_a.csv", "--out",
                     f"{tmp_dir}/p"], spark)
    types = {r["column_name"]: r["inferred_type"] for r in spark.read.parquet(out["profile"]).collect()}
    assert types["registration_date"] == "date"


def _gold(spark, out, *drop):
    return sorted(tuple(r) for r in spark.read.parquet(out).drop(*drop).collect())


def test_stream_rerun_without_checkpoint_option_counts_nothing_twice(spark, tmp_dir):
    raw = _raw(tmp_dir)
    batch = jobs.main(["identity", "--bronze", raw, "--out", f"{tmp_dir}/b"], spark)
    args = ["stream", "--bronze", raw, "--out", f"{tmp_dir}/s", "--buckets", "4"]
    for more in (["--max-files", "1"], [], ["--max-files", "1"]):
        stream = jobs.main(args + more, spark)
        assert _gold(spark, stream["gold_final"], "name_bucket") == _gold(spark, batch["gold_final"])
        scored = spark.read.parquet(stream["gold_confidence_scored"]).drop("bucket", "name_bucket")
        assert scored.count() == spark.read.parquet(batch["gold_confidence_scored"]).count()


def test_stream_refuses_tables_without_their_checkpoint(spark, tmp_dir):
    args = ["stream", "--bronze", _raw(tmp_dir), "--out", f"{tmp_dir}/s", "--buckets", "4"]
    jobs.main(args, spark)
    with pytest.raises(ValueError, match="checkpoint"):
        jobs.main(args + ["--checkpoint", f"{tmp_dir}/other"], spark)


def test_replay_after_an_interrupted_commit_restores_all_rows(spark, tmp_dir):
    from goldenrec.plans import layers
    from goldenrec.streaming import jobs as sj

    rows = [(k, f"n{k % 40}", f"a{k % 70}@x.io", None, 20 + k % 50, f"/SAP/{k}") for k in range(200)]
    bronze = spark.createDataFrame(rows, "person_id long, name string, email string, phone string, age int, source_file_path string")
    silver = layers.silver_identified(bronze)
    handler = sj.IncrementalGold(root=f"{tmp_dir}/g", buckets=4, name_buckets=4)
    first, second = silver.filter("person_id < 120"), silver.filter("person_id >= 120")
    handler(first, 0)
    handler(second, 1)
    whole = {p: _gold(spark, p) for p in (handler.scored_path, handler.golden_id_path, handler.golden_name_path)}
    for path in whole:  # a stop between deleting partitions and renaming their replacement
        kept = spark.read.parquet(path).filter("pmod(person_id, 3) <> 0").coalesce(1)
        part = "name_bucket" if path == handler.golden_name_path else "bucket"
        half = spark.createDataFrame(kept.collect(), kept.schema)
        half.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)
    handler(second, 1)
    got = spark.read.parquet(handler.scored_path)
    touched = {r["bucket"] for r in second.withColumn("bucket", sj.identity_bucket(buckets=4)).select("bucket").distinct().collect()}
    assert touched == {0, 1, 2, 3}
    assert got.count() == 200 and {p: _gold(spark, p) for p in whole} == whole


@pytest.mark.parametrize("how", ["row", "attribute"])
def test_string_ids_batch_and_stream(spark, tmp_dir, how):
    write_text(f"{tmp_dir}/raw/SAP/a.csv", RAW.format(rows="P1,ann,A@X.IO,+1-2,30\nP2,ann,a@x.io,,41\nP3,bo,,,n/a\n"))
    write_text(f"{tmp_dir}/raw/salesforce/b.csv", RAW.format(rows="P4,Ann,a@x.io,5,\nP5,cy,,+7,22\nP0,cy,,+7,22\n"))
    common = ["--bronze", f"{tmp_dir}/raw", "--survivorship", how]
    batch = jobs.main(["identity", *common, "--out", f"{tmp_dir}/b"], spark)
    stream = jobs.main(["stream", *common, "--out", f"{tmp_dir}/s", "--max-files", "1", "--buckets", "4"], spark)
    a, b = spark.read.parquet(batch["gold_final"]), spark.read.parquet(stream["gold_final"]).drop("name_bucket")
    assert set(a.columns) == set(b.columns) and ("row_num" in a.columns) == (how == "row")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(a.columns).collect()))
    ids = {r["name"]: r["person_id"] for r in a.collect()}
    assert ids == {"Ann": "P2", "Bo": "P3", "Cy": "P0"}


def test_scoring_jobs_split_hot_identifiers_by_default():
    from goldenrec import settings

    for job in ("identity", "stream"):
        a = jobs.parser().parse_args([job, "--bronze", "x", "--out", "y"])
        assert jobs._params(a).hot_keys == settings.HOT_KEY_MAX_KEYS


def test_stream_job_with_mergeable_state(spark, tmp_dir):
    raw = _raw(tmp_dir)
    batch = jobs.main(["identity", "--bronze", raw, "--out", f"{tmp_dir}/b"], spark)
    for _ in range(2):  # a rerun finds no new file and counts nothing twice
        stream = jobs.main(["stream", "--bronze", raw, "--out", f"{tmp_dir}/s", "--max-files", "1", "--merge-state"], spark)
        for table in ("gold_final", "gold_duplicate_count"):
            a, b = spark.read.parquet(batch[table]), spark.read.parquet(stream[table])
            assert sorted(tuple(r) for r in b.select(a.columns).collect()) == sorted(tuple(r) for r in a.collect())
