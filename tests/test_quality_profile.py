from pyspark.sql import functions as F

from goldenrec.operators import profile, quality


def test_report_drop_quarantine_null_counts_as_failed(spark):
    df = spark.createDataFrame([(1, 5), (2, -1), (None, 3), (4, None)], "id int, qty int")
    rules = {"valid_id": "id IS NOT NULL", "valid_qty": "qty > 0"}
    rep = {r["rule"]: (r["passed"], r["failed"]) for r in quality.report(df, rules).collect()}
    assert rep == {"valid_id": (3, 1), "valid_qty": (2, 2)}
    assert sorted(r[0] for r in quality.keep_valid(df, rules).select("id").collect()) == [1]
    q = {r["id"]: list(r["_failed_rules"]) for r in quality.quarantine(df, rules).collect()}
    assert q == {2: ["valid_qty"], None: ["valid_id"], 4: ["valid_qty"]}
    valid, rejected = quality.split(df, rules)
    assert valid.count() + rejected.count() == df.count()


def test_key_rules_override(spark):
    rules = quality.with_key_rules({"valid_id": "id > 0", "other": "x"}, ["id"])
    assert rules == {"valid_id": "id IS NOT NULL", "other": "x"}


def test_rlike_and_in_rules(spark):
    df = spark.createDataFrame([("a.b@x.io", "NET30"), ("bad@", "NET45"), (None, None)], "email string, terms string")
    rules = {
        "fmt": r"email IS NULL OR email RLIKE '^[\\w\\.\\-]+@[\\w\\.\\-]+\\.[a-zA-Z]{2,}$'",
        "terms": 'terms IN ("NET30", "NET60", "NET90", "COD")',
    }
    rep = {r["rule"]: (r["passed"], r["failed"]) for r in quality.report(df, rules).collect()}
    assert rep == {"fmt": (2, 1), "terms": (1, 2)}


def test_drop_mode_filter_is_pushed_to_parquet(spark, tmp_dir):
    spark.createDataFrame([(1, 5.0), (2, -1.0)], "id int, qty double").write.parquet(f"{tmp_dir}/t")
    df = quality.keep_valid(spark.read.parquet(f"{tmp_dir}/t"), {"q": "qty >= 0"})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(qty), GreaterThanOrEqual(qty,0.0)]" in plan


def test_observe_rules_batch(spark):
    df = spark.createDataFrame([(1,), (None,)], "id int")
    out, obs = quality.observe_rules(df, {"valid_id": "id IS NOT NULL"})
    assert out.count() == 2
    assert obs.get == {"rows": 2, "failed_valid_id": 1}


def _profile(spark, values, name="c"):
    df = spark.createDataFrame([(v,) for v in values], f"{name} string")
    return profile.type_profile(df).first().asDict()


def test_type_inference_rules(spark):
    assert _profile(spark, ["0", "1", "1", "0"])["inferred_type"] == "boolean"
    assert _profile(spark, ["12", "13", "14", "15", "99999999999"])["inferred_type"] == "integer"  # 4/5 = 80 %
    assert _profile(spark, ["1", "2", "3", "99999999999"])["inferred_type"] == "string"  # "1" is boolean
    assert _profile(spark, ["99999999999", "88888888888"])["inferred_type"] == "double"
    assert _profile(spark, ["12", "22", "32", "1.5", "2.5"])["inferred_type"] == "string"  # 60/40 is not 80 %
    assert _profile(spark, ["2024-01-01", "2024-02-02"])["inferred_type"] == "date"
    assert _profile(spark, ["2024-01-01 10:00:00.5", "2024-01-01T11:00:00"])["inferred_type"] == "timestamp"
    assert _profile(spark, ["Yes", "no", "TRUE"])["inferred_type"] == "boolean"
    assert _profile(spark, [None, " ", ""])["inferred_type"] == "string"
    p = _profile(spark, ["5", None, "x", "6", "7", "8", "9"])
    assert p["inferred_type"] == "integer" and round(p["null_percentage"], 2) == 14.29
    assert p["non_blank"] == 6 and p["min_value"] == "5" and p["max_value"] == "x"


def test_semantic_patterns(spark):
    df = spark.createDataFrame([("a@b.io", "+1 (555) 010", "$12.50")], "e string, p string, m string")
    rows = {r["column_name"]: r for r in profile.type_profile(df, semantic=True).collect()}
    assert rows["e"]["email_matches"] == 1 and rows["p"]["phone_matches"] == 1 and rows["m"]["currency_matches"] == 1


def test_apply_inferred_schema(spark):
    df = spark.createDataFrame([("1", "2024-01-02", "x", " 7 "), ("2", "2024-01-03", "y", "n/a"),
                                ("3", "2024-01-04", "z", "8"), ("4", "2024-01-05", "w", "9"),
                                ("5", "2024-01-06", "v", "10")], "id string, d string, s string, n string")
    out = profile.apply_inferred_schema(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["int", "date", "string", "int"]
    assert [r["n"] for r in out.orderBy("id").collect()] == [7, None, 8, 9, 10]


def test_wide_table_profile_chunks(spark, monkeypatch):
    from goldenrec import settings

    monkeypatch.setattr(settings, "PROFILE_COLUMNS_PER_PASS", 2)
    df = spark.createDataFrame([("1", "a", "2024-01-01", "x", "1.5")], "a string, b string, c string, d string, e string")
    rows = profile.type_profile(df).orderBy("position").collect()
    assert [r["column_name"] for r in rows] == ["a", "b", "c", "d", "e"]
    assert [r["position"] for r in rows] == [0, 1, 2, 3, 4]


def test_categories_and_traps():
    cat = profile.column_category
    assert cat("customer_id") == "identifier"
    assert cat("paid_amount") == "identifier"  # 'id' inside 'paid'
    assert cat("l_linenumber") == "identifier"  # 'number'
    assert cat("discount") == "metric"  # 'count'
    assert cat("order_date") == "temporal" and cat("first_name") == "descriptive"
    assert cat("email") == "contact" and cat("flag") == "general"


def test_dedup_suggestion_order():
    cols = ["customer_id", "first_name", "last_name", "phone", "email", "city", "address", "country"]
    assert profile.suggest_dedup_columns(cols) == ["email", "phone", "city", "address", "country"]
    assert profile.suggest_dedup_columns(["sku", "product_name"]) == ["sku", "product_name"]


def test_primary_key_suggestion(spark):
    df = spark.createDataFrame([(1, "a", 10), (1, "b", 11), (2, "c", 12)], "group_id int, code string, qty int")
    rows = {r["column_name"]: r for r in profile.primary_key_candidates(df, table="t").collect()}
    assert set(rows) == {"group_id", "code"}
    assert rows["code"]["suggested"] and not rows["group_id"]["suggested"]
    df2 = spark.createDataFrame([(1, 1), (1, 1)], "a_id int, b_key int")
    rows2 = {r["column_name"]: r for r in profile.primary_key_candidates(df2, table="t").collect()}
    assert rows2["a_id"]["suggested"]  # no unique one: first identifier


def test_distinct_counts_null_as_value(spark):
    df = spark.createDataFrame([(1,), (None,), (1,)], "k int")
    r = profile.cardinality_report(df).first()
    assert r["distinct_values"] == 2 and not r["is_unique"]
    assert df.agg(F.count_distinct("k")).first()[0] == 1


def test_widen_option(spark):
    def typ(values, widen):
        df = spark.createDataFrame([(v,) for v in values], "c string")
        return profile.type_profile(df, widen=widen).first()["inferred_type"]

    mixed = ["12", "22", "32", "1.5", "2.5"]
    assert typ(mixed, False) == "string" and typ(mixed, True) == "double"
    big = ["12", "13", "99999999999", "88888888888"]
    assert typ(big, False) == "string" and typ(big, True) == "long"
    assert typ(["12", "13"], True) == "integer"
    assert typ(["99999999999999999999999", "2"], True) == "double"  # beyond 64 bits: a double
    df = spark.createDataFrame([(v,) for v in big], "c string")
    assert profile.apply_inferred_schema(df, widen=True).schema["c"].dataType.simpleString() == "bigint"


def test_monitor_approx_option(spark):
    from goldenrec.operators import monitor

    df = spark.createDataFrame([(str(i % 50), "f", 1) for i in range(200)], "_record_hash string, _source_file string, _ingestion_timestamp int")
    exact = monitor.ingestion_summary(df, "t").first()
    approx = monitor.ingestion_summary(df, "t", approx=True).first()
    assert exact["unique_records"] == 50 and abs(approx["unique_records"] - 50) <= 2
