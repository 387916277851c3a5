from pyspark.sql import functions as F

from goldenrec.functions import normalize as N
from goldenrec.functions.hashing import record_hash, with_record_hash
from goldenrec.operators import cleaning


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_email_phone_name(spark):
    df = spark.createDataFrame(
        [("  A.B@X.COM ", "+1 (555) 010-1", "  mary ann  o'neil "), (None, None, None), ("", "n/a", "USB-C hub")],
        "email string, phone string, name string")
    out = df.select(N.email("email").alias("e"), N.phone("phone").alias("p"), N.proper_name("name").alias("n"))
    assert rows(out, "e", "p", "n") == [
        ("a.b@x.com", "+15550101", "Mary Ann  O'neil"),
        (None, None, None),
        ("", "", "Usb-c Hub"),
    ]


def test_phone_numeric_column_is_cast(spark):
    df = spark.createDataFrame([(15550101,)], "phone long")
    assert rows(df.select(N.phone("phone").alias("p")), "p") == [("15550101",)]


def test_phone_without_plus_differs_from_with_plus(spark):
    df = spark.createDataFrame([("15550101",), ("+1-555-0101",)], "phone string")
    vals = [r[0] for r in df.select(N.phone("phone")).collect()]
    assert vals == ["15550101", "+15550101"]


def test_company_name(spark):
    df = spark.createDataFrame([("  acme \t  corp\n ltd ",)], "c string")
    assert rows(df.select(N.company_name("c").alias("c")), "c") == [("ACME CORP LTD",)]


def test_boolean_three_and_two_state(spark):
    vals = ["true", "YES", "1", "t", "y", "false", "No", "0", "f", "n", "maybe", None, " y "]
    df = spark.createDataFrame([(v,) for v in vals], "is_active string")
    three = [r[0] for r in df.select(N.boolean_three_state("is_active")).collect()]
    two = [r[0] for r in df.select(N.boolean_two_state("is_active")).collect()]
    assert three == [True, True, True, True, True, False, False, False, False, False, None, None, True]
    assert two == [True, True, True, False, False, False, False, False, False, False, False, False, False]


def test_standardize_boolean_picks_columns_by_name(spark):
    df = spark.createDataFrame([("yes", "no", "yes")], "is_vip string, active_flag string, other string")
    out = cleaning.standardize_boolean(df)
    assert out.schema["is_vip"].dataType.simpleString() == "boolean"
    assert out.schema["other"].dataType.simpleString() == "string"
    assert tuple(out.first()) == (True, False, "yes")


def test_full_name_null_if_part_missing(spark):
    df = spark.createDataFrame([("ann", "lee"), ("bob", None)], "first_name string, last_name string")
    out = cleaning.add_full_name(cleaning.normalize_names(df))
    assert rows(out, "full_name") == [("Ann Lee",), (None,)]
    # absent columns: no-op
    assert cleaning.add_full_name(df.drop("last_name")).columns == ["first_name"]


def test_parse_date_malformed_is_null(spark):
    df = spark.createDataFrame([("2024-02-29",), ("2024-13-01",), ("",), ("soon",), (None,)], "d string")
    vals = [r[0] for r in df.select(N.parse_date("d")).collect()]
    assert [str(v) if v else None for v in vals] == ["2024-02-29", None, None, None, None]


def test_source_system_first_match_wins_and_case_sensitive(spark):
    paths = ["/x/SAP/salesforce/a.csv", "/x/sap/a.csv", "/x/zoho/a.csv", "/x/oddo/a.csv", None]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    vals = [r[0] for r in df.select(N.source_system("p")).collect()]
    assert vals == ["SAP", "Unknown", "Zoho", "Odoo", "Unknown"]


def test_trim_strings_skips_underscore_and_non_strings(spark):
    df = spark.createDataFrame([(" a ", " b ", 1)], "x string, _meta string, n int")
    assert tuple(cleaning.trim_strings(df).first()) == ("a", " b ", 1)


def test_record_hash_skips_nulls_by_default_null_safe_keeps_positions(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    plain = [r[0] for r in df.select(record_hash(["x", "y", "z"])).collect()]
    safe = [r[0] for r in df.select(record_hash(["x", "y", "z"], null_safe=True)).collect()]
    assert plain[0] == plain[1]
    assert safe[0] != safe[1]


def test_record_hash_ignores_underscore_columns(spark):
    df = spark.createDataFrame([("a", 1, "meta1"), ("a", 1, "meta2")], "x string, n int, _src string")
    hashes = {r[0] for r in with_record_hash(df).select("_record_hash").collect()}
    assert len(hashes) == 1


def test_file_name_from_path(spark):
    df = spark.createDataFrame([("file:///a/b/c.csv",), ("noslash",), ("/ends/",)], "p string")
    assert [r[0] for r in df.select(N.file_name_from_path("p")).collect()] == ["c.csv", "noslash", ""]


def test_confidence_and_rank(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "r long")
    out = df.select(N.confidence("r").alias("c")).select("c", N.confidence_rank("c").alias("k"))
    assert rows(out, "c", "k") == [("Low", 1), ("Moderate", 2), ("High", 3), ("Low", 1)]


def test_no_python_udfs_in_cleaning_plan(spark):
    df = spark.createDataFrame([(" X ", "+1-2", "a b", "/SAP/", "3")],
                               "email string, phone string, name string, source_file_path string, age string")
    df = df.withColumn("person_id", F.lit(1))
    plan = cleaning.silver_clean(df)._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "EvalPython" not in plan
