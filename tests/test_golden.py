from pyspark.sql import functions as F

from shared_fixtures import SF0001
from goldenrec.operators import golden, identity
from goldenrec.operators.golden import OrderKey
from goldenrec.plans import layers as ip
from goldenrec.plans import source_tables as st
from goldenrec.plans.persons import persons

PERSON_SCHEMA = "person_id long, name string, email string, phone string, age string, source_file_path string"


def test_fixture_numbers_sf0001(spark):
    """Numbers recorded for the person feed at sf0.001 (scratch run, Spark and DuckDB identical)."""
    res = ip.identity_layers(persons(spark, SF0001))
    dist = {r["confidence"]: r["rows"] for r in golden.confidence_distribution(res.scored).collect()}
    assert res.scored.count() == 1000
    assert dist == {"High": 903, "Moderate": 6, "Low": 91}
    g = res.golden.agg(F.count(F.lit(1)), F.sum("person_id")).first()
    assert tuple(g) == (18, 9105)
    by_id = ip.identity_layers(persons(spark, SF0001), ip.PipelineParams(partition_by=("unique_identifier",)))
    assert tuple(by_id.golden.agg(F.count(F.lit(1)), F.sum("person_id")).first()) == (125, 61652)
    assert res.silver.filter(F.col("age").isNull()).count() == 91


def test_golden_table_keeps_helpers(spark):
    res = ip.identity_layers(persons(spark, SF0001))
    assert res.golden.columns == ["person_id", "name", "email", "phone", "age", "source_system",
                                  "unique_identifier", "confidence", "confidence_rank", "row_num"]
    assert res.scored.columns == ["person_id", "name", "email", "phone", "age", "source_system",
                                  "unique_identifier", "confidence"]
    assert {r[0] for r in res.golden.select("row_num").distinct().collect()} == {1}


def _bronze(spark, rows):
    return spark.createDataFrame(rows, PERSON_SCHEMA)


def test_priority_identifier_and_blank_as_null(spark):
    df = _bronze(spark, [
        (1, "ann", "a@x.io", "+1", "30", "/SAP/"),
        (2, "ann", None, "+1-2", "30", "/SAP/"),
        (3, "ann", None, None, "30", "/SAP/"),
        (4, "ann", "  ", "+9", "31", "/SAP/"),
        (5, None, None, None, None, "/SAP/"),
    ])
    k1 = {r[0]: r[1] for r in ip.silver_identified(df).select("person_id", "unique_identifier").collect()}
    k2 = {r[0]: r[1] for r in ip.silver_identified(df, ip.PipelineParams(blank_as_null=True))
          .select("person_id", "unique_identifier").collect()}
    assert k1 == {1: "a@x.io", 2: "+12", 3: "Ann_30", 4: "", 5: ""}
    assert k2[4] == "+9" and k2[3] == "Ann_30" and k2[5] == ""


def test_confidence_levels_and_golden_tiebreak(spark):
    rows = [
        (1, "ann", "a@x.io", None, "30", "/SAP/"),
        (2, "ann", "a@x.io", None, "40", "/salesforce/"),
        (3, "ann", "a@x.io", None, None, "/zoho/"),
        (4, "ann", "b@x.io", None, "50", "/SAP/"),
        (5, "ann", "b@x.io", None, "50", "/SAP/"),
        (6, "cy", "c@x.io", None, "70", "/SAP/"),
    ]
    res = ip.identity_layers(_bronze(spark, rows))
    conf = {r[0]: r[1] for r in res.scored.select("person_id", "confidence").collect()}
    assert conf == {1: "High", 2: "High", 3: "High", 4: "Moderate", 5: "Moderate", 6: "Low"}
    gold = {r[0]: r[1] for r in res.golden.select("name", "person_id").collect()}
    # High beats Moderate despite the older age; among Highs the oldest; NULL age last.
    assert gold == {"Ann": 2, "Cy": 6}
    by_id = ip.identity_layers(_bronze(spark, rows), ip.PipelineParams(partition_by=("unique_identifier",)))
    gid = {r[0]: r[1] for r in by_id.golden.select("unique_identifier", "person_id").collect()}
    # equal rank and age: the smaller person_id wins (deterministic)
    assert gid == {"a@x.io": 2, "b@x.io": 4, "c@x.io": 6}


def test_survivorship_mixes_rows(spark):
    rows = [
        (1, "ann", "a@x.io", None, "40", "/SAP/"),
        (2, "ann", "a@x.io", "+7", None, "/SAP/"),
    ]
    res = ip.identity_layers(_bronze(spark, rows), ip.PipelineParams(
        partition_by=("unique_identifier",), survivorship="attribute"))
    r = res.golden.first().asDict()
    assert r["person_id"] == 1 and r["age"] == 40 and r["phone"] == "+7"


def test_inner_vs_left_null_key(spark):
    df = spark.createDataFrame([(1, "k"), (2, "k"), (3, None), (4, "z")], "person_id long, unique_identifier string")
    inner = golden.score(df, columns=None, keep_repetition=True)
    left = golden.score(df, how="left", columns=None, keep_repetition=True)
    assert sorted(r[0] for r in inner.select("person_id").collect()) == [1, 2, 4]
    got = {r[0]: (r[1], r[2]) for r in left.select("person_id", "repetition", "confidence").collect()}
    assert got == {1: (2, "Moderate"), 2: (2, "Moderate"), 3: (None, "Low"), 4: (1, "Low")}


def test_reports(spark):
    df = spark.createDataFrame([(1, "k"), (2, "k"), (3, None), (4, "z")], "person_id long, unique_identifier string")
    scored = golden.score(df, how="left", columns=None, keep_repetition=True)
    assert tuple(golden.dedup_ratio(scored).first()) == (4, 3, 25.0)
    assert tuple(golden.duplicate_rows(scored).first()) == (2, 4)
    assert tuple(golden.identifier_coverage(df).first()) == (3, 4)
    empty = spark.createDataFrame([], "person_id long, unique_identifier string")
    assert tuple(golden.dedup_ratio(empty).first()) == (0, 0, 0.0)


def test_customers_end_to_end(spark, sample_sources):
    """Both customer systems: 10 rows, 8 identifiers by email, 4 Moderate + 6
    Low, 8 golden by identifier (20 % removed), 9 by full name."""
    df = st.customers_table(spark, sample_sources)
    assert df.count() == 10
    ided = df.withColumn("unique_identifier", identity.entity_identifier(df, "customers"))
    assert ided.select("unique_identifier").distinct().count() == 8
    scored = golden.score(ided, columns=None)
    dist = {r[0]: r[1] for r in golden.confidence_distribution(scored).collect()}
    assert dist == {"Moderate": 4, "Low": 6}
    order = (OrderKey("confidence_rank"), OrderKey("registration_date"), OrderKey("customer_id", descending=False))
    gold = golden.golden_records(scored, ("unique_identifier",), order)
    assert gold.count() == 8
    assert tuple(golden.dedup_ratio(scored).first()) == (10, 8, 20.0)
    by_name = golden.golden_records(scored, ("full_name",), order)
    assert by_name.count() == 9
    # Bob / Robert share an email: merged by identifier, not by name
    kent = gold.filter(F.col("unique_identifier") == "bob.kent@mail.test").first()
    assert kent["first_name"] == "Robert"  # newer registration wins the tie on confidence


def test_products_by_sku_and_parsing(spark, sample_sources):
    df = st.products_table(spark, sample_sources)
    assert df.count() == 8
    names = {r[0] for r in df.select("product_name").collect()}
    assert 'Display 24"' in names and "Usb-c Dock" in names
    assert df.select("sku").distinct().count() == 6
    flags = {r[0]: r[1] for r in df.select("product_id", "is_active").collect() if r[0] in ("Q2", "Q4")}
    assert flags == {"Q2": True, "Q4": False}
    order = (OrderKey("confidence_rank"), OrderKey("price", descending=False), OrderKey("product_id", descending=False))
    ided = df.withColumn("unique_identifier", identity.entity_identifier(df, "products"))
    gold = golden.golden_records(golden.score(ided, columns=None), ("unique_identifier",), order)
    cheapest = gold.filter(F.col("sku") == "SKU-TL-1").first()
    assert cheapest["price"] == 949.5


def test_exact_duplicates(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "b", "x")], "id long, k1 string, k2 string")
    out = {(r[0], r[1]): (r[2], r[3]) for r in identity.exact_duplicates(df, ["k1", "k2"], "id").collect()}
    assert out == {("a", "x"): (1, 2), ("b", "x"): (3, 1)}
    whole = identity.drop_exact_duplicates(df, ["k1", "k2"], "id")
    assert sorted(r[0] for r in whole.select("id").collect()) == [1, 3]


def test_entity_identifier_fallbacks(spark):
    df = spark.createDataFrame([("a", 1)], "name string, qty int")
    h = df.select(identity.entity_identifier(df, "other")).first()[0]
    assert len(h) == 32
    df2 = spark.createDataFrame([(7, "n")], "order_id long, name string")
    assert df2.select(identity.entity_identifier(df2, "orders")).first()[0] == "7"


def test_hot_key_split_join_is_exact(spark):
    # one identifier holds a third of the rows
    rows = [(i, "hot@x.io" if i % 3 == 0 else f"u{i % 40}@x.io") for i in range(600)] + [(1000, None)]
    df = spark.createDataFrame(rows, "person_id long, unique_identifier string")
    for how in ("inner", "left"):
        base = golden.score(df, how=how, columns=None, keep_repetition=True, hot_keys=None)
        split = golden.score(df, how=how, columns=None, keep_repetition=True, hot_keys=4)
        assert sorted(repr(tuple(r)) for r in base.collect()) == sorted(repr(tuple(r)) for r in split.collect())
        plan = split._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "LeftAnti" in plan


def test_a_task_after_a_shuffle_gets_few_rows(spark):
    """Joined rows that are sorted for golden_by_key take some 20 times their
    shuffled size: the size to which partitions are put together bounds a task."""
    from goldenrec.session import apply_base_conf

    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    try:
        apply_base_conf(spark)
        size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsMb(spark.conf.get(name))
        assert 20 * size < 1000
    finally:
        spark.conf.set(name, before)
