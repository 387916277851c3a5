"""Source-side queries: ingestion monitor, the five pre-bronze tables, the
generic builder on a JSON source, the ad-hoc dataset flow and the file
inventory. File inputs are written by Spark from the driver tables into the
session's shared checkpoint folder first, so they scale with the tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import functions as F

from goldenrec.functions.hashing import with_record_hash
from goldenrec.operators import metadata, monitor, profile, quality
from goldenrec.plans import catalog_entities as entities
from goldenrec.plans import source_tables as st
from goldenrec.plans.catalog_profile import TABLE_COLUMNS, profile_oracle
from goldenrec.plans.persons import table
from goldenrec.plans.registry import register, with_ctes
from goldenrec.session import shared_dir
from goldenrec.sources import sinks
from goldenrec.sources.spec import SourceSpec, api_logs_spec

# Pinned ingestion time so monitor results are reproducible.
INGESTED_AT = dt.datetime(2024, 1, 1, 0, 0, 0)
MONITORED = ("customer", "part", "orders", "supplier", "lineitem")


def _monitor_sql(t: str) -> str:
    cols = ", ".join(f"cast({c} as varchar)" for c in TABLE_COLUMNS.get(t) or ())
    return (f"select '{t}' as source_type, count(*) as total_records, "
            f"count(distinct md5(concat_ws('||', {cols}))) as unique_records, cast(1 as bigint) as source_files, "
            f"timestamp '2024-01-01 00:00:00' as last_ingestion from {t}")


@register("ingestion_monitor", "\nunion all\n".join(_monitor_sql(t) for t in MONITORED))
def q_ingestion_monitor(spark, sf_dir):
    """Per table, records, distinct record hashes, files read and
    the latest ingestion stamp, stacked. (Files = distinct ``_metadata``
    paths; each driver table is one parquet file.)"""
    frames = {t: with_record_hash(metadata.enrich(table(spark, sf_dir, t), t, ingested_at=INGESTED_AT))
              for t in MONITORED}
    return monitor.unified_summary(frames)


def _sources(spark, sf_dir, only=None) -> str:
    base = shared_dir(spark, "sources")
    return st.write_sample_sources(spark, sf_dir, base, only=only)


def _table_sql(source: str, cte: str, rows: str, columns: str) -> str:
    """DuckDB twin of a fixed table read back from its CSV folders."""
    text = ", ".join(f"cast({c.strip()} as varchar)" for c in columns.split(","))
    return with_ctes(cte, body=f"""
select {columns}, '{source}' as _source_system, timestamp '2024-01-01 00:00:00' as _ingestion_timestamp,
       system as _source_folder, md5(concat_ws('||', {text})) as _record_hash from {rows}""")


_TABLE_SQL = {
    "customers": _table_sql("customers", entities.CTE_CUSTOMER_FEED, "identified",
                            "customer_id, first_name, last_name, email, phone, address, city, country, registration_date, customer_type, full_name"),
    "products": _table_sql("products", entities.CTE_PRODUCT_FEED, "identified",
                           "product_id, product_name, category, brand, price, currency, stock_quantity, sku, weight_kg, is_active"),
    "orders": _table_sql("orders", entities.CTE_ORDERS, "sales",
                         "order_id, customer_id, product_id, quantity, unit_price, total_amount, order_date, status, shipping_method, payment_method"),
    "employees": _table_sql("employees", entities.CTE_EMPLOYEES, "employees",
                            "employee_id, first_name, last_name, email, department, job_title, hire_date, salary, manager_id, location, full_name"),
    "inventory": _table_sql("inventory", entities.CTE_INVENTORY, "stock",
                            "inventory_id, product_id, warehouse_location, quantity_on_hand, reorder_level, reorder_quantity, last_restock_date, supplier_id, unit_cost"),
}


def _fixed_table(spark, base, name):
    return metadata.by_folder(st.FIXED_TABLES[name](spark, base, ingested_at=INGESTED_AT))


def _fixed(name):
    def run(spark, sf_dir):
        return _fixed_table(spark, _sources(spark, sf_dir, only=[name]), name)
    run.__name__ = f"q_source_table_{name}"
    run.__doc__ = f"T: pre_bronze_{name} over CSV files derived from the driver tables; files are told by their folder."
    return run


for _name in st.FIXED_TABLES:
    register(f"source_table_{_name}", _TABLE_SQL[_name])(_fixed(_name))


def _rules_sql(source: str, src: str, rules: dict[str, str]) -> str:
    return "\nunion all\n".join(
        f"select '{source}' as source, '{name}' as rule, count(*) filter (where coalesce({r}, false)) as passed, "
        f"count(*) filter (where not coalesce({r}, false)) as failed from {src}"
        for name, r in rules.items())


# The rule inputs as the CSV round trip types them (integers truncate like
# Spark's cast; every source row is present once per system).
_CUST_ROWS = ("select 1 as customer_id, 1 as email, 1 as phone from customer c "
              "join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey")
_PART_ROWS = "select 1 as product_id, 1 as sku, p_retailprice as price from part"
_PB_SOURCES = {
    "customers": f"({_CUST_ROWS} union all {_CUST_ROWS})",
    "products": f"({_PART_ROWS} union all {_PART_ROWS})",
    "orders": ("(select 1 as order_id, 1 as customer_id, cast(trunc(l_quantity) as integer) as quantity "
               "from lineitem l join orders o on l.l_orderkey = o.o_orderkey)"),
    "employees": ("(select 1 as employee_id, 1 as email, cast(trunc(s_acctbal) as integer) as salary "
                  "from supplier s join nation n on s.s_nationkey = n.n_nationkey)"),
    "inventory": "(select 1 as inventory_id, 1 as product_id, p_size as quantity_on_hand from part)",
}


@register("pre_bronze_quality", "\nunion all\n".join(
    _rules_sql(name, _PB_SOURCES[name], st.FIXED_RULES[name]) for name in st.FIXED_TABLES))
def q_pre_bronze_quality(spark, sf_dir):
    """Q1 on all five pre-bronze tables: each table's declared rules, one
    report row per (table, rule)."""
    base = _sources(spark, sf_dir)
    parts = []
    for name, fn in st.FIXED_TABLES.items():
        rep = quality.report(fn(spark, base, ingested_at=INGESTED_AT), st.FIXED_RULES[name])
        parts.append(rep.select(F.lit(name).alias("source"), "*"))
    return reduce(lambda a, b: a.unionByName(b), parts)


_EMAIL_OK = r"regexp_matches(lower(replace(c_name, '#', '.')) || '@email.com', '^[\w\.\-]+@[\w\.\-]+\.[a-zA-Z]{2,}$')"
_CAT_CUST = (f"select 1 as customer_id, {_EMAIL_OK} as email_ok, 1 as first_name from customer c "
             "join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey")
_CAT_SQL = {
    "customers": (f"({_CAT_CUST} union all {_CAT_CUST})", {
        "valid_customer_id": "customer_id IS NOT NULL", "valid_email_format": "email_ok",
        "valid_name": "first_name IS NOT NULL"}),
    "products": ("(select 1 as product_id, 1 as sku, p_retailprice as price, p_size * 10 as stock_quantity from part "
                 "union all select 1, 1, p_retailprice, p_size * 10 + 1 from part)", {
                     "valid_product_id": "product_id IS NOT NULL", "valid_sku": "sku IS NOT NULL",
                     "valid_price": "price IS NULL OR price >= 0",
                     "valid_stock": "stock_quantity IS NULL OR stock_quantity >= 0"}),
    "orders": ("(select 1 as order_id, 1 as customer_id, 1 as product_id, cast(trunc(l_quantity) as integer) as quantity,"
               " l_extendedprice as total_amount from lineitem l join orders o on l.l_orderkey = o.o_orderkey)", {
                   "valid_order_id": "order_id IS NOT NULL", "valid_customer_ref": "customer_id IS NOT NULL",
                   "valid_product_ref": "product_id IS NOT NULL", "valid_quantity": "quantity IS NULL OR quantity > 0",
                   "valid_amount": "total_amount IS NULL OR total_amount >= 0"}),
    "employees": ("(select 1 as employee_id, 1 as email, 1 as department, cast(trunc(s_acctbal) as integer) as salary "
                  "from supplier s join nation n on s.s_nationkey = n.n_nationkey)", {
                      "valid_employee_id": "employee_id IS NOT NULL", "valid_email": "email IS NOT NULL",
                      "valid_department": "department IS NOT NULL", "valid_salary": "salary IS NULL OR salary >= 0"}),
    "inventory": ("(select 1 as inventory_id, 1 as product_id, 1 as warehouse_location, p_size as quantity_on_hand, "
                  "10 as reorder_level from part)", {
                      "valid_inventory_id": "inventory_id IS NOT NULL", "valid_product_ref": "product_id IS NOT NULL",
                      "valid_location": "warehouse_location IS NOT NULL",
                      "valid_quantity": "quantity_on_hand IS NULL OR quantity_on_hand >= 0",
                      "valid_reorder_level": "reorder_level IS NULL OR reorder_level >= 0"}),
}


@register("catalogue_quality", "\nunion all\n".join(
    _rules_sql(name, src, rules) for name, (src, rules) in _CAT_SQL.items()))
def q_catalogue_quality(spark, sf_dir):
    """The five predefined sources built by the generic
    builder from their CSV folders; each spec's expectations (its rules plus
    NOT NULL key rules) reported per source."""
    from goldenrec.sources.spec import all_specs

    base = _sources(spark, sf_dir)
    parts = []
    for spec in map(st.line_oriented, all_specs(base)):  # Spark wrote one record per line
        df = st.build_source_table(spark, spec, ingested_at=INGESTED_AT)
        parts.append(quality.report(df, spec.expectations()).select(F.lit(spec.name).alias("source"), "*"))
    return reduce(lambda a, b: a.unionByName(b), parts)


@register("pre_bronze_monitor", "\nunion all\n".join(
    f"select '{name}' as source_type, count(*) as total_records, count(distinct _record_hash) as unique_records, "
    f"count(distinct _source_folder) as source_files, max(_ingestion_timestamp) as last_ingestion from ({sql})"
    for name, sql in _TABLE_SQL.items()))
def q_pre_bronze_monitor(spark, sf_dir):
    """A3 over the five pre-bronze tables read from their CSV folders; sources
    are counted by folder, as Spark writes any number of files."""
    base = _sources(spark, sf_dir)
    return monitor.unified_summary({n: _fixed_table(spark, base, n) for n in st.FIXED_TABLES}, file_col="_source_folder")


def _api_logs(spark, sf_dir) -> SourceSpec:
    """Events written as JSON lines in the shape of the API-log example."""
    path = shared_dir(spark, "sources", "api_logs")
    e = table(spark, sf_dir, "events")
    e.select(
        F.concat(F.lit("req-"), F.col("event_id").cast("string")).alias("request_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        F.floor(F.col("value") * 20).cast("int").alias("status_code"),
        F.col("event_type").alias("endpoint"),
        F.col("props").alias("payload"),
    ).write.mode("overwrite").json(path)
    spec = api_logs_spec(path.rsplit("/", 1)[0])
    # The files are JSON lines, one record per line, so multiLine is off.
    return SourceSpec(name=spec.name, source_path=path, file_format="json",
                      primary_key_columns=spec.primary_key_columns, dedup_columns=spec.dedup_columns,
                      quality_rules=spec.quality_rules, read_options={"multiLine": "false"})


@register("api_logs_quality", """
select 'valid_status_code' as rule,
       count(*) filter (where coalesce(s >= 100 and s < 600, false)) as passed,
       count(*) filter (where not coalesce(s >= 100 and s < 600, false)) as failed
from (select cast(floor(value * 20) as integer) as s from events)
union all
select 'valid_request_id', count(*) filter (where event_id is not null),
       count(*) filter (where event_id is null) from events
union all
select 'valid_timestamp', count(*) filter (where ts is not null), count(*) filter (where ts is null) from events""")
def q_api_logs_quality(spark, sf_dir):
    """S14/S17 on a JSON source: generic table build, then its rules
    (key rule valid_request_id added from the primary key)."""
    spec = _api_logs(spark, sf_dir)
    df = st.build_source_table(spark, spec, ingested_at=INGESTED_AT)
    return quality.report(df, spec.expectations())


@register("custom_dataset", """
select *, 'custom_dataset' as _source_system, timestamp '2024-01-01 00:00:00' as _ingestion_timestamp,
       md5(concat_ws('||', cast(id as varchar), cast(o_custkey as varchar), o_orderstatus, cast(o_totalprice as varchar),
                     cast(o_orderdate as varchar), o_orderpriority)) as _record_hash
from (select cast(o_orderkey as integer) as id, cast(o_custkey as integer) as o_custkey, o_orderstatus, o_totalprice,
             cast(o_orderdate as date) as o_orderdate, o_orderpriority from orders)""")
def q_custom_dataset(spark, sf_dir):
    """CSV without a declared schema -> detected types -> trim ->
    metadata -> hash."""
    return st.custom_dataset(spark, _orders_csv(spark, sf_dir), ingested_at=INGESTED_AT, multi_line=False).drop("_source_file", "_source_file_name")


def _orders_csv(spark, sf_dir) -> str:
    path = shared_dir(spark, "sources", "custom")
    table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), "o_custkey", "o_orderstatus", "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority",
    ).write.mode("overwrite").option("header", "true").csv(path)
    return path


_ORDER_COLUMNS = ("id", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@register("profile_csv", profile_oracle(
    ["o as (select o_orderkey as id, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') as o_orderdate, o_orderpriority from orders)"],
    "o", _ORDER_COLUMNS))
def q_profile_csv(spark, sf_dir):
    """PR3: a CSV read as text, without an inference pass, and profiled."""
    return profile.profile_csv(spark, _orders_csv(spark, sf_dir))


@register("source_inventory", """
select unnest(['sap', 'salesforce', '(none)']) as folder, unnest([n, n, 0]) as rows, unnest([10, 10, 0]) as columns,
       unnest([true, true, false]) as present
from (select count(*) as n from customer c join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey)""")
def q_source_inventory(spark, sf_dir):
    """The customer source files, each counted by its own header, and an
    expected one that is not there; summed per feeding system."""
    files = sinks.csv_inventory(spark, f"{_sources(spark, sf_dir, only=['customers'])}/customers/", expected=["customers_crm.csv"])
    return files.groupBy(F.coalesce("folder", F.lit("(none)")).alias("folder")).agg(
        F.sum("rows").alias("rows"), F.max("columns").alias("columns"), F.bool_and("present").alias("present"))
