"""Generic and per-source pre-bronze tables (S17-S19, T1-T5) and the file
sources they read.

``build_source_table`` is the generic flow: read -> trim strings -> metadata
-> user transforms -> record hash. ``customers_table`` ... ``inventory_table``
are the five fixed flows, which transform *before* adding metadata; the hash
skips ``_`` columns, so both orders hash equal inputs alike.

``write_sample_sources`` writes the five source folders as CSV, derived by
Spark from the driver tables (every row of the underlying tables), so the
file-based flows can be exercised at any scale factor.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldenrec.functions.hashing import with_record_hash
from goldenrec.operators import cleaning, metadata, profile, quality
from goldenrec.plans.persons import table
from goldenrec.sources import readers
from goldenrec.sources.spec import SourceRegistry, SourceSpec


def build_source_table(spark: SparkSession, spec: SourceSpec, streaming: bool = False, apply_cleaning: bool = True,
                       include_metadata: bool = True, rule_mode: str = "warn",
                       ingested_at: dt.datetime | None = None) -> DataFrame:
    """S17. ``rule_mode``: "warn" keeps every row (use ``quality.report`` or
    ``quality.observe_rules`` for the counts), "drop" keeps passing rows."""
    df = readers.read_stream(spark, spec) if streaming else readers.read_batch(spark, spec)
    if apply_cleaning:
        df = cleaning.trim_strings(df)
    if include_metadata:
        df = metadata.enrich(df, spec.name, ingested_at=ingested_at)
    df = cleaning.apply_transforms(df, spec.transformations)
    df = with_record_hash(df)
    if rule_mode == "drop":
        df = quality.keep_valid(df, spec.expectations())
    return df


def process_all_sources(spark: SparkSession, specs: Sequence[SourceSpec], **kw) -> dict[str, DataFrame]:
    """One table per registered source, named ``pre_bronze_<source>``."""
    reg = SourceRegistry(specs)
    return {f"pre_bronze_{n}": build_source_table(spark, reg.get(n), **kw) for n in reg.names()}


def line_oriented(spec: SourceSpec) -> SourceSpec:
    """The source with one record per line, so its files split into many tasks."""
    return replace(spec, read_options={**spec.read_options, "multiLine": "false"})


def custom_dataset(spark: SparkSession, path: str, name: str = "custom_dataset", ingested_at: dt.datetime | None = None,
                   multi_line: bool = True) -> DataFrame:
    """Read -> detect and apply types -> trim -> metadata -> hash.
    ``multi_line=False`` for files of one record per line, which then split."""
    spec = SourceSpec(name=name, source_path=path, primary_key_columns=("id",),
                      quality_rules={"has_id": "id IS NOT NULL"}, read_options={"multiLine": str(multi_line).lower()})
    df = readers.read_batch(spark, spec)
    df = profile.apply_inferred_schema(df)
    df = cleaning.trim_strings(df)
    df = metadata.enrich(df, name, ingested_at=ingested_at)
    return with_record_hash(df)


# --- the five fixed tables (T1-T5) ---------------------------------------------

def _read_dir(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.format("csv").option("header", "true").option("inferSchema", "true")
            .option("recursiveFileLookup", "true").load(path))


def _finish(df: DataFrame, name: str, ingested_at) -> DataFrame:
    return with_record_hash(metadata.enrich(df, name, ingested_at=ingested_at))


def customers_table(spark, base, ingested_at=None) -> DataFrame:
    """Email, phone, names, full_name; metadata; hash."""
    df = _read_dir(spark, f"{base}/customers/")
    df = cleaning.normalize_email(df)
    df = cleaning.normalize_phone(df)
    df = cleaning.normalize_names(df, ("first_name", "last_name"))
    df = cleaning.add_full_name(df)
    return _finish(df, "customers", ingested_at)


def products_table(spark, base, ingested_at=None) -> DataFrame:
    """product_name and category initcap; two-state is_active."""
    df = _read_dir(spark, f"{base}/products/")
    df = cleaning.normalize_names(df, ("product_name", "category"))
    df = cleaning.two_state_boolean(df, "is_active")
    return _finish(df, "products", ingested_at)


def orders_table(spark, base, ingested_at=None) -> DataFrame:
    """order_date to date."""
    return _finish(cleaning.parse_dates(_read_dir(spark, f"{base}/orders/"), ["order_date"]), "orders", ingested_at)


def employees_table(spark, base, ingested_at=None) -> DataFrame:
    """T4: email, names, full_name, hire_date."""
    df = _read_dir(spark, f"{base}/employees/")
    df = cleaning.normalize_email(df)
    df = cleaning.normalize_names(df, ("first_name", "last_name"))
    df = cleaning.add_full_name(df)
    df = cleaning.parse_dates(df, ["hire_date"])
    return _finish(df, "employees", ingested_at)


def inventory_table(spark, base, ingested_at=None) -> DataFrame:
    """T5: last_restock_date to date."""
    df = cleaning.parse_dates(_read_dir(spark, f"{base}/inventory/"), ["last_restock_date"])
    return _finish(df, "inventory", ingested_at)


FIXED_TABLES = {
    "customers": customers_table,
    "products": products_table,
    "orders": orders_table,
    "employees": employees_table,
    "inventory": inventory_table,
}

# The rules the five fixed tables declare (warn mode), as surveyed.
FIXED_RULES = {
    "customers": {"valid_customer_id": "customer_id IS NOT NULL",
                  "valid_email_or_phone": "email IS NOT NULL OR phone IS NOT NULL"},
    "products": {"valid_product_id": "product_id IS NOT NULL", "valid_sku": "sku IS NOT NULL",
                 "valid_price": "price IS NULL OR price >= 0"},
    "orders": {"valid_order_id": "order_id IS NOT NULL", "valid_customer_ref": "customer_id IS NOT NULL",
               "valid_quantity": "quantity IS NULL OR quantity > 0"},
    "employees": {"valid_employee_id": "employee_id IS NOT NULL", "valid_email": "email IS NOT NULL",
                  "valid_salary": "salary IS NULL OR salary >= 0"},
    "inventory": {"valid_inventory_id": "inventory_id IS NOT NULL", "valid_product_ref": "product_id IS NOT NULL",
                  "valid_quantity": "quantity_on_hand IS NULL OR quantity_on_hand >= 0"},
}


# --- source files derived from the driver tables --------------------------------

def sample_source_frames(spark: SparkSession, sf_dir: str) -> dict[str, list[tuple[str, DataFrame]]]:
    """Per source folder, (system, frame) pairs shaped like the surveyed CSV
    schemas. Customers and products come from two systems that both carry
    every record, formatted differently, so they overlap completely."""
    cust = table(spark, sf_dir, "customer").alias("c")
    nat = table(spark, sf_dir, "nation").alias("n")
    reg = table(spark, sf_dir, "region").alias("r")
    cn = cust.join(nat, F.col("c.c_nationkey") == F.col("n.n_nationkey")).join(
        reg, F.col("n.n_regionkey") == F.col("r.r_regionkey"))
    handle = F.replace(F.col("c_name"), F.lit("#"), F.lit("."))
    base_c = cn.select(
        F.format_string("CUST%08d", "c_custkey").alias("customer_id"),
        F.lower("c_mktsegment").alias("first_name"),
        F.col("n_name").alias("last_name"),
        F.concat(F.lower(handle), F.lit("@email.com")).alias("email"),
        F.format_string("+1-555-%04d", F.pmod("c_custkey", F.lit(10000))).alias("phone"),
        F.format_string("%d Main St", "c_custkey").alias("address"),
        F.initcap("n_name").alias("city"),
        F.col("r_name").alias("country"),
        F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), F.col("c_nationkey") * 10), "yyyy-MM-dd")
        .alias("registration_date"),
        F.col("c_mktsegment").alias("customer_type"),
    )
    sales_c = base_c.select(
        "customer_id", F.upper("first_name").alias("first_name"), "last_name",
        F.concat(F.lit(" "), F.upper("email"), F.lit(" ")).alias("email"),
        F.regexp_replace("phone", "[^0-9]", "").alias("phone"),
        "address", "city", "country", "registration_date", "customer_type")

    part = table(spark, sf_dir, "part")
    erp = part.select(
        F.format_string("PROD%06d", "p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.lower("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"),
        F.lit("USD").alias("currency"),
        (F.col("p_size") * 10).alias("stock_quantity"),
        F.format_string("SKU-%06d", "p_partkey").alias("sku"),
        (F.col("p_size") / 10.0).alias("weight_kg"),
        F.when(F.col("p_size") > 10, F.lit("yes")).otherwise(F.lit("no")).alias("is_active"),
    )
    warehouse = erp.select("product_id", F.upper("product_name").alias("product_name"), "category", "brand",
                           "price", "currency", (F.col("stock_quantity") + 1).alias("stock_quantity"), "sku",
                           "weight_kg", F.when(F.col("is_active") == "yes", F.lit("1")).otherwise(F.lit("0"))
                           .alias("is_active"))

    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders")
    orders = li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.format_string("ORD%d-%d", "l_orderkey", "l_linenumber").alias("order_id"),
        F.format_string("CUST%08d", "o_custkey").alias("customer_id"),
        F.format_string("PROD%06d", "l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.round(F.col("l_extendedprice") / F.col("l_quantity"), 2).alias("unit_price"),
        F.col("l_extendedprice").alias("total_amount"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("l_returnflag").alias("shipping_method"),
        F.col("o_orderpriority").alias("payment_method"),
    )

    sup = table(spark, sf_dir, "supplier").alias("s")
    sn = sup.join(nat, F.col("s.s_nationkey") == F.col("n.n_nationkey"))
    employees = sn.select(
        F.format_string("EMP%06d", "s_suppkey").alias("employee_id"),
        F.lit("supplier").alias("first_name"),
        F.lower("n_name").alias("last_name"),
        F.concat(F.upper(F.replace(F.col("s_name"), F.lit("#"), F.lit("."))), F.lit("@CORP.EXAMPLE ")).alias("email"),
        F.format_string("D%02d", "n_regionkey").alias("department"),
        F.lit("buyer").alias("job_title"),
        F.date_format(F.date_add(F.lit("2015-06-01").cast("date"), F.col("s_nationkey")), "yyyy-MM-dd")
        .alias("hire_date"),
        F.col("s_acctbal").cast("int").alias("salary"),
        F.lit(None).cast("string").alias("manager_id"),
        F.col("n_name").alias("location"),
    )
    inventory = part.select(
        F.format_string("INV%06d", "p_partkey").alias("inventory_id"),
        F.format_string("PROD%06d", "p_partkey").alias("product_id"),
        F.format_string("WH-%s", "p_type").alias("warehouse_location"),
        F.col("p_size").alias("quantity_on_hand"),
        F.lit(10).alias("reorder_level"),
        F.lit(50).alias("reorder_quantity"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")), "yyyy-MM-dd")
        .alias("last_restock_date"),
        F.format_string("SUP%s", "p_brand").alias("supplier_id"),
        F.round(F.col("p_retailprice") / 2, 2).alias("unit_cost"),
    )
    return {
        "customers": [("sap", base_c), ("salesforce", sales_c)],
        "products": [("erp", erp), ("warehouse", warehouse)],
        "orders": [("ecommerce", orders)],
        "employees": [("hr", employees)],
        "inventory": [("warehouse", inventory)],
    }


def write_sample_sources(spark: SparkSession, sf_dir: str, base: str,
                         only: Sequence[str] | None = None) -> str:
    """Write the source folders as CSV with a header, one sub-folder per
    system (``<base>/<source>/<system>/part-*.csv``)."""
    for src, frames in sample_source_frames(spark, sf_dir).items():
        if only and src not in only:
            continue
        for system, df in frames:
            df.write.mode("overwrite").option("header", "true").csv(f"{base}/{src}/{system}")
    return base

