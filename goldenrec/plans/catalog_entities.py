"""Per-entity golden records over the two-system customer and product feeds
(derived from the driver tables, not written to files): the customers' and
products' own normalizations, per-entity identity keys and tie-breaks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldenrec.operators import cleaning, golden, identity
from goldenrec.operators.golden import OrderKey
from goldenrec.plans import source_tables as st
from goldenrec.plans.registry import initcap_sql, register, with_ctes
from goldenrec.sources.spec import spec_by_name

# --- DuckDB twins of the derived feeds -----------------------------------------

CTE_CUSTOMER_FEED = """sap as (
  select printf('CUST%08d', c.c_custkey) as customer_id, lower(c.c_mktsegment) as first_name,
         n.n_name as last_name, lower(replace(c.c_name, '#', '.')) || '@email.com' as email,
         printf('+1-555-%04d', c.c_custkey % 10000) as phone, printf('%d Main St', c.c_custkey) as address,
         """ + initcap_sql("n.n_name") + """ as city, r.r_name as country,
         strftime(date '2020-01-01' + cast(c.c_nationkey * 10 as integer), '%Y-%m-%d') as registration_date,
         c.c_mktsegment as customer_type
  from customer c join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey),
feed as (
  select 'sap' as system, * from sap
  union all
  select 'salesforce', customer_id, upper(first_name), last_name, ' ' || upper(email) || ' ',
         regexp_replace(phone, '[^0-9]', '', 'g'), address, city, country, registration_date, customer_type
  from sap),
clean as (
  select system, customer_id,
         """ + initcap_sql("trim(first_name)") + """ as first_name,
         """ + initcap_sql("trim(last_name)") + """ as last_name,
         lower(trim(email)) as email, regexp_replace(phone, '[^0-9+]', '', 'g') as phone,
         address, city, country, try_cast(registration_date as date) as registration_date, customer_type
  from feed),
identified as (
  select *, first_name || ' ' || last_name as full_name,
         coalesce(nullif(trim(email), ''), nullif(trim(phone), ''),
                  concat_ws('_', nullif(trim(first_name), ''), nullif(trim(city), ''))) as unique_identifier
  from clean)"""

CUSTOMER_COLS = ("system, customer_id, first_name, last_name, email, phone, address, city, country, "
                 "registration_date, customer_type, full_name, unique_identifier")

GOLDEN_TAIL = """,
counts as (select unique_identifier, count(*) as repetition from identified group by unique_identifier),
ranked as (
  select i.*, case when c.repetition > 2 then 'High' when c.repetition = 2 then 'Moderate' else 'Low' end
           as confidence
  from identified i join counts c on i.unique_identifier = c.unique_identifier)"""


def _customer_feed(spark, sf_dir):
    frames = st.sample_source_frames(spark, sf_dir)["customers"]
    a, b = [df.select(F.lit(system).alias("system"), "*") for system, df in frames]
    df = a.unionByName(b)
    df = cleaning.normalize_names(df, ("first_name", "last_name"))
    df = cleaning.normalize_email(df)
    df = cleaning.normalize_phone(df)
    df = cleaning.parse_dates(df, ["registration_date"])
    df = cleaning.add_full_name(df)
    return df.withColumn("unique_identifier", identity.entity_identifier(df, "customers"))


@register("golden_customers", with_ctes(CTE_CUSTOMER_FEED + GOLDEN_TAIL, body=f"""
select {CUSTOMER_COLS}, confidence, confidence_rank, row_num from (
  select *, case confidence when 'High' then 3 when 'Moderate' then 2 when 'Low' then 1 end as confidence_rank,
         cast(row_number() over (partition by unique_identifier
              order by case confidence when 'High' then 3 when 'Moderate' then 2 when 'Low' then 1 end desc,
                       registration_date desc nulls last, system asc) as integer) as row_num
  from ranked) where row_num = 1"""))
def q_golden_customers(spark, sf_dir):
    """G4 for customers: key = email, else phone, else first_name_city (blanks
    missing); best = highest confidence, newest registration, then system."""
    order = (OrderKey("confidence_rank"), OrderKey("registration_date"), OrderKey("system", descending=False))
    return golden.golden_by_key(_customer_feed(spark, sf_dir), order=order)


@register("dedup_by_source_columns", """
select 'customers' as source_type, concat_ws('|', email, phone, first_name, last_name) as dedup_key,
       min(customer_id) as record_id, count(*)::bigint as copies
from (""" + with_ctes(CTE_CUSTOMER_FEED, body="select * from clean") + ") group by email, phone, first_name, last_name")
def q_dedup_by_source_columns(spark, sf_dir):
    """K4: exact dedup by the columns a source declares (``dedup_columns``)."""
    spec = spec_by_name("customers", "")
    found = identity.exact_duplicates(_customer_feed(spark, sf_dir), spec.dedup_columns, spec.primary_key_columns[0])
    return found.select(F.lit(spec.name).alias("source_type"), F.concat_ws("|", *spec.dedup_columns).alias("dedup_key"),
                        F.col(spec.primary_key_columns[0]).alias("record_id"), "copies")


CTE_PRODUCT_FEED = """erp as (
  select printf('PROD%06d', p_partkey) as product_id, p_name as product_name, lower(p_type) as category,
         p_brand as brand, p_retailprice as price, 'USD' as currency, p_size * 10 as stock_quantity,
         printf('SKU-%06d', p_partkey) as sku, p_size / 10.0 as weight_kg,
         case when p_size > 10 then 'yes' else 'no' end as is_active
  from part),
feed as (
  select 'erp' as system, * from erp
  union all
  select 'warehouse', product_id, upper(product_name), category, brand, price, currency, stock_quantity + 1, sku,
         weight_kg, case when is_active = 'yes' then '1' else '0' end
  from erp),
identified as (
  select system, product_id, """ + initcap_sql("trim(product_name)") + """ as product_name,
         """ + initcap_sql("trim(category)") + """ as category, brand, price, currency, stock_quantity, sku,
         weight_kg, coalesce(lower(is_active) in ('true', 'yes', '1'), false) as is_active, sku as unique_identifier
  from feed)"""

PRODUCT_COLS = ("system, product_id, product_name, category, brand, price, currency, stock_quantity, sku, "
                "weight_kg, is_active, unique_identifier")


def _product_feed(spark, sf_dir):
    frames = st.sample_source_frames(spark, sf_dir)["products"]
    a, b = [df.select(F.lit(system).alias("system"), "*") for system, df in frames]
    df = a.unionByName(b)
    df = cleaning.normalize_names(df, ("product_name", "category"))
    df = cleaning.two_state_boolean(df, "is_active")
    return df.withColumn("unique_identifier", identity.entity_identifier(df, "products"))


@register("golden_products", with_ctes(CTE_PRODUCT_FEED + GOLDEN_TAIL, body=f"""
select {PRODUCT_COLS}, confidence, confidence_rank, row_num from (
  select *, case confidence when 'High' then 3 when 'Moderate' then 2 when 'Low' then 1 end as confidence_rank,
         cast(row_number() over (partition by unique_identifier
              order by case confidence when 'High' then 3 when 'Moderate' then 2 when 'Low' then 1 end desc,
                       price asc nulls last, system asc) as integer) as row_num
  from ranked) where row_num = 1"""))
def q_golden_products(spark, sf_dir):
    """G4 for products: key = sku; best = highest confidence, lowest price,
    then system."""
    order = (OrderKey("confidence_rank"), OrderKey("price", descending=False), OrderKey("system", descending=False))
    return golden.golden_by_key(_product_feed(spark, sf_dir), order=order)


@register("products_standardized", with_ctes(CTE_PRODUCT_FEED, body="""
select system, product_id, product_name, category, sku, flag_raw,
       case when lower(trim(flag_raw)) in ('true', 'yes', '1', 't', 'y') then true
            when lower(trim(flag_raw)) in ('false', 'no', '0', 'f', 'n') then false
            else null end as is_active
from (select system, product_id, """ + initcap_sql("trim(product_name)") + """ as product_name,
             category, sku, is_active as flag_raw
      from feed)"""))
def q_products_standardized(spark, sf_dir):
    """The products catalogue transforms on both systems' records:
    initcap names (C4) and three-state booleans for ``is_*`` columns (C5)."""
    from goldenrec.sources.spec import products_spec

    frames = st.sample_source_frames(spark, sf_dir)["products"]
    a, b = [df.select(F.lit(system).alias("system"), "*") for system, df in frames]
    df = a.unionByName(b).select("system", "product_id", "product_name", "category", "sku",
                                 F.col("is_active").alias("flag_raw"), F.col("is_active"))
    return cleaning.apply_transforms(df, products_spec("").transformations)


@register("products_standardized_all_columns", with_ctes(CTE_PRODUCT_FEED, body="""
select * replace (""" + initcap_sql("trim(product_name)") + """ as product_name,
                  case when lower(trim(is_active)) in ('true', 'yes', '1', 't', 'y') then true
                       when lower(trim(is_active)) in ('false', 'no', '0', 'f', 'n') then false
                       else null end as is_active),
       is_active as flag_raw
from feed"""))
def q_products_standardized_all_columns(spark, sf_dir):
    """products_standardized with every column of the feed."""
    from goldenrec.sources.spec import products_spec

    frames = st.sample_source_frames(spark, sf_dir)["products"]
    a, b = [df.select(F.lit(system).alias("system"), "*") for system, df in frames]
    df = a.unionByName(b).select("*", F.col("is_active").alias("flag_raw"))
    return cleaning.apply_transforms(df, products_spec("").transformations)


# --- employees, orders, inventory: a second system resends part of the records ---

#: What the source folders hold of these three entities, as their tables type it.
CTE_EMPLOYEES = """employees as (
  select 'hr' as system, printf('EMP%06d', s.s_suppkey) as employee_id, 'Supplier' as first_name,
         """ + initcap_sql("n.n_name") + """ as last_name, lower(replace(s.s_name, '#', '.')) || '@corp.example' as email,
         printf('D%02d', n.n_regionkey) as department, 'buyer' as job_title,
         date '2015-06-01' + cast(s.s_nationkey as integer) as hire_date, cast(trunc(s.s_acctbal) as integer) as salary,
         cast(null as varchar) as manager_id, n.n_name as location, 'Supplier ' || """ + initcap_sql("n.n_name") + """ as full_name
  from supplier s join nation n on s.s_nationkey = n.n_nationkey)"""
CTE_ORDERS = """sales as (
  select 'ecommerce' as system, printf('ORD%d-%d', l_orderkey, l_linenumber) as order_id, printf('CUST%08d', o_custkey) as customer_id,
         printf('PROD%06d', l_partkey) as product_id, cast(trunc(l_quantity) as integer) as quantity,
         cast(round(cast(cast(l_extendedprice / l_quantity as varchar) as decimal(30, 15)), 2) as double) as unit_price,
         l_extendedprice as total_amount, cast(o_orderdate as date) as order_date, o_orderstatus as status,
         l_returnflag as shipping_method, o_orderpriority as payment_method
  from lineitem join orders on l_orderkey = o_orderkey)"""
CTE_INVENTORY = """stock as (
  select 'warehouse' as system, printf('INV%06d', p_partkey) as inventory_id, printf('PROD%06d', p_partkey) as product_id,
         'WH-' || p_type as warehouse_location, p_size as quantity_on_hand, 10 as reorder_level, 50 as reorder_quantity,
         date '2024-01-01' + cast(p_size as integer) as last_restock_date, 'SUP' || p_brand as supplier_id,
         cast(round(cast(cast(p_retailprice / 2 as varchar) as decimal(30, 15)), 2) as double) as unit_cost
  from part)"""


def _resent(spark, sf_dir, source: str, system: str, part: str, changes: dict) -> DataFrame:
    """The records of the source's one system, and those for which ``part``
    holds once more from ``system``, with ``changes``; keyed by K3."""
    (first, df), = st.sample_source_frames(spark, sf_dir)[source]
    again = df.filter(part)
    both = df.select(F.lit(first).alias("system"), "*").unionByName(again.select(
        F.lit(system).alias("system"), *(changes.get(c, F.col(c)).alias(c) for c in df.columns)))
    spec = spec_by_name(source, "")
    both = cleaning.apply_transforms(both, spec.transformations)
    dates = [c for c in both.columns if c.endswith("_date")]
    both = cleaning.parse_dates(both, dates)
    return both.withColumn("unique_identifier", identity.entity_identifier(both, source))


def _golden_sql(cte: str, base: str, key: str, system: str, part: str, changes: str, newest: str, ties: tuple[str, ...] = ()) -> str:
    again = f"select * replace ('{system}' as system, {changes}) from {base} where {part}"
    tail = GOLDEN_TAIL.replace("identified i", "keyed i").replace("from identified", "from keyed")
    return with_ctes(cte, f"both_systems as (select * from {base} union all {again})", f"keyed as (select *, {key} as unique_identifier from both_systems)" + tail,
                     body=f"""
select * from (
  select *, case confidence when 'High' then 3 when 'Moderate' then 2 when 'Low' then 1 end as confidence_rank,
         cast(row_number() over (partition by unique_identifier order by {", ".join([newest + " desc nulls last", "system", *ties])}) as integer) as row_num
  from ranked) where row_num = 1""")


def _newest(column: str, ties: tuple[str, ...] = ()) -> tuple[OrderKey, ...]:
    return OrderKey("confidence_rank"), OrderKey(column), *(OrderKey(c, descending=False) for c in ("system", *ties))


@register("golden_employees", _golden_sql(CTE_EMPLOYEES, "employees", "email", "payroll", "salary >= 0", "hire_date + 30 as hire_date", "hire_date"))
def q_golden_employees(spark, sf_dir):
    """G4/K3 for employees: key = email, whose spelling differs between the two
    systems; best = highest confidence, newest hire date, then system."""
    later = F.date_format(F.date_add(F.to_date("hire_date"), 30), "yyyy-MM-dd")
    feed = _resent(spark, sf_dir, "employees", "payroll", "salary >= 0", {"email": F.lower(F.trim("email")), "hire_date": later})
    return golden.golden_by_key(feed, order=_newest("hire_date"))


#: Order ids repeat in the line items, so orders need more columns to tell ties apart.
_ORDER_TIES = ("total_amount", "product_id", "quantity", "shipping_method")


@register("golden_orders", _golden_sql(CTE_ORDERS, "sales", "order_id", "billing", "status = 'F'", "'billed' as status", "order_date", _ORDER_TIES))
def q_golden_orders(spark, sf_dir):
    """G4/K3 for orders: key = the first column whose name holds id; best =
    highest confidence, newest order, system, then _ORDER_TIES."""
    feed = _resent(spark, sf_dir, "orders", "billing", "status = 'F'", {"status": F.lit("billed")})
    return golden.golden_by_key(feed, order=_newest("order_date", _ORDER_TIES))


@register("golden_inventory", _golden_sql(CTE_INVENTORY, "stock", "inventory_id", "audit", "quantity_on_hand > 25",
                                          "quantity_on_hand + 1 as quantity_on_hand, last_restock_date + 7 as last_restock_date", "last_restock_date"))
def q_golden_inventory(spark, sf_dir):
    """G4/K3 for inventory: key = the first column whose name holds id; best =
    highest confidence, newest restock, then system."""
    later = F.date_format(F.date_add(F.to_date("last_restock_date"), 7), "yyyy-MM-dd")
    feed = _resent(spark, sf_dir, "inventory", "audit", "quantity_on_hand > 25",
                   {"quantity_on_hand": F.col("quantity_on_hand") + 1, "last_restock_date": later})
    return golden.golden_by_key(feed, order=_newest("last_restock_date"))
