"""Cleaning, fingerprint, identity-key and union queries over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from goldenrec.functions import normalize as N
from goldenrec.functions.hashing import data_columns, record_hash
from goldenrec.operators import cleaning, identity, monitor
from goldenrec.plans.catalog import CTE_PERSONS
from goldenrec.plans.persons import persons, table
from goldenrec.plans.registry import initcap_sql, register, with_ctes


@register("trim_all_strings", """
select doc_id, trim(text) as text, trim(lang) as lang, trim(source) as source, n_chars from documents""")
def q_trim_all_strings(spark, sf_dir):
    """C1 over whole documents (text included)."""
    return cleaning.trim_strings(table(spark, sf_dir, "documents"))


@register("normalize_company", """
select s.s_suppkey as supplier_id,
       upper(trim(regexp_replace(concat(' ', s.s_name, '  ', chr(9), lower(n.n_name), ' '), '\\s+', ' ', 'g')))
         as company_name
from supplier s join nation n on s.s_nationkey = n.n_nationkey""")
def q_normalize_company(spark, sf_dir):
    """C10 on a padded, mixed-whitespace company name built from supplier + nation."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    raw = s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("s_suppkey").alias("supplier_id"),
        F.concat(F.lit(" "), F.col("s_name"), F.lit("  \t"), F.lower("n_name"), F.lit(" ")).alias("company_name"))
    return cleaning.normalize_company(raw)


@register("full_name", f"""
select customer_id, first_name, last_name, first_name || ' ' || last_name as full_name from (
  select c.c_custkey as customer_id,
         case when c.c_acctbal < 0 then null else {initcap_sql('trim(c.c_mktsegment)')} end as first_name,
         {initcap_sql('trim(n.n_name)')} as last_name
  from customer c join nation n on c.c_nationkey = n.n_nationkey)""")
def q_full_name(spark, sf_dir):
    """C4 + C7: initcap names, then first + ' ' + last (NULL if a part is NULL)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    raw = c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("first_name"),
        F.col("n_name").alias("last_name"))
    return cleaning.add_full_name(cleaning.normalize_names(raw))


_ACTIVE_RAW = ("case when o_orderpriority = '5-LOW' then null when o_orderstatus = 'F' then 'Yes' "
               "when o_orderstatus = 'O' then ' n ' else 'maybe' end")


def _orders_flag(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_ACTIVE_RAW).alias("is_active"))


@register("boolean_three_state", f"""
select o_orderkey,
       case when lower(trim(is_active)) in ('true', 'yes', '1', 't', 'y') then true
            when lower(trim(is_active)) in ('false', 'no', '0', 'f', 'n') then false
            else null end as is_active
from (select o_orderkey, {_ACTIVE_RAW} as is_active from orders)""")
def q_boolean_three_state(spark, sf_dir):
    """True / false / NULL for anything else."""
    return cleaning.standardize_boolean(_orders_flag(spark, sf_dir))


@register("boolean_two_state", f"""
select o_orderkey, coalesce(lower(is_active) in ('true', 'yes', '1'), false) as is_active
from (select o_orderkey, {_ACTIVE_RAW} as is_active from orders)""")
def q_boolean_two_state(spark, sf_dir):
    """true/yes/1 -> true, everything else (NULL too) -> false."""
    return cleaning.two_state_boolean(_orders_flag(spark, sf_dir))


_DATE_TEXT = ("case when o_orderpriority = '1-URGENT' then 'not a date' "
              "when o_orderpriority = '2-HIGH' then concat(cast(year(o_orderdate) as varchar), '-13-01') "
              "when o_orderpriority = '3-MEDIUM' then '' "
              "else cast(cast(o_orderdate as date) as varchar) end")
_DATE_TEXT_SPARK = ("case when o_orderpriority = '1-URGENT' then 'not a date' "
                    "when o_orderpriority = '2-HIGH' then concat(cast(year(o_orderdate) as string), '-13-01') "
                    "when o_orderpriority = '3-MEDIUM' then '' "
                    "else date_format(o_orderdate, 'yyyy-MM-dd') end")


@register("parse_dates", f"""
select o_orderkey, order_date_text, try_cast(order_date_text as date) as order_date
from (select o_orderkey, {_DATE_TEXT} as order_date_text from orders)""")
def q_parse_dates(spark, sf_dir):
    """Text dates (some malformed or blank) to DATE; bad input -> NULL."""
    raw = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_DATE_TEXT_SPARK).alias("order_date_text"))
    return raw.withColumn("order_date", N.parse_date("order_date_text"))


@register("record_hash", """
select o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
       md5(concat_ws('||', cast(o_orderkey as varchar), cast(o_custkey as varchar), o_orderstatus, o_orderpriority))
         as _record_hash
from orders""")
def q_record_hash(spark, sf_dir):
    """C11 default: md5 over the data columns joined with '||' (NULLs skipped)."""
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return df.withColumn("_record_hash", record_hash(data_columns(df)))


@register("record_hash_all_columns", """
select *, md5(concat_ws('||', cast(o_orderkey as varchar), cast(o_custkey as varchar), o_orderstatus, cast(o_totalprice as varchar),
                        cast(o_orderdate as varchar), o_orderpriority)) as _record_hash
from orders""")
def q_record_hash_all_columns(spark, sf_dir):
    """C11 default over the whole table: a changed price or date changes the hash."""
    df = table(spark, sf_dir, "orders")
    return df.withColumn("_record_hash", record_hash(data_columns(df)))


@register("record_hash_null_safe", with_ctes(CTE_PERSONS, body="""
select *, md5(concat_ws('||', """ + ", ".join(
    f"coalesce(cast({c} as varchar), '\\N')"
    for c in ("person_id", "name", "email", "phone", "age", "source_file_path")) + """)) as _record_hash
from persons"""))
def q_record_hash_null_safe(spark, sf_dir):
    """C11 null_safe: a marker per NULL keeps positions apart."""
    df = persons(spark, sf_dir)
    return df.withColumn("_record_hash", record_hash(data_columns(df), null_safe=True))


@register("file_name_from_path", """
select page_id, url, regexp_extract(url, '([^/]+)$', 1) as file_name from pages""")
def q_file_name_from_path(spark, sf_dir):
    """S10's regex: last path segment of a URL/path."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    return p.withColumn("file_name", N.file_name_from_path("url"))


_DOC_KEY_SQL = "sha256(lower(trim(regexp_replace(text, '[ \\t\\r\\n]+', ' ', 'g'))))"


@register("exact_dedup_documents", f"""
select {_DOC_KEY_SQL} as text_key, min(doc_id) as doc_id, count(*) as copies from documents group by 1""")
def q_exact_dedup_documents(spark, sf_dir):
    """K4 on whole document texts: key = sha-256 of the whitespace-normalized,
    lower-cased text (the shuffle carries 64 hex chars, not the text)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    norm = F.lower(F.trim(F.regexp_replace("text", r"[ \t\r\n]+", " ")))
    keyed = d.select(F.sha2(norm, 256).alias("text_key"), "doc_id")
    return identity.exact_duplicates(keyed, ["text_key"], "doc_id")


@register("exact_dedup_events", """
select user_id, event_type, min(event_id) as event_id, count(*) as copies from events group by user_id, event_type""")
def q_exact_dedup_events(spark, sf_dir):
    """K4 on configurable columns (user_id, event_type)."""
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    return identity.exact_duplicates(e, ["user_id", "event_type"], "event_id")


def _entities(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    sup = table(spark, sf_dir, "supplier")
    products = part.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
                           F.concat_ws("-", "p_brand", F.col("p_size").cast("string")).alias("sku"))
    employees = sup.select(F.col("s_suppkey").alias("employee_id"),
                           F.concat(F.lower(F.replace("s_name", F.lit("#"), F.lit("."))),
                                    F.lit("@corp.example")).alias("email"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"),
                                                   F.col("o_custkey").alias("customer_ref"))
    nation = table(spark, sf_dir, "nation")
    return {"products": products, "employees": employees, "orders": orders, "nation": nation}


@register("per_entity_identifier", """
select 'products' as entity, concat_ws('-', p_brand, cast(p_size as varchar)) as unique_identifier, count(*) as repetition
from part group by 2
union all
select 'employees', concat(lower(replace(s_name, '#', '.')), '@corp.example'), count(*) from supplier group by 2
union all
select 'orders', cast(o_orderkey as varchar), count(*) from orders group by 2
union all
select 'nation', md5(concat_ws('||', cast(n_nationkey as varchar), n_name, cast(n_regionkey as varchar))), count(*)
from nation group by 2""")
def q_per_entity_identifier(spark, sf_dir):
    """K3: products -> sku, employees -> email, others -> first *id* column,
    none -> record hash; repetition per identifier."""
    parts = []
    for entity, df in _entities(spark, sf_dir).items():
        keyed = df.select(F.lit(entity).alias("entity"), identity.entity_identifier(df, entity).alias("unique_identifier"))
        parts.append(keyed.groupBy("entity", "unique_identifier").agg(F.count(F.lit(1)).alias("repetition")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("multi_source_union", """
select concat('C', cast(c_custkey as varchar)) as contact_id, c_name as name, c_acctbal as balance,
       c_mktsegment as segment, 'customer' as system
from customer
union all
select concat('S', cast(s_suppkey as varchar)), s_name, s_acctbal, null, 'supplier' from supplier""")
def q_multi_source_union(spark, sf_dir):
    """Two systems stacked by column name; a column one side lacks is NULL."""
    c = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("contact_id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("system"))
    s = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("contact_id"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"), F.lit("supplier").alias("system"))
    return monitor.stack_sources([c, s])
