"""Queries over the ways in and out: registry and dispatch, custom and example
sources, malformed records, changing schemas, streams of CSV files, named and
bucketed tables, sketches of ingests, keys of several columns, table changes."""

from __future__ import annotations

import uuid
from itertools import combinations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from goldenrec.operators import composite_keys, golden, ingest_sketches, metadata, quality, snapshot
from goldenrec.plans import catalog, layers
from goldenrec.plans import source_tables as st
from goldenrec.plans.persons import persons, table
from goldenrec.plans.registry import ORACLE, register, with_ctes
from goldenrec.session import materialize, shared_dir
from goldenrec.sources import checked, readers, sinks
from goldenrec.sources.spec import SourceRegistry, custom_spec, suppliers_spec, vendors_spec
from goldenrec.streaming import dedup, jobs

# --- S3, S4, S13, S14, S18: registry, dispatch, custom and example sources ----

CTE_VENDORS = """vendors as (
  select printf('V%06d', s_suppkey) as vendor_id, case when s_suppkey % 10 = 3 then null else printf('C-%d', s_suppkey) end as vendor_code,
         case when s_suppkey % 2 = 0 then s_name || ' Inc.' else s_name || ' LLC' end as company_name,
         case when s_suppkey % 4 = 0 then null when s_suppkey % 4 = 1 then '12-' || s_suppkey else lpad(s_suppkey::varchar, 9, '1') end as tax_id,
         ['NET30', 'NET60', 'COD', 'LATER'][1 + s_suppkey % 4] as payment_terms
  from supplier),
suppliers as (
  select printf('S%06d', s_suppkey) as supplier_id, case when s_suppkey % 7 = 0 then null else s_name end as company_name,
         lower(replace(s_name, '#', '.')) || '@example.com' as contact_email
  from supplier),
shops as (select n_nationkey as shop_id, n_name as shop_name from nation)"""


def _example_sources(spark, sf_dir):
    s, base = table(spark, sf_dir, "supplier"), shared_dir(spark, "sources", "examples")
    k, name = F.col("s_suppkey"), F.col("s_name")
    s.select(
        F.format_string("V%06d", k).alias("vendor_id"), F.when(k % 10 != 3, F.format_string("C-%d", k)).alias("vendor_code"),
        F.concat(name, F.when(k % 2 == 0, F.lit(" Inc.")).otherwise(F.lit(" LLC"))).alias("company_name"),
        F.when(k % 4 == 1, F.concat(F.lit("12-"), k)).when(k % 4 > 1, F.lpad(k.cast("string"), 9, "1")).alias("tax_id"),
        F.element_at(F.array(*map(F.lit, ("NET30", "NET60", "COD", "LATER"))), (k % 4 + 1).cast("int")).alias("payment_terms"),
    ).write.option("header", "true").csv(f"{base}/vendors")
    s.select(F.format_string("S%06d", k).alias("supplier_id"), F.when(k % 7 != 0, name).alias("company_name"),
             F.concat(F.lower(F.replace(name, F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("contact_email"),
             ).write.option("header", "true").csv(f"{base}/suppliers")
    table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("shop_id"), F.col("n_name").alias("shop_name")).write.json(f"{base}/shops")
    shops = custom_spec("shops", f"{base}/shops", ["shop_id"], file_format="json", read_options={"multiLine": "false"},
                        quality_rules={"long_name": "length(shop_name) > 5"})
    return [st.line_oriented(spec) for spec in (vendors_spec(base), suppliers_spec(base), shops)]


def _rules_sql(source: str, rules: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{source}' as source_type, '{name}' as rule, count_if(coalesce({rule}, false))::bigint as passed,"
        f" count_if(not coalesce({rule}, false))::bigint as failed from {source}" for name, rule in rules.items())


EXAMPLE_RULES_SQL = {
    "vendors": {"valid_vendor_id": "vendor_id is not null", "valid_vendor_code": "vendor_code is not null",
                "valid_tax_id": "tax_id is null or regexp_matches(tax_id, '^[0-9]{9}$')",
                "valid_payment_terms": "payment_terms in ('NET30', 'NET60', 'NET90', 'COD')"},
    "suppliers": {"valid_supplier_id": "supplier_id is not null", "valid_company_name": "company_name is not null"},
    "shops": {"long_name": "length(shop_name) > 5", "valid_shop_id": "shop_id is not null"},
}


@register("example_sources_quality", with_ctes(CTE_VENDORS, body=" union all ".join(_rules_sql(s, r) for s, r in EXAMPLE_RULES_SQL.items())))
def q_example_sources_quality(spark, sf_dir):
    """Vendors, suppliers and a custom JSON source through
    ``process_all_sources``, each with its own and its key rules."""
    specs = {s.name: s for s in _example_sources(spark, sf_dir)}
    found = None
    for name, df in st.process_all_sources(spark, list(specs.values())).items():
        source = name.removeprefix("pre_bronze_")
        rep = quality.report(df, specs[source].expectations()).select(F.lit(source).alias("source_type"), "*")
        found = rep if found is None else found.unionByName(rep)
    return found


@register("registry_dispatch", with_ctes(CTE_VENDORS, body="""
select 'suppliers' as source_type, supplier_id as id, company_name as name from suppliers
union all select 'shops', shop_id::varchar, shop_name from shops"""))
def q_registry_dispatch(spark, sf_dir):
    """Reads by registered name; the later of two registrations counts."""
    vendors, suppliers, shops = _example_sources(spark, sf_dir)
    registry = SourceRegistry([vendors, suppliers, custom_spec("shops", "/nowhere", ["shop_id"])])
    registry.register(shops)
    a = readers.read_source(spark, registry, "suppliers").select(F.lit("suppliers").alias("source_type"), F.col("supplier_id").alias("id"), F.col("company_name").alias("name"))
    b = readers.read_source(spark, registry, "shops").select(F.lit("shops").alias("source_type"), F.col("shop_id").cast("string").alias("id"), F.col("shop_name").alias("name"))
    return a.unionByName(b)


# --- S6, S7, S9: a recursive stream of CSV files with their lineage -------------

@register("stream_csv_lineage", """
select n_name as folder, c_custkey as customer_id, c_mktsegment as segment from customer join nation on c_nationkey = n_nationkey""")
def q_stream_csv_lineage(spark, sf_dir):
    """CSV files in folders, read as one stream; each row keeps the
    folder of its file, from the scan's own file path."""
    base, out = shared_dir(spark, "stream", "csv"), shared_dir(spark, "stream", "bronze")
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows.select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("feed")) \
        .write.partitionBy("feed").option("header", "true").csv(base)
    spec = custom_spec("customers", base, ["customer_id"], schema=StructType.fromDDL("customer_id long, segment string"))
    stream = metadata.with_file_columns(readers.read_stream(spark, st.line_oriented(spec), max_files_per_trigger=20))
    jobs.run_to_parquet(stream, out, shared_dir(spark, "stream", "ckpt"))
    folder = F.regexp_extract("source_file_path", "feed=([^/]+)/[^/]+$", 1)
    return spark.read.parquet(out).select(F.regexp_replace(folder, "%20", " ").alias("folder"), "customer_id", "segment")


# --- S5, S6, Q5: malformed records and changing columns -------------------------

ORDER_LINE = "id long, status string, priority string"


def _order_lines(spark, sf_dir):
    """Orders as JSON lines; every fiftieth is cut short."""
    k = F.col("o_orderkey")
    line = F.concat(F.lit('{"id":'), k.cast("string"), F.lit(',"status":"'), "o_orderstatus", F.lit('","priority":"'), "o_orderpriority", F.lit('"}'))
    path = shared_dir(spark, "sources", "lines")
    table(spark, sf_dir, "orders").select(F.when(k % 50 == 7, F.substring(line, F.lit(1), F.length(line) - 9)).otherwise(line).alias("value")).write.text(path)
    return custom_spec("order_lines", path, ["id"], file_format="json", schema=StructType.fromDDL(ORDER_LINE), quality_rules={"closed": "status IN ('O', 'F')"})


CTE_LINES = """lines as (
  select o_orderkey, o_orderstatus, '{"id":' || o_orderkey || ',"status":"' || o_orderstatus || '","priority":"' || o_orderpriority || '"}' as line from orders)"""


@register("malformed_quarantine", with_ctes(CTE_LINES, body="""
select 'malformed_record' as reasons, null::bigint as id, substr(line, 1, length(line) - 9) as text from lines where o_orderkey % 50 = 7
union all select 'closed', o_orderkey, null from lines where o_orderkey % 50 <> 7 and o_orderstatus not in ('O', 'F')"""))
def q_malformed_quarantine(spark, sf_dir):
    """Broken JSON lines land in the quarantine with their text, beside
    the rows that fail a rule."""
    spec = _order_lines(spark, sf_dir)
    _, bad = checked.split_checked(checked.read_checked(spark, spec), spec.expectations())
    malformed = F.col(checked.CORRUPT).isNotNull()
    return bad.select(F.array_join(checked.REASONS, ",").alias("reasons"), F.when(~malformed, F.col("id")).alias("id"), F.col(checked.CORRUPT).alias("text"))


@register("stream_new_column", """
select o_orderkey as id, o_orderstatus as status, case when o_orderkey % 2 = 1 then o_orderpriority end as priority, 2 as version from orders""")
def q_stream_new_column(spark, sf_dir):
    """A stream that is restarted after its JSON source grew a column; the
    saved schema goes to its second version and earlier rows have NULL there."""
    base, out, ckpt = (shared_dir(spark, "stream", p) for p in ("grow", "bronze", "ckpt"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    spec = custom_spec("orders", f"{base}/files", ["id"], file_format="json", read_options={"multiLine": "false"})
    for part, columns in ((0, ("id", "status")), (1, ("id", "status", "priority"))):
        orders.filter(F.col("id") % 2 == part).select(*columns).write.mode("append").json(spec.source_path)
        schema, version = checked.evolving_schema(spark, spec, f"{base}/schema")
        jobs.run_to_parquet(readers.read_stream(spark, spec, schema=schema), out, ckpt)
    # files of the first run lack the column; the latest schema reads all of them
    return spark.read.schema(schema).parquet(out).select("id", "status", "priority", F.lit(version).alias("version"))


# --- K4 on a stream --------------------------------------------------------------

@register("stream_dedup", "select event_id, user_id, event_type, value from events")
def q_stream_dedup(spark, sf_dir):
    """K4/ST2: a feed in which every third event is sent again within seconds,
    some of them in the next file; repeats are dropped within a watermark."""
    path, out = shared_dir(spark, "stream", "repeats"), shared_dir(spark, "stream", "dedup")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    again = events.filter("event_id % 3 = 0").withColumn("ts", F.expr("ts + interval 40 seconds"))
    feed, span = materialize(events.unionByName(again), "stream"), 8
    for at in range(0, 32, span):  # files in the order of time, each of eight days
        day = F.dayofmonth("ts")
        feed.filter((day >= at) & (day < at + span)).coalesce(1).write.mode("append").parquet(path)
    stream = jobs.bronze_stream(spark, path, feed.schema, max_files_per_trigger=1)
    spec = custom_spec("events", path, ["event_id"], file_format="parquet", dedup_columns=("event_id", "user_id", "event_type", "value"))
    jobs.run_to_parquet(dedup.drop_repeats_of(stream, spec, "ts", "9 days"), out, shared_dir(spark, "stream", "ckpt"))
    return spark.read.parquet(out).select("event_id", "user_id", "event_type", "value")


# --- S15, S16: named and bucketed tables ------------------------------------------

def _table_name(what: str) -> str:
    return f"goldenrec_{what}_{uuid.uuid4().hex[:12]}"


@register("named_table_layers", ORACLE["golden_by_name"])
def q_named_table_layers(spark, sf_dir):
    """Silver saved as a managed table, gold read from it by name."""
    name = sinks.save_table(layers.silver_identified(persons(spark, sf_dir)), _table_name("silver"))
    return layers.gold_from_identified(spark.read.table(name)).golden


@register("bucketed_golden_by_identifier", ORACLE["golden_by_identifier"])
def q_bucketed_golden_by_identifier(spark, sf_dir):
    """Golden record per identifier over a table bucketed by it, without
    a shuffle after the table is written."""
    name = sinks.save_bucketed(layers.silver_identified(persons(spark, sf_dir)), _table_name("bucketed"), golden.KEY, 16)
    return layers.gold_from_identified(spark.read.table(name), layers.PipelineParams(partition_by=(golden.KEY,))).golden


# --- A2, A3 by sketches ------------------------------------------------------------

@register("ingest_sketch_totals", """
select 'events' as source_type, min(ts)::date as first_day, max(ts)::date as last_day, count(*)::bigint as total_records, true as within_3_percent
from events having count(*) > 0""")
def q_ingest_sketch_totals(spark, sf_dir):
    """A2/A3: totals of a month of daily ingests from one sketch row a day; the
    estimate of unique records is held against the exact count."""
    events, path = table(spark, sf_dir, "events"), shared_dir(spark, "sketches")
    columns = ["user_id", "event_type"]
    ingest_sketches.save_ingest(ingest_sketches.ingest_row(events, "events", "ts", columns), path)
    found = ingest_sketches.totals(spark.read.parquet(path))
    exact = events.select(F.lit("events").alias("source_type"), *columns).groupBy("source_type").agg(F.count_distinct(*columns).alias("exact"))
    near = F.abs(F.col("unique_records") - F.col("exact")) <= 0.03 * F.col("exact")
    return found.join(exact, "source_type").select("source_type", "first_day", "last_day", "total_records", near.alias("within_3_percent"))


# --- PR5 with several columns --------------------------------------------------------

LINEITEM_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                    "l_linestatus", "l_shipdate")


def _keys_sql(columns, relation: str) -> str:
    sets = [s for n in (1, 2) for s in combinations(columns, n)]
    counted = " union all ".join(
        f"select {k} as place, '{','.join(s)}' as key_columns, {len(s)} as n_columns, (select count(*) from (select distinct {', '.join(s)} from {relation})"
        f" where {' and '.join(f'{c} is not null' for c in s)}) = (select count(*) from {relation}) as is_key" for k, s in enumerate(sets))
    return f"""with counted as ({counted}),
keys as (select * from counted where is_key),
minimal as (select * from keys k where n_columns = 1 or not exists (
  select 1 from keys o where o.n_columns = 1 and list_contains(string_split(k.key_columns, ','), o.key_columns)))
select key_columns, n_columns, place = (select min(place) from minimal) as suggested from minimal"""


@register("composite_keys_lineitem", _keys_sql(LINEITEM_COLUMNS, "lineitem"))
def q_composite_keys_lineitem(spark, sf_dir):
    """PR5: minimal keys of lineitem of up to two columns."""
    return composite_keys.key_report(table(spark, sf_dir, "lineitem"), LINEITEM_COLUMNS)


@register("composite_keys_conversations", _keys_sql(("conv_id", "turn", "role", "text"), "conversations"))
def q_composite_keys_conversations(spark, sf_dir):
    """PR5: minimal keys of conversations of up to two columns."""
    return composite_keys.key_report(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


# --- G7: changes between two golden tables ---------------------------------------------

def _two_golden(spark, sf_dir):
    p = persons(spark, sf_dir)
    params = layers.PipelineParams(partition_by=(golden.KEY,))
    early = p.filter(F.col("person_id") % 4 != 0)
    late = p.filter(F.col("person_id") % 10 != 9)
    return tuple(materialize(layers.gold_from_identified(layers.silver_identified(x), params).golden.drop("row_num"), "snapshot") for x in (early, late))


def _golden_at(where: str) -> str:
    ctes = (catalog.CTE_PERSONS.replace("persons as (", "all_persons as ("), f"persons as (select * from all_persons where {where})", *catalog.PIPELINE_CTES[1:])
    return with_ctes(*ctes, body=f"""
select {catalog.SCORED_COLS}, confidence_rank from (
  select *, row_number() over (partition by unique_identifier order by confidence_rank desc, age desc nulls last, person_id asc) as row_num from ranked) where row_num = 1""")


@register("golden_changes", f"""
with a as ({_golden_at('person_id % 4 <> 0')}), b as ({_golden_at('person_id % 10 <> 9')})
select b.*, case when a.unique_identifier is null then 'inserted' else 'changed' end as _change
from b left join a on a.unique_identifier = b.unique_identifier where a.unique_identifier is null or a is distinct from b
union all select a.*, 'removed' from a where not exists (select 1 from b where b.unique_identifier = a.unique_identifier)""")
def q_golden_changes(spark, sf_dir):
    """Rows inserted, changed and removed between two golden tables."""
    return snapshot.changes(*_two_golden(spark, sf_dir), [golden.KEY])


@register("golden_changes_applied", _golden_at("person_id % 10 <> 9"))
def q_golden_changes_applied(spark, sf_dir):
    """The first golden table after its changes is the second one."""
    old, new = _two_golden(spark, sf_dir)
    return snapshot.apply_changes(old, snapshot.changes(old, new, [golden.KEY]), [golden.KEY])
