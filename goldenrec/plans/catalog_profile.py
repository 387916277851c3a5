"""Profiling queries: type inference, null share, semantic patterns, applied
schema, column categories with cardinality, key and dedup-column suggestions."""

from __future__ import annotations

from functools import reduce

from goldenrec import settings
from goldenrec.operators import profile
from goldenrec.plans.catalog import CTE_PERSONS
from goldenrec.plans.persons import persons, table
from goldenrec.plans.registry import register, with_ctes

PERSON_COLS = ("person_id", "name", "email", "phone", "age", "source_file_path")
EVENT_COLS = ("event_id", "ts", "user_id", "event_type", "value", "props")


def _v(c: str) -> str:
    return f"trim(cast({c} as varchar), ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))"


def _kind_sql(v: str) -> str:
    p = dict(settings.TYPE_PATTERNS)
    return f"""case when {v} is null or {v} = '' then null
  when regexp_matches({v}, '{p['timestamp']}') then 'timestamp'
  when regexp_matches({v}, '{p['date']}') then 'date'
  when regexp_matches({v}, '{p['boolean']}') then 'boolean'
  when regexp_matches({v}, '{p['integer']}') then
       case when try_cast({v} as integer) is not null then 'integer' else 'double' end
  when regexp_matches({v}, '{p['double']}') then 'double'
  else 'string' end"""


def profile_sql(source: str, cols, semantic: bool = False) -> str:
    """DuckDB twin of ``profile.type_profile``: one scan, one row per column."""
    inner = ", ".join(f"{_v(c)} as v{i}, {_kind_sql(_v(c))} as k{i}, {c} as c{i}" for i, c in enumerate(cols))
    aggs = ["count(*) as n"]
    for i, _ in enumerate(cols):
        aggs += [f"count(c{i}) as nn{i}", f"count(k{i}) as valid{i}"]
        aggs += [f"count(*) filter (where k{i} = '{t}') as {t}{i}"
                 for t in ("integer", "double", "boolean", "date", "timestamp")]
        aggs += [f"min(case when k{i} is not null then v{i} end) as min{i}",
                 f"max(case when k{i} is not null then v{i} end) as max{i}",
                 f"max(case when k{i} is not null then printf('%09d', length(v{i})) || v{i} end)[10:] as longest{i}"]
        if semantic:
            aggs += [f"count(*) filter (where k{i} is not null and regexp_matches(v{i}, '{pat}')) as {s}{i}"
                     for s, pat in settings.SEMANTIC_PATTERNS]
    rows = []
    for i, c in enumerate(cols):
        inferred = "case " + " ".join(
            f"when valid{i} > 0 and {t}{i} / valid{i} >= {settings.TYPE_THRESHOLD} then '{t}'"
            for t in ("integer", "double", "boolean", "date", "timestamp")) + " else 'string' end"
        sel = [f"{i} as position", f"'{c}' as column_name", f"{inferred} as inferred_type",
               f"case when n > 0 then round((n - nn{i}) / n * 100.0, 4) else 0.0 end as null_percentage",
               f"valid{i} as non_blank", f"min{i} as min_value", f"max{i} as max_value", f"longest{i} as longest_value"]
        if semantic:
            sel += [f"{s}{i} as {s}_matches" for s, _ in settings.SEMANTIC_PATTERNS]
        rows.append("select " + ", ".join(sel) + " from agg")
    return (f"agg as (select {', '.join(aggs)} from (select {inner} from {source}))", "\nunion all\n".join(rows))


def profile_oracle(base_ctes, source, cols, semantic=False, body_wrap=None):
    cte, body = profile_sql(source, cols, semantic)
    if body_wrap:
        body = body_wrap.format(body=body)
    return with_ctes(*base_ctes, cte, body=body)


@register("type_profile", profile_oracle([CTE_PERSONS], "persons", PERSON_COLS))
def q_type_profile(spark, sf_dir):
    """PR1/PR7: inferred type, null share and three sample values per column."""
    return profile.type_profile(persons(spark, sf_dir))


@register("type_profile_events", profile_oracle([], "events", EVENT_COLS))
def q_type_profile_events(spark, sf_dir):
    """PR1 over the event table (every column read as text)."""
    return profile.type_profile(table(spark, sf_dir, "events"))


@register("semantic_profile", profile_oracle([CTE_PERSONS], "persons", PERSON_COLS, semantic=True))
def q_semantic_profile(spark, sf_dir):
    """PR8: email / phone / currency pattern matches next to the type profile."""
    return profile.type_profile(persons(spark, sf_dir), semantic=True)


@register("null_percentage", profile_oracle(
    [CTE_PERSONS], "persons", PERSON_COLS, body_wrap="select column_name, null_percentage from ({body})"))
def q_null_percentage(spark, sf_dir):
    """PR7 alone."""
    return profile.type_profile(persons(spark, sf_dir)).select("column_name", "null_percentage")


@register("apply_inferred_schema", with_ctes(CTE_PERSONS, body="""
select try_cast(cast(person_id as varchar) as integer) as person_id,
       name, email, phone,
       try_cast(trim(age, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)) as integer) as age,
       source_file_path
from persons"""))
def q_apply_inferred_schema(spark, sf_dir):
    """PR2/C16: detect types in one aggregation, then try_cast every column.

    On the person feed: ids and ages are integer (ages 'n/a' become NULL),
    the phone's leading '+' keeps it a string."""
    return profile.apply_inferred_schema(persons(spark, sf_dir))


PROFILED_TABLES = ("orders", "lineitem", "events", "customer", "part", "supplier")


def _cardinality_sql(t: str, cols, positions=None) -> str:
    aggs = ["count(*) as n"] + [
        f"count(distinct {c}) + max(case when {c} is null then 1 else 0 end) as d{i}" for i, c in enumerate(cols)]
    parts = []
    for i, c in enumerate(cols):
        pos = i if positions is None else positions[i]
        parts.append(
            f"select '{t}' as table_name, {pos} as position, '{c}' as column_name, "
            f"'{CATEGORY[c]}' as category, n as rows, d{i} as distinct_values, d{i} = n as is_unique "
            f"from (select {', '.join(aggs)} from {t})")
    return "\nunion all\n".join(parts)


# Column lists of the driver tables (their parquet schemas; fixed by the data
# contract), used to generate the oracle SQL.
TABLE_COLUMNS = {
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    "lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"),
    "events": EVENT_COLS,
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "part": ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
    "supplier": ("s_suppkey", "s_name", "s_nationkey", "s_acctbal"),
}


# What the rules must say of them, written out for the oracle.
CATEGORY = {c: kind for kind, columns in {
    "identifier": "o_orderkey o_custkey l_orderkey l_partkey l_suppkey l_linenumber event_id user_id c_custkey c_nationkey p_partkey s_suppkey s_nationkey",
    "temporal": "o_orderdate l_shipdate",
    "descriptive": "c_name p_name s_name",
    "metric": "o_totalprice l_quantity l_extendedprice l_discount p_retailprice",
    "general": "",
}.items() for c in columns.split()}
CATEGORY |= {c: "general" for cols in TABLE_COLUMNS.values() for c in cols if c not in CATEGORY}
SUGGESTED = {
    "orders": ("o_orderkey", "o_custkey"),
    "lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"),
    "events": ("event_id", "user_id"),
    "customer": ("c_custkey", "c_nationkey", "c_name"),
    "part": ("p_partkey", "p_name"),
    "supplier": ("s_suppkey", "s_nationkey", "s_name"),
}


def _category_sql(t: str) -> str:
    cols = TABLE_COLUMNS[t]
    aggs = ", ".join(["count(*) as n"] + [f"count({c}) as c{i}" for i, c in enumerate(cols)])
    return "\nunion all\n".join(
        f"select '{t}' as table_name, {i} as position, '{c}' as column_name, "
        f"'{CATEGORY[c]}' as category, n as rows, c{i} as non_null from (select {aggs} from {t})"
        for i, c in enumerate(cols))


@register("column_categories", "\nunion all\n".join(_category_sql(t) for t in PROFILED_TABLES))
def q_column_categories(spark, sf_dir):
    """PR4: category of every column of six tables, with its rows and
    non-NULL values (one counting pass per table)."""
    parts = [profile.category_report(table(spark, sf_dir, t), table=t) for t in PROFILED_TABLES]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _dedup_sql(t: str) -> str:
    cols = SUGGESTED.get(t, ())
    if not cols:
        return ""
    inner = _cardinality_sql(t, cols)
    return (f"select table_name, position + 1 as dedup_rank, column_name, category, rows, distinct_values "
            f"from ({inner})")


@register("dedup_columns", "\nunion all\n".join(s for s in (_dedup_sql(t) for t in PROFILED_TABLES) if s))
def q_dedup_columns(spark, sf_dir):
    """PR6: suggested dedup columns per table, in order, with cardinality."""
    parts = []
    for t in PROFILED_TABLES:
        df = table(spark, sf_dir, t)
        if t in SUGGESTED:
            parts.append(profile.dedup_column_report(df, table=t))
    return reduce(lambda a, b: a.unionByName(b), parts)


PK_TABLES = ("orders", "lineitem", "events")


def _pk_sql(t: str) -> str:
    all_cols = TABLE_COLUMNS[t]
    ids = [c for c in all_cols if CATEGORY[c] == "identifier"]
    inner = _cardinality_sql(t, ids)
    return (f"select *, position = coalesce(min(case when is_unique then position end) "
            f"over (partition by table_name), 0) as suggested from ({inner})")


@register("primary_key_candidates", "\nunion all\n".join(_pk_sql(t) for t in PK_TABLES))
def q_primary_key_candidates(spark, sf_dir):
    """PR5: identifier columns, uniqueness, and the suggested primary key
    (first unique identifier column, else the first identifier column)."""
    parts = [profile.primary_key_candidates(table(spark, sf_dir, t), table=t) for t in PK_TABLES]
    return reduce(lambda a, b: a.unionByName(b), parts)
