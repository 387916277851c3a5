"""Identity-pipeline queries (bronze -> silver -> gold over the person feed)
and their DuckDB oracles. Queries read the driver tables whole; no query
filters ids, samples or caps rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from goldenrec import settings
from goldenrec.operators import golden
from goldenrec.plans import layers as ip
from goldenrec.plans.persons import PERSONS_SQL, persons
from goldenrec.plans.registry import initcap_sql, register, with_ctes

# --- shared oracle fragments (DuckDB) ----------------------------------------

SOURCE_SYSTEM_SQL = """case when contains(source_file_path, 'SAP') then 'SAP'
       when contains(source_file_path, 'salesforce') then 'Salesforce'
       when contains(source_file_path, 'healthcare') then 'Healthcare'
       when contains(source_file_path, 'oddo') then 'Odoo'
       when contains(source_file_path, 'zoho') then 'Zoho' else 'Unknown' end"""

CTE_PERSONS = f"persons as ({PERSONS_SQL})"
CTE_SILVER = f"""silver as (
  select person_id,
         {initcap_sql('trim(name)')} as name,
         lower(trim(email)) as email,
         regexp_replace(phone, '[^0-9+]', '', 'g') as phone,
         try_cast(age as integer) as age,
         {SOURCE_SYSTEM_SQL} as source_system
  from persons)"""
CTE_IDENTIFIED = """identified as (
  select *, coalesce(email, phone, concat_ws('_', name, cast(age as varchar))) as unique_identifier from silver)"""
CTE_IDENTIFIED_BLANK = """identified as (
  select *, coalesce(nullif(trim(email), ''), nullif(trim(phone), ''),
                     concat_ws('_', nullif(trim(name), ''), nullif(trim(cast(age as varchar)), ''))) as unique_identifier
  from silver)"""
CTE_COUNTS = """counts as (select unique_identifier, count(*) as repetition from identified group by unique_identifier)"""
CTE_SCORED = """scored as (
  select i.person_id, i.name, i.email, i.phone, i.age, i.source_system, i.unique_identifier,
         case when c.repetition > 2 then 'High' when c.repetition = 2 then 'Moderate' else 'Low' end as confidence,
         c.repetition
  from counts c join identified i on c.unique_identifier = i.unique_identifier)"""
CTE_RANKED = """ranked as (
  select *, case confidence when 'High' then 3 when 'Moderate' then 2 when 'Low' then 1 end as confidence_rank
  from scored)"""
SCORED_COLS = "person_id, name, email, phone, age, source_system, unique_identifier, confidence"
PIPELINE_CTES = (CTE_PERSONS, CTE_SILVER, CTE_IDENTIFIED, CTE_COUNTS, CTE_SCORED, CTE_RANKED)


def _golden_sql(partition: str) -> str:
    return with_ctes(*PIPELINE_CTES, body=f"""
select {SCORED_COLS}, confidence_rank, row_num from (
  select *, cast(row_number() over (partition by {partition}
                               order by confidence_rank desc, age desc nulls last, person_id asc) as integer) as row_num
  from ranked) where row_num = 1""")


# --- identity pipeline ------------------------------------------------------

def _result(spark, sf_dir: str, **kw) -> ip.GoldResult:
    return ip.identity_layers(persons(spark, sf_dir), ip.PipelineParams(**kw))


@register("silver_clean", with_ctes(CTE_PERSONS, CTE_SILVER, body="select * from silver"))
def q_silver_clean(spark, sf_dir):
    return _result(spark, sf_dir).silver


@register("silver_identified", with_ctes(CTE_PERSONS, CTE_SILVER, CTE_IDENTIFIED, body="select * from identified"))
def q_silver_identified(spark, sf_dir):
    return _result(spark, sf_dir).identified


@register("silver_identified_blank_null", with_ctes(
    CTE_PERSONS.replace("persons as (", "persons_raw as ("),
    """persons as (select * replace (case when person_id % 13 = 0 then '   ' else email end as email,
                                 case when person_id % 17 = 0 or person_id % 26 = 0 then 'n/a' else phone end as phone,
                                 case when person_id % 442 = 0 then ' ' else name end as name) from persons_raw)""",
    CTE_SILVER, CTE_IDENTIFIED_BLANK, body="select * from identified"))
def q_silver_identified_blank_null(spark, sf_dir):
    """K2: blank emails, phones without a digit and blank names are missing, so
    the next choice of the priority gives the key."""
    pid = F.col("person_id")
    feed = persons(spark, sf_dir).withColumns({
        "email": F.when(pid % 13 == 0, F.lit("   ")).otherwise(F.col("email")),
        "phone": F.when((pid % 17 == 0) | (pid % 26 == 0), F.lit("n/a")).otherwise(F.col("phone")),
        "name": F.when(pid % 442 == 0, F.lit(" ")).otherwise(F.col("name"))})
    return ip.identity_layers(feed, ip.PipelineParams(blank_as_null=True)).identified


@register("duplicate_count", with_ctes(CTE_PERSONS, CTE_SILVER, CTE_IDENTIFIED, CTE_COUNTS, body="select * from counts"))
def q_duplicate_count(spark, sf_dir):
    return _result(spark, sf_dir).counts


@register("confidence_scored", with_ctes(*PIPELINE_CTES, body=f"select {SCORED_COLS} from scored"))
def q_confidence_scored(spark, sf_dir):
    return _result(spark, sf_dir).scored


@register("confidence_distribution",
          with_ctes(*PIPELINE_CTES, body="select confidence, count(*) as rows from scored group by confidence"))
def q_confidence_distribution(spark, sf_dir):
    return golden.confidence_distribution(_result(spark, sf_dir).scored)


@register("golden_by_name", _golden_sql("name"))
def q_golden_by_name(spark, sf_dir):
    return _result(spark, sf_dir).golden


@register("golden_by_identifier", _golden_sql("unique_identifier"))
def q_golden_by_identifier(spark, sf_dir):
    return _result(spark, sf_dir, partition_by=("unique_identifier",)).golden


@register("golden_survivorship", with_ctes(*PIPELINE_CTES, body="""
select unique_identifier, """ + ",\n  ".join(
    f"first({c} order by confidence_rank desc, age desc nulls last, person_id asc) filter (where {c} is not null) as {c}"
    for c in ("person_id", "name", "email", "phone", "age", "source_system", "confidence", "confidence_rank")) + """
from ranked group by unique_identifier"""))
def q_golden_survivorship(spark, sf_dir):
    return _result(spark, sf_dir, partition_by=("unique_identifier",), survivorship="attribute").golden


@register("golden_by_completeness", with_ctes(*PIPELINE_CTES, body=f"""
select {SCORED_COLS}, confidence_rank, completeness, row_num from (
  select *, cast(row_number() over (partition by unique_identifier
      order by confidence_rank desc, completeness desc, age desc nulls last, person_id asc) as integer) as row_num
  from (select *, cast(name is not null as integer) + cast(email is not null as integer)
                  + cast(phone is not null as integer) + cast(age is not null as integer) as completeness
        from ranked)) where row_num = 1"""))
def q_golden_by_completeness(spark, sf_dir):
    """One aggregate per identifier (confidence is constant in a group)."""
    res = _result(spark, sf_dir)
    best = golden.golden_by_completeness_key(res.identified)
    return best.select(*res.scored.columns, "confidence_rank", "completeness", "row_num")


@register("dedup_ratio", with_ctes(*PIPELINE_CTES, body="""
select original_count, golden_count,
       case when original_count > 0 then round((original_count - golden_count) / original_count * 100.0, 2)
            else 0.0 end as removed_pct
from (select count(*) as original_count,
             count(distinct unique_identifier) + coalesce(max(case when unique_identifier is null then 1 else 0 end), 0) as golden_count
      from scored)"""))
def q_dedup_ratio(spark, sf_dir):
    """A6 from the identifier counts (golden = one record per identifier)."""
    return golden.dedup_ratio_from_counts(_result(spark, sf_dir).counts)


@register("duplicate_rows", with_ctes(*PIPELINE_CTES, body="""
select count(*) filter (where repetition > 1) as duplicate_rows, count(*) as total_rows from scored"""))
def q_duplicate_rows(spark, sf_dir):
    """A7 from the identifier counts (no join back to the records)."""
    return golden.duplicate_rows_from_counts(_result(spark, sf_dir).counts)


@register("identifier_coverage", with_ctes(CTE_PERSONS, CTE_SILVER, CTE_IDENTIFIED, body="""
select count(unique_identifier) as with_identifier, count(*) as total_rows from identified"""))
def q_identifier_coverage(spark, sf_dir):
    return golden.identifier_coverage(_result(spark, sf_dir).identified)


@register("left_scored_keeps_null_key", with_ctes(CTE_PERSONS, CTE_SILVER, """identified as (
  select *, email as unique_identifier from silver)""", CTE_COUNTS, body=f"""
select i.person_id, i.name, i.email, i.phone, i.age, i.source_system, i.unique_identifier,
       case when c.repetition > 2 then 'High' when c.repetition = 2 then 'Moderate' else 'Low' end as confidence,
       c.repetition
from identified i left join counts c on i.unique_identifier = c.unique_identifier"""))
def q_left_scored_keeps_null_key(spark, sf_dir):
    silver = _result(spark, sf_dir).silver
    identified = silver.withColumn("unique_identifier", F.col("email"))
    return golden.score(identified, how="left", keep_repetition=True, hot_keys=settings.HOT_KEY_MAX_KEYS)


@register("near_duplicate_names", with_ctes(
    CTE_PERSONS, CTE_SILVER,
    "n as (select name as value, count(*)::bigint as records from silver where name is not null group by name)",
    "e as (select a.value as a, b.value as b from n a join n b on levenshtein(a.value, b.value) <= 1)",
    "reach(value, other) as (select value, value from n union select e.a, reach.other from reach join e on e.b = reach.value)",
    body="select value, any_value(records) as records, min(other) as cluster from reach join n using (value) group by value",
).replace("with ", "with recursive ", 1))
def q_near_duplicate_names(spark, sf_dir):
    """Clusters of person names within edit distance 1 of each other
    (single linkage; exact; the oracle compares all pairs)."""
    from goldenrec.operators import neardup

    return neardup.near_duplicate_clusters(_result(spark, sf_dir).silver, "name")


@register("golden_by_name_drop_mode", with_ctes(
    CTE_PERSONS.replace("persons as (", "persons_raw as ("),
    """persons as (select * from persons_raw where person_id is not null and try_cast(age as integer) > 0)""",
    *PIPELINE_CTES[1:], body=f"""
select {SCORED_COLS}, confidence_rank, row_num from (
  select *, cast(row_number() over (partition by name
                               order by confidence_rank desc, age desc nulls last, person_id asc) as integer) as row_num
  from ranked) where row_num = 1"""))
def q_golden_by_name_drop_mode(spark, sf_dir):
    """Q3 before the layers: bronze rules (person_id not null, age > 0) drop
    failing rows, then clean -> identify -> count -> score -> golden by name."""
    return _result(spark, sf_dir, rule_mode="drop").golden


@register("golden_survivorship_by_name", with_ctes(*PIPELINE_CTES, body="""
select name, """ + ",\n  ".join(
    f"first({c} order by confidence_rank desc, age desc nulls last, person_id asc) filter (where {c} is not null) as {c}"
    for c in ("person_id", "email", "phone", "age", "source_system", "unique_identifier", "confidence",
              "confidence_rank")) + """
from ranked group by name"""))
def q_golden_survivorship_by_name(spark, sf_dir):
    """G5 on the layer's partition (name): per name, each attribute's first
    non-NULL value by confidence, age, person_id (a grouped min_by aggregate
    over the scored records)."""
    return _result(spark, sf_dir, survivorship="attribute").golden
