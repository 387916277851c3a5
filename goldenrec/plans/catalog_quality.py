"""Quality-rule queries (warn report, drop, quarantine, RLIKE/IN rules)."""

from __future__ import annotations

from pyspark.sql import functions as F

from goldenrec.operators import quality
from goldenrec.plans.catalog import CTE_PERSONS
from goldenrec.plans.persons import persons, table
from goldenrec.plans.registry import register, with_ctes


def _report_sql(source: str, rules: dict[str, str]) -> str:
    """One row per rule; a NULL rule result counts as failed."""
    parts = [
        f"select '{name}' as rule, count(*) filter (where coalesce({rule}, false)) as passed, "
        f"count(*) filter (where not coalesce({rule}, false)) as failed from {source}"
        for name, rule in rules.items()
    ]
    return "\nunion all\n".join(parts)


PERSON_RULES = {
    "valid_person_id": "person_id IS NOT NULL",
    "valid_age": "age > 0",
    "valid_email_or_phone": "email IS NOT NULL OR phone IS NOT NULL",
}
CTE_TYPED_PERSONS = """typed as (
  select person_id, name, email, phone, try_cast(age as integer) as age, source_file_path from persons)"""


@register("quality_report", with_ctes(CTE_PERSONS, CTE_TYPED_PERSONS, body=_report_sql("typed", PERSON_RULES)))
def q_quality_report(spark, sf_dir):
    """Q1/Q2: bronze rules on the person feed (age typed with try_cast)."""
    return quality.report(quality.typed_for_rules(persons(spark, sf_dir)), PERSON_RULES)


LINEITEM_RULES = {
    "valid_quantity": "l_quantity > 0",
    "valid_discount": "l_discount BETWEEN 0 AND 0.05",
    "valid_tax": "l_tax <= 0.06",
    "valid_flag": "l_returnflag IN ('A', 'N', 'R')",
    "valid_shipdate": "l_shipdate IS NOT NULL",
}
LINEITEM_RULES_DUCK = dict(LINEITEM_RULES)


@register("quality_report_lineitem", _report_sql("lineitem", LINEITEM_RULES_DUCK))
def q_quality_report_lineitem(spark, sf_dir):
    """Q1/Q2 over the whole fact table: one aggregation pass for all rules."""
    return quality.report(table(spark, sf_dir, "lineitem"), LINEITEM_RULES)


ORDER_RULES = {
    "valid_price": "o_totalprice >= 0",
    "valid_status": "o_orderstatus IN ('F', 'O')",
    "valid_priority": "o_orderpriority RLIKE '^[1-3]-'",
}


@register("quality_drop", """
select * from orders
where o_totalprice >= 0 and o_orderstatus in ('F', 'O') and regexp_matches(o_orderpriority, '^[1-3]-')""")
def q_quality_drop(spark, sf_dir):
    """Q3: rows passing every rule (bare conjunction, pushed into the scan)."""
    return quality.keep_valid(table(spark, sf_dir, "orders"), ORDER_RULES)


@register("quality_quarantine", """
select * from (
  select *, array_to_string(list_filter([
      case when not coalesce(l_quantity > 0, false) then 'valid_quantity' end,
      case when not coalesce(l_discount between 0 and 0.05, false) then 'valid_discount' end,
      case when not coalesce(l_tax <= 0.06, false) then 'valid_tax' end,
      case when not coalesce(l_returnflag in ('A', 'N', 'R'), false) then 'valid_flag' end,
      case when not coalesce(l_shipdate is not null, false) then 'valid_shipdate' end], lambda x: x is not null), ',')
    as failed_rules
  from lineitem) where failed_rules <> ''""")
def q_quality_quarantine(spark, sf_dir):
    """Q5: rejected lineitems with the rules each failed (comma-joined)."""
    q = quality.quarantine(table(spark, sf_dir, "lineitem"), LINEITEM_RULES, out="failed_rules")
    return q.withColumn("failed_rules", F.array_join("failed_rules", ","))


RLIKE_RULES = {
    "valid_email_format": r"email IS NULL OR email RLIKE '^[\\w\\.\\-]+@[\\w\\.\\-]+\\.[a-zA-Z]{2,}$'",
    "valid_source": "source_file_path IN ('/in/SAP/u.csv', '/in/salesforce/u.csv', '/in/oddo/u.csv')",
}
RLIKE_RULES_DUCK = {
    "valid_email_format": r"email IS NULL OR regexp_matches(email, '^[\w\.\-]+@[\w\.\-]+\.[a-zA-Z]{2,}$')",
    "valid_source": "source_file_path IN ('/in/SAP/u.csv', '/in/salesforce/u.csv', '/in/oddo/u.csv')",
}


@register("quality_rlike_in", with_ctes(CTE_PERSONS, body=_report_sql("persons", RLIKE_RULES_DUCK)))
def q_quality_rlike_in(spark, sf_dir):
    """RLIKE and IN rules on the raw (untrimmed, mixed-case) person feed."""
    return quality.report(persons(spark, sf_dir), RLIKE_RULES)
