"""Value distributions: frequent values of every column, quantiles."""

from __future__ import annotations

from goldenrec.operators import distribution
from goldenrec.plans.catalog import CTE_PERSONS
from goldenrec.plans.catalog_profile import EVENT_COLS, PERSON_COLS
from goldenrec.plans.persons import persons, table
from goldenrec.plans.registry import register, with_ctes


def _frequent_sql(source: str, cols, share: float) -> str:
    return "\nunion all\n".join(
        f"select '{c}' as column_name, {c}::varchar as value, count(*)::bigint as rows, (select count(*) from {source})::bigint as total_rows"
        f" from {source} where {c} is not null group by {c}::varchar having count(*) >= {share} * (select count(*) from {source})" for c in cols)


@register("frequent_values_persons", with_ctes(CTE_PERSONS, body=_frequent_sql("persons", PERSON_COLS, 0.01)))
def q_frequent_values_persons(spark, sf_dir):
    """PR1: values that hold at least 1 % of the person feed, in any column."""
    return distribution.frequent_values(persons(spark, sf_dir).select(*PERSON_COLS))


TEXT_EVENT_COLS = tuple(c for c in EVENT_COLS if c not in ("ts", "value"))


@register("frequent_values_events", _frequent_sql("events", TEXT_EVENT_COLS, 0.001))
def q_frequent_values_events(spark, sf_dir):
    """PR1 over the events with a share of a thousandth (times and measured
    values, whose text forms differ between engines, left out)."""
    return distribution.frequent_values(table(spark, sf_dir, "events").select(*TEXT_EVENT_COLS), share=0.001)


@register("lineitem_quantiles")
def q_lineitem_quantiles(spark, sf_dir):
    """PR1: quantiles of the measures of lineitem, from sketches; no SQL, as a
    sketch need not give the exact quantile (the tests count its rank)."""
    return distribution.column_quantiles(table(spark, sf_dir, "lineitem"), ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
