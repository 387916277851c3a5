"""Declarative quality rules: report (warn), drop, quarantine, observe.

A rule is a SQL boolean expression. A rule that evaluates to NULL counts as
failed. ``keep_valid`` filters on the bare conjunction, which drops NULL
results as well and stays a pushable predicate; the reports and the
quarantine use ``coalesce(rule, false)`` because they must see the failures.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Rules = Mapping[str, str]


def with_key_rules(rules: Rules, primary_key_columns: Sequence[str]) -> dict[str, str]:
    """Q4: add ``valid_<pk>: <pk> IS NOT NULL`` per key column (overrides a same-named rule)."""
    out = dict(rules)
    for pk in primary_key_columns:
        out[f"valid_{pk}"] = f"{pk} IS NOT NULL"
    return out


def _passes(rule: str) -> Column:
    return F.coalesce(F.expr(rule), F.lit(False))


def typed_for_rules(df: DataFrame, casts: Mapping[str, str] | None = None) -> DataFrame:
    """Give rule inputs their types with try_cast (ANSI-safe): a malformed
    value becomes NULL and then fails its rule instead of aborting the job."""
    casts = {"age": "int"} if casts is None else casts
    exprs = {c: F.col(c).try_cast(t) for c, t in casts.items() if c in df.columns}
    if not exprs:
        return df
    return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


def report(df: DataFrame, rules: Rules) -> DataFrame:
    """Q1/Q2: one pass, one row per rule: (rule, passed, failed)."""
    if not rules:
        raise ValueError("no rules")
    aggs = []
    for i, (name, rule) in enumerate(rules.items()):
        aggs.append(F.count_if(_passes(rule)).alias(f"p{i}"))
    totals = df.agg(F.count(F.lit(1)).alias("n"), *aggs)
    rows = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(f"p{i}").alias("passed"), (F.col("n") - F.col(f"p{i}")).alias("failed"))
        for i, name in enumerate(rules)
    ])
    return totals.select(F.inline(rows))


def all_pass(rules: Rules) -> Column:
    """Bare conjunction of the rules (NULL -> row is not kept by a filter)."""
    conds = [F.expr(f"({r})") for r in rules.values()]
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def keep_valid(df: DataFrame, rules: Rules) -> DataFrame:
    """Q3 drop mode: rows that pass every rule."""
    return df.filter(all_pass(rules)) if rules else df


def failed_rules(rules: Rules) -> Column:
    """Names of the rules a row fails, as an array (empty when it passes)."""
    return F.array_compact(F.array(*[F.when(~_passes(r), F.lit(n)) for n, r in rules.items()]))


def quarantine(df: DataFrame, rules: Rules, out: str = "_failed_rules") -> DataFrame:
    """Q5: rejected rows with the list of rules they failed."""
    return df.withColumn(out, failed_rules(rules)).filter(F.size(F.col(out)) > 0)


def split(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """Valid rows and quarantined rows from one rule set."""
    return keep_valid(df, rules), quarantine(df, rules)


def observe_rules(df: DataFrame, rules: Rules, name: str = "quality") -> tuple[DataFrame, Observation]:
    """ST6 / warn mode on any plan, batch or stream: metrics ride along with
    the query that consumes ``df`` (no extra pass). Read them from the
    returned Observation after an action (batch), or from a
    StreamingQueryListener's ``observedMetrics`` (stream)."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(~_passes(r)).alias(f"failed_{n}") for n, r in rules.items()]
    return df.observe(obs, *metrics), obs


def observe_rules_named(df: DataFrame, rules: Rules, name: str = "quality") -> DataFrame:
    """Same metrics under a string name, as a streaming query needs."""
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(~_passes(r)).alias(f"failed_{n}") for n, r in rules.items()]
    return df.observe(name, *metrics)
