"""Duplicate counting, confidence scoring and golden-record selection.

Scale notes (why the plans look the way they do):

* Repetition per identifier is a hash aggregate joined back, not a
  ``count(*) over (partition by id)`` window: the aggregate combines map-side,
  so an identifier that holds a third of all rows costs one partial row per
  map task instead of one task holding all of its rows.
* Only identifiers seen at least twice are joined back (the rest are Low by
  definition). That side is usually far smaller than the records, so AQE can
  turn the join into a broadcast from its measured size; when it stays a
  shuffle join, AQE's skew-join split divides a hot identifier's partition of
  the record side among several tasks (its count side is a single row).
* Top-1 per group uses ``row_number() = 1``, which Catalyst plans as a
  partial ``WindowGroupLimit`` before the exchange: every map task forwards at
  most one candidate per group, so a hot group never reaches a reducer whole.
* Attribute-level survivorship is a grouped ``min_by`` aggregate, again
  combined map-side, instead of an unbounded whole-partition window frame.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, IntegralType, NumericType, StringType, TimestampNTZType, TimestampType

from goldenrec import settings
from goldenrec.functions import normalize as N

KEY = "unique_identifier"


@dataclass(frozen=True)
class OrderKey:
    """One sort key of a golden-record ranking. Missing values sort last."""

    col: str
    descending: bool = True
    nulls_last: bool = True

    def spark(self) -> Column:
        c = F.col(self.col)
        if self.descending:
            return c.desc_nulls_last() if self.nulls_last else c.desc_nulls_first()
        return c.asc_nulls_last() if self.nulls_last else c.asc_nulls_first()


# Layer default: highest confidence, then oldest age, then smallest person_id
# (the last key only makes ties deterministic).
DEFAULT_ORDER: tuple[OrderKey, ...] = (
    OrderKey("confidence_rank"),
    OrderKey("age"),
    OrderKey("person_id", descending=False),
)


def duplicate_count(identified: DataFrame, key: str = KEY) -> DataFrame:
    """A1: rows per identifier (``repetition``)."""
    return identified.groupBy(key).agg(F.count(F.lit(1)).alias("repetition"))


def score(
    identified: DataFrame,
    how: str = "inner",
    key: str = KEY,
    high_above: int = settings.HIGH_ABOVE,
    moderate_at: int = settings.MODERATE_AT,
    columns: Sequence[str] | None = settings.SCORED_COLUMNS,
    keep_repetition: bool = False,
    hot_keys: int | None = settings.HOT_KEY_MAX_KEYS,
) -> DataFrame:
    """J1/J2 + G1: attach repetition to every record and label confidence.

    ``how="inner"`` is the layer join (a NULL identifier finds no count and the
    row is dropped); ``how="left"`` keeps such rows as Low with NULL
    repetition. Non-repeated identifiers are not joined at all: their
    repetition is 1 by construction.

    ``hot_keys=K`` (default ``settings.HOT_KEY_MAX_KEYS``; ``None`` turns it
    off) splits hot identifiers out explicitly: with N records, at
    most K identifiers can have ``repetition >= N / K``, so that set has a
    proven size bound and is broadcast; the records of hot identifiers are
    joined map-side (never shuffled) and all other records take the shuffle
    join, where no identifier holds more than N / K rows. The split is exact:
    every record is in exactly one branch. It costs one scan-only job (N).
    AQE's skew-join split cannot do this here: the count side reaches the join
    through an aggregate, not straight from an exchange, so the skew rule
    does not match the plan (a test pins this).
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    repeated = duplicate_count(identified, key).filter(F.col("repetition") >= 2)
    keyed = identified.filter(F.col(key).isNotNull())
    if hot_keys:
        joined = _split_hot_join(keyed, repeated, key, hot_keys)
    else:
        joined = keyed.join(repeated, on=key, how="left")
    if how == "left":  # rows without a key match nothing; in the join they would all meet in one task
        keyless = identified.filter(F.col(key).isNull()).withColumn("repetition", F.lit(None).cast("long"))
        joined = joined.unionByName(keyless)
    repetition = F.coalesce(F.col("repetition"), F.when(F.col(key).isNotNull(), F.lit(1).cast("long")))
    joined = joined.withColumn("repetition", repetition)
    out = joined.withColumn("confidence", N.confidence("repetition", high_above, moderate_at))
    if columns is not None:
        cols = list(columns) + (["repetition"] if keep_repetition else [])
        out = out.select(*cols)
    elif not keep_repetition:
        out = out.drop("repetition")
    return out


def _split_hot_join(identified: DataFrame, repeated: DataFrame, key: str, hot_keys: int) -> DataFrame:
    total = identified.count()  # N: a scan-only job (partial counts, no shuffle of rows)
    threshold = max(2, -(-total // hot_keys))  # ceil(N / K): at most K identifiers reach it
    hot = repeated.filter(F.col("repetition") >= threshold)
    cold = repeated.filter(F.col("repetition") < threshold)
    hot_side = identified.join(F.broadcast(hot), on=key, how="inner")
    rest = identified.join(F.broadcast(hot.select(key)), on=key, how="left_anti")
    return hot_side.unionByName(rest.join(cold, on=key, how="left"))


def with_rank(scored: DataFrame) -> DataFrame:
    """Numeric confidence rank."""
    return scored.withColumn("confidence_rank", N.confidence_rank("confidence"))


def golden_records(
    scored: DataFrame,
    partition_by: Sequence[str] = ("name",),
    order: Sequence[OrderKey] = DEFAULT_ORDER,
    keep_helpers: bool = True,
) -> DataFrame:
    """The best whole row per group.

    ``partition_by=("name",)`` is the layer behaviour; ``("unique_identifier",)``
    the per-entity twin. ``keep_helpers`` keeps ``confidence_rank`` and
    ``row_num`` as the final table does.
    """
    df = scored if "confidence_rank" in scored.columns else with_rank(scored)
    w = Window.partitionBy(*partition_by).orderBy(*[o.spark() for o in order])
    out = df.withColumn("row_num", F.row_number().over(w)).filter(F.col("row_num") == 1)
    return out if keep_helpers else out.drop("confidence_rank", "row_num")


def _sortable(df: DataFrame, name: str, descending: bool) -> Column:
    """A column that sorts as ``name`` does and, if descending, can be negated.
    Strings have no negative: they are ascending keys only."""
    dt = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dt, BooleanType):
        return c.cast("int")
    if isinstance(dt, DateType):
        return F.unix_date(c)
    if isinstance(dt, (TimestampType, TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(dt, IntegralType):
        return c.cast("decimal(20,0)")  # the smallest integer has no negative of its own width
    if isinstance(dt, NumericType) or (isinstance(dt, StringType) and not descending):
        return c
    raise TypeError(f"order key {name!r} of type {dt} cannot be used {'descending' if descending else 'ascending'} in an aggregate")


def preference_key(df: DataFrame, order: Sequence[OrderKey]) -> Column:
    """A struct whose minimum is the first row under ``order``.

    For each key: a flag that sorts missing values last (or first) and the
    value, negated for descending keys.
    """
    fields = []
    for i, o in enumerate(order):
        v = _sortable(df, o.col, o.descending)
        missing = F.col(o.col).isNull()
        fields.append((missing if o.nulls_last else ~missing).alias(f"p{i}"))
        fields.append((-v if o.descending else v).alias(f"v{i}"))
    return F.struct(*fields)


def survivorship(
    scored: DataFrame,
    partition_by: Sequence[str] = (KEY,),
    order: Sequence[OrderKey] = DEFAULT_ORDER,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Per group, each column takes its first non-NULL value in ``order``.

    The survivor of different columns may come from different rows, as with
    a pandas ``groupby().first()`` after sorting. Implemented as one grouped
    aggregate of ``min_by(col, key)`` where the key is NULL for rows whose
    value is NULL (those rows are skipped).
    """
    df = scored if "confidence_rank" in scored.columns else with_rank(scored)
    pref = preference_key(df, order)
    cols = [c for c in (columns or df.columns) if c not in partition_by]
    aggs = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), pref)).alias(c) for c in cols]
    return df.groupBy(*partition_by).agg(*aggs)


# Order keys that are constant inside one identifier group.
_GROUP_CONSTANT = ("confidence_rank", "confidence", "repetition")


def golden_by_key(
    identified: DataFrame,
    key: str = KEY,
    order: Sequence[OrderKey] = DEFAULT_ORDER,
    how: str = "inner",
    survivorship: str = "row",
    high_above: int = settings.HIGH_ABOVE,
    moderate_at: int = settings.MODERATE_AT,
) -> DataFrame:
    """Golden record per identifier as ONE grouped aggregate.

    Confidence depends only on the group's size, so it is the same for every
    row of an identifier and cannot change which row wins. The count and the
    winner (``min_by`` of the row, or of each column, by the preference key)
    are therefore computed together in one aggregation, partially aggregated
    map-side: a hot identifier costs one partial row per map task and the
    plan has a single exchange, with no join. Output matches
    ``golden_records`` / ``survivorship`` after ``score``.

    Descending order keys must be numeric, boolean, date or timestamp
    (descending strings: use ``score`` + ``golden_records``).
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    data_cols = [c for c in identified.columns if c != key]
    pref = preference_key(identified, [o for o in order if o.col not in _GROUP_CONSTANT])
    if survivorship == "row":
        aggs = [F.min_by(F.struct(*[F.col(c) for c in data_cols]), pref).alias("_best")]
    else:
        aggs = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), pref)).alias(c) for c in data_cols]
    grouped = identified.groupBy(key).agg(F.count(F.lit(1)).alias("repetition"), *aggs)
    if how == "inner":
        grouped = grouped.filter(F.col(key).isNotNull())
    # a NULL identifier is one "group" here but never matches a count in score()
    rep = F.when(F.col(key).isNotNull(), F.col("repetition"))
    label = N.confidence(rep, high_above, moderate_at)
    values = [F.col(f"_best.{c}").alias(c) for c in data_cols] if survivorship == "row" else [F.col(c) for c in data_cols]
    out = grouped.select(*values, F.col(key), label.alias("confidence"))
    out = out.withColumn("confidence_rank", N.confidence_rank("confidence"))
    if survivorship == "row":
        out = out.withColumn("row_num", F.lit(1))
    return out


def golden_by_completeness_key(
    identified: DataFrame,
    attributes: Sequence[str] = ("name", "email", "phone", "age"),
    how: str = "inner",
) -> DataFrame:
    """G8 per identifier as one aggregate (see ``golden_by_key``): most
    non-NULL attributes, then age, then smallest person_id."""
    df = identified.withColumn("completeness", N.non_null_count(list(attributes)))
    order = (OrderKey("completeness"), OrderKey("age"), OrderKey("person_id", descending=False))
    return golden_by_key(df, order=order, how=how)


def golden_by_completeness(
    scored: DataFrame,
    attributes: Sequence[str] = ("name", "email", "phone", "age"),
    partition_by: Sequence[str] = (KEY,),
) -> DataFrame:
    """Highest confidence, then most non-NULL attributes, then age, id."""
    df = scored.withColumn("completeness", N.non_null_count(list(attributes)))
    order = (OrderKey("confidence_rank"), OrderKey("completeness"), OrderKey("age"),
             OrderKey("person_id", descending=False))
    return golden_records(df, partition_by, order)


# --- reports ---------------------------------------------------------------

def confidence_distribution(scored: DataFrame) -> DataFrame:
    """A5: rows per confidence level."""
    return scored.groupBy("confidence").agg(F.count(F.lit(1)).alias("rows"))


def distinct_with_null(col: str) -> Column:
    """A4: distinct values of ``col`` with NULL counted as one value."""
    return F.count_distinct(F.col(col)) + F.coalesce(F.max(F.when(F.col(col).isNull(), 1).otherwise(0)), F.lit(0))


def dedup_ratio(scored: DataFrame, partition_by: str = KEY) -> DataFrame:
    """Records in, golden records out (one per group), share removed.

    The golden count equals the number of distinct group keys (NULL is one
    group), so the report is one aggregate over the records, not a second
    pass over the golden table.
    """
    agg = scored.agg(F.count(F.lit(1)).alias("original_count"), distinct_with_null(partition_by).alias("golden_count"))
    removed = F.when(F.col("original_count") > 0,
                     F.round((F.col("original_count") - F.col("golden_count")) / F.col("original_count") * 100.0, 2))
    return agg.withColumn("removed_pct", removed.otherwise(F.lit(0.0)))


def duplicate_rows_from_counts(counts: DataFrame, key: str = KEY) -> DataFrame:
    """A7 from the per-identifier counts alone (no pass over the records):
    rows of identifiers seen more than once, and all rows."""
    c = counts.filter(F.col(key).isNotNull())
    return c.agg(F.coalesce(F.sum(F.when(F.col("repetition") > 1, F.col("repetition"))), F.lit(0)).alias("duplicate_rows"),
                 F.coalesce(F.sum("repetition"), F.lit(0)).alias("total_rows"))


def dedup_ratio_from_counts(counts: DataFrame, key: str = KEY, how: str = "inner") -> DataFrame:
    """A6 from the per-identifier counts alone: records in = sum of counts,
    golden records out = number of identifier groups."""
    c = counts.filter(F.col(key).isNotNull()) if how == "inner" else counts
    agg = c.agg(F.coalesce(F.sum("repetition"), F.lit(0)).alias("original_count"),
                F.count(F.lit(1)).alias("golden_count"))
    removed = F.when(F.col("original_count") > 0,
                     F.round((F.col("original_count") - F.col("golden_count")) / F.col("original_count") * 100.0, 2))
    return agg.withColumn("removed_pct", removed.otherwise(F.lit(0.0)))


def duplicate_rows(scored_with_repetition: DataFrame) -> DataFrame:
    """Rows whose identifier occurs more than once."""
    return scored_with_repetition.agg(
        F.count_if(F.col("repetition") > 1).alias("duplicate_rows"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def identifier_coverage(identified: DataFrame, key: str = KEY) -> DataFrame:
    """Rows with a non-NULL identifier out of all rows."""
    return identified.agg(F.count(F.col(key)).alias("with_identifier"), F.count(F.lit(1)).alias("total_rows"))
