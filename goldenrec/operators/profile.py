"""Schema profiling (PR1-PR8) as aggregations.

Type inference runs as one aggregation job over the data (not a driver-side
loop over collected rows): per column it counts, with built-in regex
predicates, how many non-blank values look like each type. Only one small row
per column reaches the driver, and only when a caller needs the inferred
types as a Python schema (``infer_schema`` / ``apply_inferred_schema``).
Wide tables are profiled ``settings.PROFILE_COLUMNS_PER_PASS`` columns per
aggregate so generated code stays under the JVM method-size limit.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampType)

from goldenrec import settings
from goldenrec.operators.golden import distinct_with_null

SPARK_TYPES: dict[str, DataType] = {
    "integer": IntegerType(),
    "long": LongType(),
    "double": DoubleType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp": TimestampType(),
    "string": StringType(),
}
_TYPE_ORDER = ("integer", "double", "boolean", "date", "timestamp")


WHITESPACE = " \t\n\r\f\u000b"


def stripped(c: Column) -> Column:
    """The value as text without surrounding (ASCII) whitespace."""
    return F.trim(c.cast("string"), F.lit(WHITESPACE))


def value_kind(c: Column) -> Column:
    """Type class of one value; first pattern in settings.TYPE_PATTERNS wins.

    NULL for missing or blank values. An integer outside the 32-bit range
    counts as double.
    """
    v = stripped(c)
    return kind_of_text(v)


def kind_of_text(v: Column, widen: bool = False) -> Column:
    """``value_kind`` on text that is already stripped.

    An integer outside the 32-bit range is a double, or with ``widen`` a long
    (a double only beyond 64 bits)."""
    pats = dict(settings.TYPE_PATTERNS)
    big = F.lit("double")
    if widen:
        big = F.when(v.try_cast("bigint").isNotNull(), F.lit("long")).otherwise(F.lit("double"))
    return (
        F.when(v.isNull() | (v == ""), F.lit(None).cast("string"))
        .when(v.rlike(pats["timestamp"]), F.lit("timestamp"))
        .when(v.rlike(pats["date"]), F.lit("date"))
        .when(v.rlike(pats["boolean"]), F.lit("boolean"))
        .when(v.rlike(pats["integer"]), F.when(v.try_cast("int").isNotNull(), F.lit("integer")).otherwise(big))
        .when(v.rlike(pats["double"]), F.lit("double"))
        .otherwise(F.lit("string"))
    )


def _chunks(cols: Sequence[str], size: int) -> list[list[str]]:
    return [list(cols[i:i + size]) for i in range(0, len(cols), size)]


def _profile_pass(df: DataFrame, cols: Sequence[str], semantic: bool, widen: bool = False) -> DataFrame:
    # One projection computes each value's text form and type class once per
    # row; the aggregate then only counts (no regex is evaluated twice).
    pre = []
    for i, c in enumerate(cols):
        pre += [F.col(c).isNotNull().alias(f"nn{i}"), stripped(F.col(c)).alias(f"v{i}")]
    texts = df.select(*pre)
    typed = texts.select("*", *[kind_of_text(F.col(f"v{i}"), widen).alias(f"k{i}") for i in range(len(cols))])
    kinds = _TYPE_ORDER + (("long",) if widen else ())
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, _ in enumerate(cols):
        kind, v = F.col(f"k{i}"), F.col(f"v{i}")
        aggs.append(F.count_if(F.col(f"nn{i}")).alias(f"nn{i}"))
        aggs.append(F.count(kind).alias(f"valid{i}"))
        for t in kinds:
            aggs.append(F.count_if(kind == t).alias(f"{t}{i}"))
        aggs.append(F.min(F.when(kind.isNotNull(), v)).alias(f"min{i}"))
        aggs.append(F.max(F.when(kind.isNotNull(), v)).alias(f"max{i}"))
        aggs.append(F.max(F.when(kind.isNotNull(), F.struct(F.length(v).alias("n"), v.alias("v")))).alias(f"long{i}v"))
        if semantic:
            for sname, pat in settings.SEMANTIC_PATTERNS:
                aggs.append(F.count_if(kind.isNotNull() & v.rlike(pat)).alias(f"{sname}{i}"))
    totals = typed.agg(*aggs)

    def inferred(i: int) -> Column:
        valid = F.col(f"valid{i}")

        def share(*types: str) -> Column:
            total = F.col(f"{types[0]}{i}")
            for t in types[1:]:
                total = total + F.col(f"{t}{i}")
            return (valid > 0) & (total / valid >= settings.TYPE_THRESHOLD)

        expr = F.lit("string")
        for t in reversed(_TYPE_ORDER):
            expr = F.when(share(t), F.lit(t)).otherwise(expr)
        if widen:
            # whole numbers (int and long) together, then all numbers together
            expr = (F.when(share("integer", "long"),
                           F.when(F.col(f"long{i}") > 0, F.lit("long")).otherwise(F.lit("integer")))
                    .when(share("integer", "long", "double"), F.lit("double"))
                    .otherwise(expr))
        return expr

    rows = []
    for i, c in enumerate(cols):
        fields = [
            F.lit(i).alias("position"),
            F.lit(c).alias("column_name"),
            inferred(i).alias("inferred_type"),
            F.when(F.col("n") > 0, F.round((F.col("n") - F.col(f"nn{i}")) / F.col("n") * 100.0, 4))
            .otherwise(F.lit(0.0)).alias("null_percentage"),
            F.col(f"valid{i}").alias("non_blank"),
            F.col(f"min{i}").alias("min_value"),
            F.col(f"max{i}").alias("max_value"),
            F.col(f"long{i}v")["v"].alias("longest_value"),
        ]
        if semantic:
            fields += [F.col(f"{s}{i}").alias(f"{s}_matches") for s, _ in settings.SEMANTIC_PATTERNS]
        rows.append(F.struct(*fields))
    return totals.select(F.inline(F.array(*rows)))


def type_profile(df: DataFrame, columns: Sequence[str] | None = None, semantic: bool = False,
                 sample_fraction: float | None = None, seed: int = 7, widen: bool = False) -> DataFrame:
    """PR1/PR7/PR8: one row per column.

    Columns: position, column_name, inferred_type, null_percentage,
    non_blank, min_value, max_value, longest_value (three sample values; of
    equally long ones the greatest), and with ``semantic=True`` email/phone/currency match counts.

    ``widen=True`` relaxes the single-type rule: integers and longs count
    together (long if any value needs 64 bits), and integers, longs and
    doubles together make a double column; without it a 60 % int / 40 %
    double column is a string, as in the surveyed rules.

    All rows are profiled by default (a single scan); ``sample_fraction``
    profiles a seeded Bernoulli sample instead, never a ``limit`` (which is
    not reproducible on Spark).
    """
    cols = list(columns or df.columns)
    src = df.select(*cols)
    if sample_fraction is not None:
        src = src.sample(fraction=sample_fraction, seed=seed)
    parts = []
    for k, chunk in enumerate(_chunks(cols, settings.PROFILE_COLUMNS_PER_PASS)):
        p = _profile_pass(src, chunk, semantic, widen)
        parts.append(p.withColumn("position", F.col("position") + k * settings.PROFILE_COLUMNS_PER_PASS))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def profile_csv(spark, path: str, delimiter: str = ",", header: bool = True, semantic: bool = False,
                sample_fraction: float | None = None, widen: bool = False) -> DataFrame:
    """PR3: read a CSV with every column as text (no inference pass), then
    profile it (PR1)."""
    raw = (spark.read.option("header", str(header).lower()).option("sep", delimiter)
           .option("inferSchema", "false").csv(path))
    return type_profile(raw, semantic=semantic, sample_fraction=sample_fraction, widen=widen)


def infer_schema(df: DataFrame, columns: Sequence[str] | None = None,
                 sample_fraction: float | None = None, widen: bool = False) -> StructType:
    """PR1 as a StructType (collects one row per column)."""
    rows = type_profile(df, columns, sample_fraction=sample_fraction, widen=widen).orderBy("position").collect()
    return StructType([StructField(r["column_name"], SPARK_TYPES[r["inferred_type"]], True) for r in rows])


def cast_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """PR2/C16: try_cast each column to its type; values that do not fit
    (up to 20 % by the threshold) become NULL instead of failing the job."""
    types = {f.name: f.dataType for f in schema.fields}

    def conv(c: str) -> Column:
        if c not in types:
            return F.col(c)
        t = types[c]
        if isinstance(t, StringType):
            return F.col(c).cast("string")
        return stripped(F.col(c)).try_cast(t)

    return df.select(*[conv(c).alias(c) for c in df.columns])


def apply_inferred_schema(df: DataFrame, sample_fraction: float | None = None, widen: bool = False) -> DataFrame:
    return cast_to_schema(df, infer_schema(df, sample_fraction=sample_fraction, widen=widen))


# --- name-based classification (PR4-PR6) -------------------------------------

def column_category(name: str) -> str:
    """PR4: substring tests on the lower-cased name, in precedence order."""
    low = name.lower()
    for cat, words in settings.COLUMN_CATEGORIES:
        if any(w in low for w in words):
            return cat
    return settings.GENERAL_CATEGORY


def column_categories(columns: Sequence[str]) -> dict[str, str]:
    return {c: column_category(c) for c in columns}


#: Column classes that can tell records apart, best first.
DEDUP_CLASSES = ("contact", "identifier", "descriptive")


def suggest_dedup_columns(columns: Sequence[str], limit: int = settings.MAX_DEDUP_SUGGESTIONS) -> list[str]:
    """PR6: the columns that can tell records apart, by class, e-mail columns
    first in theirs, else in table order; descriptive ones only if their name
    says ``name``. The first ``limit`` of them."""
    def place(column: str) -> tuple[int, bool]:
        return DEDUP_CLASSES.index(column_category(column)), "email" not in column.lower()

    usable = (c for c in columns if column_category(c) in DEDUP_CLASSES and (column_category(c) != "descriptive" or "name" in c.lower()))
    return sorted(usable, key=place)[:limit]


def cardinality_report(df: DataFrame, columns: Sequence[str] | None = None, table: str | None = None) -> DataFrame:
    """Per column: category, rows, distinct values (NULL as a value), unique flag.

    A pass over its own column for each: several distinct counts in one
    aggregate would write every row once for each of them. The passes read no
    more columns than one scan would; their one-row results are stacked.
    """
    cols = list(columns or df.columns)
    one = F.count(F.lit(1))
    passes = [df.agg(one.alias("n")), *(df.select(c).distinct().agg(one.alias(f"d{i}")) for i, c in enumerate(cols))]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), passes)
    totals = stacked.agg(*(F.max(c).alias(c) for c in stacked.columns))
    rows = F.array(*[
        F.struct(
            F.lit(table).cast("string").alias("table_name"),
            F.lit(i).alias("position"),
            F.lit(c).alias("column_name"),
            F.lit(column_category(c)).alias("category"),
            F.col("n").alias("rows"),
            F.col(f"d{i}").alias("distinct_values"),
            (F.col(f"d{i}") == F.col("n")).alias("is_unique"),
        )
        for i, c in enumerate(cols)
    ])
    return totals.select(F.inline(rows))


def category_report(df: DataFrame, table: str | None = None) -> DataFrame:
    """PR4 with data: category of every column, with the rows and non-NULL
    values it holds, from one aggregation pass (plain counts, no shuffle of
    values)."""
    cols = list(df.columns)
    totals = df.select(*cols).agg(F.count(F.lit(1)).alias("n"),
                                  *[F.count(F.col(c)).alias(f"c{i}") for i, c in enumerate(cols)])
    rows = F.array(*[
        F.struct(
            F.lit(table).cast("string").alias("table_name"),
            F.lit(i).alias("position"),
            F.lit(c).alias("column_name"),
            F.lit(column_category(c)).alias("category"),
            F.col("n").alias("rows"),
            F.col(f"c{i}").alias("non_null"),
        )
        for i, c in enumerate(cols)
    ])
    return totals.select(F.inline(rows))


def primary_key_candidates(df: DataFrame, table: str | None = None) -> DataFrame:
    """PR5: identifier columns with uniqueness, and the suggested key.

    The suggestion is the first unique identifier column, else the first
    identifier column; ``suggested`` marks it. One aggregation job for all
    candidates instead of two jobs per column.
    """
    ids = [c for c in df.columns if column_category(c) == "identifier"]
    if not ids:
        raise ValueError("no identifier-like columns")
    rep = cardinality_report(df, ids, table)
    first_unique = F.min(F.when(F.col("is_unique"), F.col("position"))).over(Window.partitionBy("table_name"))
    pick = F.coalesce(first_unique, F.lit(0))
    return rep.withColumn("suggested", F.col("position") == pick)


def dedup_column_report(df: DataFrame, table: str | None = None, limit: int = settings.MAX_DEDUP_SUGGESTIONS) -> DataFrame:
    """PR6 with data: the suggested dedup columns in order, each with its
    distinct-value count (a column that is unique cannot find duplicates)."""
    cols = suggest_dedup_columns(df.columns, limit)
    rep = cardinality_report(df, cols, table)
    return rep.select("table_name", (F.col("position") + 1).alias("dedup_rank"), "column_name", "category",
                      "rows", "distinct_values")
