"""The dirty person feed over the driver tables, and table loading.

``persons`` builds a bronze-shaped person feed (person_id, name, email, phone,
age as text, source_file_path) from ``events`` joined to ``customer``: mixed
case, padding, NULL emails and phones, malformed ages and four source paths.
It is the input of the identity pipeline in the query catalogue.
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


_TABLES: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, resolved once per session (file listing and parquet
    footers are read on the first use; the input tables are immutable)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    cache = _TABLES.setdefault(spark, {})
    if path not in cache:
        cache[path] = spark.read.parquet(path)
    return cache[path]


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Person feed: one row per event, attributes from the event's customer.

    The join is a plain equi-join; Catalyst/AQE choose broadcast or
    sort-merge from the measured customer size, so nothing here assumes the
    dimension is small.
    """
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    j = e.join(c, e.user_id == c.c_custkey, "inner")
    eid = F.col("event_id")
    handle = F.replace(F.col("c_name"), F.lit("#"), F.lit("."))
    return j.select(
        eid.alias("person_id"),
        F.when(eid % 7 == 0, F.upper("c_mktsegment"))
        .otherwise(F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" "),
                            F.col("c_nationkey").cast("string"), F.lit(" ")))
        .alias("name"),
        F.when(eid % 5 == 0, F.lit(None).cast("string"))
        .when(eid % 3 == 0, F.concat(F.lit("  "), F.upper(handle), F.lit("@EXAMPLE.COM ")))
        .otherwise(F.concat(F.lower(handle), F.lit("@example.com")))
        .alias("email"),
        F.when(eid % 10 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("+1-555-"), F.lpad(F.col("user_id").cast("string"), 4, "0")))
        .alias("phone"),
        F.when(eid % 11 == 0, F.lit("n/a"))
        .otherwise(F.floor("value").cast("int").cast("string"))
        .alias("age"),
        F.when(F.col("event_type") == "error", F.lit("/in/SAP/u.csv"))
        .when(F.col("event_type") == "click", F.lit("/in/salesforce/u.csv"))
        .when(F.col("event_type") == "view", F.lit("/in/oddo/u.csv"))
        .otherwise(F.lit("/in/other/u.csv"))
        .alias("source_file_path"),
    )


# The same projection for DuckDB (oracle side).
PERSONS_SQL = """
select e.event_id as person_id,
  case when e.event_id % 7 = 0 then upper(c.c_mktsegment)
       else concat('  ', lower(c.c_mktsegment), ' ', cast(c.c_nationkey as varchar), ' ') end as name,
  case when e.event_id % 5 = 0 then null
       when e.event_id % 3 = 0 then concat('  ', upper(replace(c.c_name,'#','.')), '@EXAMPLE.COM ')
       else concat(lower(replace(c.c_name,'#','.')), '@example.com') end as email,
  case when e.event_id % 10 = 0 then null
       else concat('+1-555-', lpad(cast(e.user_id as varchar), 4, '0')) end as phone,
  case when e.event_id % 11 = 0 then 'n/a'
       else cast(cast(floor(e.value) as int) as varchar) end as age,
  case e.event_type when 'error' then '/in/SAP/u.csv' when 'click' then '/in/salesforce/u.csv'
       when 'view' then '/in/oddo/u.csv' else '/in/other/u.csv' end as source_file_path
from events e join customer c on e.user_id = c.c_custkey
"""
