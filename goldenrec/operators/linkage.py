"""Records linked by any of several keys (K1, K4).

Two records are one identity if they share a value of any key (the same email or
the same phone or ...), directly or over other records: a chain A-email-B-phone-C
is one identity. Records and key values form a bipartite graph; since a record's
own key values are all in one component, it is enough to link each value to the
record's first one, and components are found over key values alone
(``components``, alternating stars). A record costs at most one edge a key, and
equal edges are one, so a value that very many records share stays one node.

``LinkStore`` keeps the components of all records seen so far: a new batch joins
the values it holds to their known roots, and components run over the batch's
edges and those roots only.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldenrec.operators.components import components
from goldenrec.session import materialize


def key_values(df: DataFrame, id_col: str, keys: Mapping[str, Column | str], normalize=F.trim) -> DataFrame:
    """(id, values): each record's key values as ``key:value``, in the order of
    ``keys``; NULL and blank values are no keys."""
    found = []
    for name, key in keys.items():
        value = normalize((F.col(key) if isinstance(key, str) else key).cast("string"))
        found.append(F.when(F.length(value) > 0, F.concat(F.lit(f"{name}:"), value)))
    return df.select(F.col(id_col).alias("id"), F.filter(F.array(*found), lambda v: v.isNotNull()).alias("values"))


def _edges(keyed: DataFrame) -> DataFrame:
    """Distinct links between a record's first key value and its others."""
    some = keyed.filter(F.size("values") > 1)
    return some.select(F.get("values", F.lit(0)).alias("u"), F.explode(F.slice("values", 2, F.size("values"))).alias("v")).filter("u <> v").distinct()


def crowded_keys(keyed: DataFrame, most: int) -> DataFrame:
    """(value, records): key values that more than ``most`` records share, such
    as a placeholder address. They are reported so that a user can look at them;
    links over them hold like any other."""
    counts = keyed.select(F.explode(F.array_distinct("values")).alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("records"))
    return counts.filter(F.col("records") > most)


def link_records(df: DataFrame, id_col: str, keys: Mapping[str, Column | str], normalize=F.trim) -> DataFrame:
    """(id, identity): each record with the least id of all records linked to it.
    A record without any key is an identity of its own.

    Rows that repeat an id with other values link those values too. NULL ids take
    part in linking and keep the identity of their component; one without a
    linked id has NULL. Nothing is dropped or capped.
    """
    keyed = materialize(key_values(df, id_col, keys, normalize), "linkage")
    same_id = keyed.filter(F.col("id").isNotNull() & (F.size("values") > 0)).groupBy("id").agg(
        F.min(F.get("values", F.lit(0))).alias("u"), F.max(F.get("values", F.lit(0))).alias("_most"), F.count(F.lit(1)).alias("n"))
    several = same_id.filter("n > 1 and u <> _most").select("id", "u")
    # an id with several rows: its rows' first values, linked to the least of them
    of_ids = keyed.join(several, "id").select("u", F.get("values", F.lit(0)).alias("v")).filter("u <> v").distinct()
    roots = components(_edges(keyed).unionByName(of_ids))
    return _identities(keyed, roots)


def _identities(keyed: DataFrame, roots: DataFrame) -> DataFrame:
    """Records with the least id of their component, from (node, root)."""
    firsts = keyed.withColumn("node", F.get("values", F.lit(0)))
    with_root = materialize(firsts.join(roots, "node", "left").select("id", F.coalesce("root", "node").alias("root")), "linkage")
    least = materialize(with_root.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("id").alias("identity")), "linkage")
    linked = with_root.filter(F.col("root").isNotNull()).join(least, "root")
    alone = with_root.filter(F.col("root").isNull()).join(linked, "id", "left_anti").withColumn("identity", F.col("id"))
    return linked.select("id", "identity").unionByName(alone.select("id", "identity")).distinct()


@dataclass
class LinkStore:
    """Identities kept between runs: every key value seen with the root of its
    component, and every root with the least record id and the number of its
    records. Each run writes a new version and marks it last, so a run that
    stops halfway leaves the version before it; a replayed run rewrites its own.
    """

    root: str
    id_col: str
    keys: Mapping[str, Column | str]

    def _path(self, run: int, table: str) -> str:
        return f"{self.root}/run={run}/{table}"

    def _marker(self, spark: SparkSession, run: int):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/run={run}/_DONE")
        return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path

    def _done(self, spark: SparkSession, run: int) -> bool:
        fs, path = self._marker(spark, run)
        return fs.exists(path)

    def add(self, batch: DataFrame, run: int) -> None:
        """Links the records of run ``run`` (0, 1, ...) to each other and to all
        records of earlier runs."""
        spark = batch.sparkSession
        if run and not self._done(spark, run - 1):
            raise ValueError(f"run {run} cannot follow: run {run - 1} is not in {self.root}")
        keyed = materialize(key_values(batch, self.id_col, self.keys), "linkage")
        values = keyed.select(F.explode("values").alias("node")).distinct()
        edges, known = _edges(keyed), None
        if run:
            known = spark.read.parquet(self._path(run - 1, "values"))
            touched = known.join(values, "node", "left_semi").select(F.col("node").alias("u"), F.col("root").alias("v"))
            edges = edges.unionByName(touched)
        roots = materialize(components(edges), "linkage")
        new = values.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
        if known is not None:  # a root that came under another one moves its values
            moved = known.join(roots.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").select(
                "node", F.coalesce("to", "root").alias("root"))
            new = moved.unionByName(new.join(known, "node", "left_anti"))
        new.write.mode("overwrite").parquet(self._path(run, "values"))
        now = spark.read.parquet(self._path(run, "values"))
        mine = keyed.filter(F.size("values") > 0).select("id", F.get("values", F.lit(0)).alias("node")).join(now, "node")
        sums = mine.groupBy("root").agg(F.min("id").alias("identity"), F.count(F.lit(1)).alias("records"))
        if run:
            old = spark.read.parquet(self._path(run - 1, "identities")).join(
                roots.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").select(
                F.coalesce("to", "root").alias("root"), "identity", "records")
            sums = old.unionByName(sums).groupBy("root").agg(F.min("identity").alias("identity"), F.sum("records").alias("records"))
        sums.write.mode("overwrite").parquet(self._path(run, "identities"))
        fs, path = self._marker(spark, run)
        fs.create(path, True).close()

    def identities(self, spark: SparkSession, run: int) -> DataFrame:
        """(root, identity, records) after run ``run``."""
        return spark.read.parquet(self._path(run, "identities"))

    def link(self, records: DataFrame, run: int) -> DataFrame:
        """(id, identity) of ``records`` as run ``run`` left them: one look-up of
        each record's first key value."""
        spark = records.sparkSession
        keyed = key_values(records, self.id_col, self.keys).select("id", F.get("values", F.lit(0)).alias("node"))
        found = keyed.join(spark.read.parquet(self._path(run, "values")), "node", "left").join(self.identities(spark, run), "root", "left")
        return found.select("id", F.coalesce("identity", "id").alias("identity"))
