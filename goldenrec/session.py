"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job wants: AQE (runtime coalescing, skew-join splitting and
# broadcast conversion from measured sizes) and a pinned time zone.
BASE_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Of compressed rows. A task that joins and sorts narrow rows into wide ones
    # (golden_by_key) holds some 20 times as much.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.session.timeZone": "UTC",
}

# Static settings: only effective when the session is built.
BUILD_CONF: dict[str, str] = {
    # PySpark records the Python call site of every Column call (several JVM
    # round trips each); plans built from hundreds of generated expressions
    # pay seconds of driver time for it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, cores: int = 8, app: str = "goldenrec", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf.update(BUILD_CONF)
    conf.update(
        {
            "spark.sql.shuffle.partitions": str(cores),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
            "spark.sql.execution.arrow.pyspark.enabled": "true",
        }
    )
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_base_conf(spark: SparkSession) -> None:
    """AQE, skew handling and UTC on a session we did not build ourselves."""
    for k, v in BASE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # pragma: no cover - static conf on a running cluster
            pass


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    Reads ``spark.checkpoint.dir`` from the session. Only a local-mode session
    without that setting (tests, laptop runs) gets one of our own under the
    system temp folder; a cluster session without it is an error, because a
    machine-local folder is not visible to the other executors.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not (sc.master or "").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="goldenrec-ckpt-"))
        base = sc.getCheckpointDir()
    return os.path.join(base, *parts, uuid.uuid4().hex)


def materialize(df, *parts: str):
    """Write ``df`` once as a parquet table in the shared checkpoint folder
    and return a read of it: later branches read the table (column-pruned)
    instead of recomputing the plan, and lineage is cut."""
    spark = df.sparkSession
    path = shared_dir(spark, *(parts or ("materialized",)))
    df.write.parquet(path)
    return spark.read.parquet(path)
