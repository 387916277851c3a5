"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs; all but the last return the
columns of documents. ``run`` does so in the cluster's shared folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldenrec.llm.importance import keep_good
from goldenrec.llm.line_dedup import dedup_lines
from goldenrec.llm.packing import pack
from goldenrec.llm.queries import ready, table
from goldenrec.llm.simhash import drop_near_duplicates
from goldenrec.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance sample keeps; the others go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shared lines dropped from the texts, n_chars counted anew."""
    ready(spark)
    found = dedup_lines(docs)
    return found.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal or near fingerprints, the least id."""
    ready(spark)
    return drop_near_duplicates(docs, shingle=3, threshold=2).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences."""
    ready(spark)
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality classifier", quality), ("line dedup", lines), ("SimHash near-dedup", near_duplicates), ("packing", packing)]

#: Tokenizing, fingerprints and the sample have no SQL form; tests/llm compares
#: run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline")
    return docs
