"""Line dedup with DataFrame functions alone.

Lines are exploded once into a narrow table (document, position, 128 bits of
hash of the normalised line); distinct documents are counted per hash, each
document's positions to drop are gathered, and the document is put together
again by position. Texts cross the network once, in the last join.

A line that is in very many documents is one hot hash: its documents are
counted after a distinct over (hash, document), which spreads them, and the
join that finds the positions has no grouping above it, so skewed partitions
of it are split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldenrec.llm.text import ascii_lower, text_of
from goldenrec.session import materialize

#: What is stripped from both ends of a line: space and tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def _split(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_hashes(docs: DataFrame, min_chars: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, body, pos, h1, h2) for each line whose normalised form has at
    least ``min_chars`` code points; body tells texts of one id apart. Rows
    without an id have no lines here."""
    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    # Hashed before the explode, so once for each text and not for each line.
    rows = rows.select("doc_id", F.xxhash64("text").alias("body"), _split(ascii_lower(F.col("text"))).alias("lines"))
    rows = rows.select("doc_id", "body", F.posexplode("lines").alias("pos", "line"))
    rows = rows.withColumn("line", F.btrim("line", F.lit(BLANKS))).filter(F.length("line") >= min_chars)
    return rows.select("doc_id", "body", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), "line").alias("h2"))


def dropped_positions(lines: DataFrame, min_docs: int = 2) -> DataFrame:
    """(doc_id, body, drop): the positions a document loses, those of lines that
    at least ``min_docs`` documents hold but for the least id among them."""
    shared = lines.select("h1", "h2", "doc_id").distinct().groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("first")).filter(F.col("docs") >= min_docs).drop("docs")
    # Written, so that both sides of the join are exchanges of their own and a
    # hot line's partition can be split.
    found = lines.join(materialize(shared, "lines"), ["h1", "h2"]).filter(F.col("doc_id") != F.col("first"))
    return found.groupBy("doc_id", "body").agg(F.collect_set("pos").alias("drop"))


def dedup_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with shared lines dropped from its text and two more columns,
    ``n_lines`` (before) and ``n_dropped``; columns of those names are replaced.

    Texts are split at newlines; a line's key is the line stripped of blanks
    with A-Z lower-cased. Keys of at least ``min_chars`` code points that at
    least ``min_docs`` documents hold stay in the document with the least id
    (all their lines there) and go from the others. NULL and empty texts are
    one empty line; a NULL text becomes the empty text. Rows that share an id
    are one document; a row without an id is not counted and keeps its lines.
    An empty table gives an empty result.
    """
    gone = dropped_positions(materialize(line_hashes(docs, min_chars, id_col, text_col), "lines"), min_docs).select(
        F.col("doc_id").alias("__id"), F.col("body").alias("__body"), F.col("drop").alias("__drop"))
    text = text_of(text_col)
    joined = docs.join(gone, (F.col(id_col) == F.col("__id")) & (F.xxhash64(text) == F.col("__body")), "left")
    # The lines are a column of their own: inside the lambda the split itself
    # would run again for every line.
    joined = joined.withColumn("__lines", _split(text))
    lines, drop = F.col("__lines"), F.col("__drop")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drop), lambda p: F.get(lines, p))
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    out = F.when(drop.isNull(), text).otherwise(F.array_join(kept, "\n"))
    return joined.select(*(out.alias(c) if c == text_col else F.col(c) for c in columns),
                         F.size(lines).cast("long").alias("n_lines"),
                         F.when(drop.isNull(), F.lit(0)).otherwise(F.size(drop)).cast("long").alias("n_dropped"))
