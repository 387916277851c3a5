"""Helpers of the conversation operators: one order over all turns, row streams
in sorted partitions, and hashes of long joined texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldenrec.session import materialize

#: Rows of an Arrow batch on its way back from Python.
BATCH_ROWS = 4096


def ordered(turns: DataFrame, ties: tuple[str, ...] = ("role", "h1")) -> DataFrame:
    """``turns`` (conv_id, turn, ``ties`` and more), written once, with ``seq``
    ascending in the order conv_id, turn (NULL first), ``ties``.

    Ranges cut wherever rows are many, so a conversation that holds much of the
    table, or a turn number or a row that it repeats, lies in many partitions:
    the last key is the row's place in the input. ``seq`` is the partition's
    number and the place in it, so ``seq >> k`` is a block of at most 2**k rows.
    """
    spark = turns.sparkSession
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), *map(F.col, ties), F.col("_place")]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = turns.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    return materialize(placed.drop("_place").withColumn("seq", F.monotonically_increasing_id()), "turns")


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples, a batch at a time."""
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def batches_of(rows: Iterable[tuple], schema: pa.Schema, most_rows: int = BATCH_ROWS, most_chars: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """Tuples as Arrow batches, bounded by rows and by characters of text."""
    def batch(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= most_rows or chars >= most_chars:
            yield batch(held)
            held, chars = [], 0
    if held:
        yield batch(held)


#: Characters to which ``packed`` joins neighbouring texts.
PACK_CHARS = 1 << 16


def packed(pieces: DataFrame, keys: list[str], order: list[str], text: str, sep: str) -> DataFrame:
    """The texts of each key joined by ``sep`` to fewer, longer ones, in ranges
    of (keys, order): a key with very many short texts is joined by many tasks.
    Columns as before; ``order`` is that of the first text joined."""
    def join(batches):
        key, start, held, chars = None, None, [], 0
        for row in rows_of(batches):
            now, at, piece = row[:len(keys)], row[len(keys):-1], row[-1]
            if held and (now != key or chars >= PACK_CHARS):
                yield (*key, *start, sep.join(held))
                held, chars = [], 0
            if not held:
                key, start = now, at
            held.append(piece)
            chars += len(piece)
        if held:
            yield (*key, *start, sep.join(held))

    columns = [*keys, *order, text]
    n = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = pieces.select(*columns).repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
    schema = pieces.select(*columns).schema
    arrow = _arrow(schema)
    return rows.mapInArrow(lambda b: batches_of(join(b), arrow), schema)


def joined_sha256(pieces: DataFrame, keys: list[str], order: list[str], text: str, sep: str, out: str) -> DataFrame:
    """(keys, out): SHA-256 (lowercase hex) of each key's texts in ``order``,
    joined by ``sep``. A hash is one chain over its bytes, so a key's pieces
    pass through one task, one after another; nothing is held but the chain.
    ``order`` must tell a key's pieces apart; ``packed`` makes short ones few."""
    sep_bytes = sep.encode()

    def digests(batches):
        key, chain = None, None
        for *now, piece in rows_of(batches):
            if chain is None or now != key:
                if chain is not None:
                    yield (*key, chain.hexdigest())
                key, chain = now, hashlib.sha256()
            else:
                chain.update(sep_bytes)
            chain.update(piece.encode())
        if chain is not None:
            yield (*key, chain.hexdigest())

    rows = pieces.select(*keys, *order, F.col(text).alias("_piece")).repartition(*keys).sortWithinPartitions(*keys, *order)
    schema = pieces.select(*keys).schema.add(out, "string")
    arrow = _arrow(schema)
    return rows.select(*keys, "_piece").mapInArrow(lambda b: batches_of(digests(b), arrow), schema)


def _arrow(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)
