"""Helpers shared by the operators: text columns, Arrow slices, word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text handled at once inside a task. It bounds the temporary arrays;
#: a single longer text is a slice of its own.
SLICE_BYTES = 1 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_of(col: str = "text") -> Column:
    """The text, with NULL as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z alone. ``lower`` does the same for pure ASCII strings
    and is several times faster than ``translate``."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Two columns (doc_id, text) and nothing else, whatever the table holds."""
    return docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``most`` bytes of text each."""
    n = batch.num_rows
    if not n:
        return
    sizes = pc.binary_length(batch.column(batch.schema.get_field_index(column))).fill_null(0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes.astype(np.int64)) // most
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(part)) + 1, [n]))
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield batch.slice(int(a), int(b - a))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash, elementwise (uint64 in, uint64 out)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = np.uint64(0x9E3779B97F4A7C55)  # odd, so it has an inverse modulo 2**64
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for k, base in enumerate((_BASE, inverse)):
            full = np.full(max(n, SLICE_BYTES + 1024), base, np.uint64)
            full[0] = 1
            _powers[k] = np.cumprod(full)
    return _powers[0][:n], _powers[1][:n]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span of ``buf``: a polynomial in an odd base
    from one running sum, finalized with the length. The value depends on the
    bytes of the span alone."""
    power, inverse = _power_tables(len(buf) + 1)
    run = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power[:len(buf)], out=run[1:])
    return mix((run[ends] - run[starts]) * inverse[starts] + mix((ends - starts).astype(np.uint64)))
