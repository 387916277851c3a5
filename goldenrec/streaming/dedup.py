"""Exact dedup of a stream by the columns a source declares (K4, ST1, ST2).

``dropDuplicatesWithinWatermark`` keeps a key's state until the watermark has
passed the key's event time by ``delay``: a repeated row that comes within the
delay is dropped, one that comes later than the watermark is late and dropped as
well, and the state holds the keys of about one delay, however long the stream
runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from goldenrec.sources.spec import SourceSpec


def drop_repeats(stream: DataFrame, key_cols: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """The first row of each key of ``stream`` within ``delay`` of event time.
    NULL key values are equal to each other."""
    if not key_cols:
        raise ValueError("no dedup columns")
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(key_cols))


def drop_repeats_of(stream: DataFrame, spec: SourceSpec, event_time: str, delay: str) -> DataFrame:
    """``drop_repeats`` by the source's ``dedup_columns``."""
    return drop_repeats(stream, spec.dedup_columns, event_time, delay)
