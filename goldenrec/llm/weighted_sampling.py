"""Document fingerprints by consistent weighted sampling.

A text is a weighted set: its words (lower-cased runs of letters and digits),
weighted by how often they occur. For each of the signature's slots every term
has its own gamma variates r and c and uniform b, all from a keyed hash of the
term. With t = floor(ln w / r + b), the term's value is c * exp(-r (t - b) - r);
the slot is taken by the term with the least value, together with its t. Two
texts agree in a slot with probability equal to their generalised Jaccard
similarity, the sum of the lesser weights over the sum of the greater ones. A
slot is kept as 16 bits of hash of its least value, which stands for (term, t).

``edited_fingerprints`` also compares each document with the next one by
ascending id. Texts cross the network once, range-partitioned by id; every task
reads its sorted rows as a stream. The last row of a task meets the first row
of the next task in a small join of these border rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldenrec.llm.text import id_and_text, mix, span_hashes
from goldenrec.session import materialize

SLOTS = 64
WORD = np.zeros(256, bool)
WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: Terms, and (text, term) rows, that are worked on at once.
TERMS, ROWS = 1 << 13, 1 << 14
#: Characters of text gathered before signatures are computed.
GATHER = 1 << 20


def terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of each text: (text index, term index, weight, term hashes)."""
    raw = [t.lower().encode() for t in texts]
    buf = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
    word = WORD[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], word)).astype(np.int8)))  # the last sign is a space
    begin, end = edge[::2], edge[1::2]
    hashes, term = np.unique(span_hashes(buf, begin, end), return_inverse=True)
    owner = np.searchsorted(ends, begin, "right")
    pair, weight = np.unique(owner * max(len(hashes), 1) + term, return_counts=True)
    return pair // max(len(hashes), 1), pair % max(len(hashes), 1), weight, hashes


def _variates(hashes: np.ndarray, slots: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(r, b, ln c - r + r b) for each term and slot, from 24-bit uniforms."""
    r, b, base = (np.empty((len(hashes), slots), np.float32) for _ in range(3))
    keys = mix(np.arange(slots, dtype=np.uint64) + mix(np.full(1, seed, np.uint64)))
    low = np.uint64(0xFFFFFF)

    def unit(x):
        return (x.astype(np.float32) + np.float32(0.5)) * np.float32(2.0 ** -24)

    for k in range(0, len(hashes), TERMS):
        x = mix(hashes[k:k + TERMS, None] ^ keys)
        y = mix(x + np.uint64(0x9E3779B97F4A7C15))
        own_r = -np.log(unit(x >> np.uint64(40)) * unit(x >> np.uint64(16) & low))
        c = -np.log(unit(y >> np.uint64(40)) * unit(y >> np.uint64(16) & low))
        own_b = unit((x & np.uint64(0xFFFF)) << np.uint64(8) | y & np.uint64(0xFF))
        r[k:k + TERMS], b[k:k + TERMS], base[k:k + TERMS] = own_r, own_b, np.log(c) - own_r + own_r * own_b
    return r, b, base


def signatures(texts: list[str], slots: int = SLOTS, seed: int = 42) -> np.ndarray:
    """(texts x slots) of 16-bit slots. A text without terms has slots of zero."""
    out = np.zeros((len(texts), slots), np.uint16)
    if not texts:
        return out
    owner, term, weight, hashes = terms(texts)
    if not len(owner):
        return out
    r, b, base = _variates(hashes, slots, seed)
    logs = np.log(weight.astype(np.float32))
    first = np.concatenate(([0], np.flatnonzero(np.diff(owner)) + 1))  # rows of each text with terms
    k = 0
    while k < len(first):
        after = max(k + 1, int(np.searchsorted(first, first[k] + ROWS)))
        rows = slice(first[k], first[after] if after < len(first) else len(owner))
        value = base[term[rows]]
        more = np.flatnonzero(weight[rows] > 1)  # for weight one, t is zero
        own = term[rows][more]
        value[more] -= r[own] * np.floor(logs[rows][more, None] / r[own] + b[own])
        least = np.minimum.reduceat(value, first[k:after] - first[k], axis=0)
        out[owner[first[k:after]]] = mix(least.view(np.uint32).astype(np.uint64)) >> np.uint64(48)
        k = after
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal slots, the estimate of the generalised Jaccard similarity."""
    return (a == b).mean(axis=1) if len(a) else np.zeros(0)


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the next text's begin."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _hex(signature: np.ndarray) -> str:
    return signature.astype(">u2").tobytes().hex()


NAMES = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _compare(texts: list[str], following: list[str]) -> list[pa.Array]:
    """The columns NAMES for texts and the texts that follow them."""
    changed = [edited(a, b) for a, b in zip(texts, following)]
    chain = all(b is a for a, b in zip(texts[1:], following))
    found = signatures(texts + changed + (following[-1:] if chain else following))
    own, new, nxt = found[:len(texts)], found[len(texts):2 * len(texts)], found[2 * len(texts):]
    nxt = np.concatenate((own[1:], nxt)) if chain else nxt
    return [pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            pa.array(list(map(_hex, own)), pa.string()), pa.array(list(map(_hex, new)), pa.string()),
            pa.array(likeness(own, new)), pa.array(likeness(own, nxt))]


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next) for each row of ``docs``.

    The next document is the one after it by ascending id; after the last comes
    the first. NULL texts count as empty. Rows without an id come before all
    others; rows that share an id follow one another by hash of their text. A
    table of one row is its own next. Texts without words are like each other
    and unlike all others. Other columns are not read, so names cannot clash. An
    empty table gives an empty result.
    """
    rows = id_and_text(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    # Only the row at either end of a task's range is returned with its text.
    schema = f"doc_id {kind}, {COLUMNS}, border string, task long, text string"
    placed = rows.repartitionByRange(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id", F.xxhash64("text")) \
        .sortWithinPartitions("doc_id", F.xxhash64("text"))

    def run(batches):
        task, first, ids, texts, size = TaskContext.get().partitionId(), True, [], [], 0
        names = ["doc_id", *NAMES, "border", "task", "text"]

        def border(which, own_kind, at):
            empty = [pa.nulls(1, a) for a in (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())]
            return pa.RecordBatch.from_arrays([pa.array([ids[at]], own_kind), *empty, pa.array([which]), pa.array([task]), pa.array([texts[at]])], names)

        for batch in batches:
            own_kind = batch.column(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(doc)
                texts.append(text)
                size += len(text)
                if first:
                    yield border("first", own_kind, 0)
                    first = False
                if size > GATHER and len(ids) > 1:
                    n = len(ids) - 1
                    yield pa.RecordBatch.from_arrays([pa.array(ids[:-1], own_kind), *_compare(texts[:-1], texts[1:]), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())], names)
                    ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])
        if len(ids) > 1:
            n = len(ids) - 1
            yield pa.RecordBatch.from_arrays([pa.array(ids[:-1], own_kind), *_compare(texts[:-1], texts[1:]), pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())], names)
        if ids:
            yield border("last", own_kind, -1)

    # Written once: another evaluation might place the ranges elsewhere.
    found = materialize(placed.mapInArrow(run, schema), "weighted_sampling")
    tasks = sorted(r[0] for r in found.filter("border = 'first'").select("task").collect())  # one for each task
    after = docs.sparkSession.createDataFrame([(a, b) for a, b in zip(tasks, tasks[1:] + tasks[:1])], "task long, next long")
    ends = found.filter("border = 'last'").select("doc_id", "task", "text").join(after, "task").select("doc_id", "text", "next")
    starts = found.filter("border = 'first'").select(F.col("task").alias("next"), F.col("text").alias("following"))

    def pairs(batches):
        for batch in batches:
            for k in range(batch.num_rows):  # one pair at a time: each row may be long
                row = batch.slice(k, 1)
                yield pa.RecordBatch.from_arrays([row.column(0), *_compare(row.column(1).to_pylist(), row.column(2).to_pylist())], ["doc_id", *NAMES])

    last = ends.join(starts, "next").select("doc_id", "text", "following").mapInArrow(pairs, f"doc_id {kind}, {COLUMNS}")
    return found.filter("border is null").select("doc_id", *NAMES).unionByName(last)


COLUMNS = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
