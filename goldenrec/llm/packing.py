"""Packing token sequences by Karmarkar-Karp multiway differencing.

Each document's ids (its text's tokens and one separator) are cut into full
windows, which need no partner, and a rest. A rest longer than ``grain`` is
cut once more, after the largest multiple of ``grain``: small items are what
differencing balances with. Items are gathered per task, ``group`` at a time;
each group is divided into as few windows as hold its tokens. Differencing
takes the two partial partitions with the largest imbalance and adds the
heavy slots of one to the light slots of the other until one partition is
left. If a window of it is over the capacity, the number of windows rises by
one and the group is divided again.

Everything happens in the task that scanned the documents: nothing is
shuffled, collected or kept beyond one group. Sequence ids hold the task's
partition number, so they are unique over the table; a task that is run again
gives the same rows for the same input split.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from goldenrec.llm.text import id_and_text, slices
from goldenrec.llm.transducer import transducer


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """Slot (0..k-1) of each item after multiway differencing into k slots."""
    n = len(sizes)
    # A slot's content is a node: 0 is nothing, 1..n are the items, further
    # nodes join two others.
    join_a, join_b = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    joined, upto = [(join_a, join_b)], n + 1
    heap = []
    for i, size in enumerate(sizes.tolist()):
        sums, nodes = np.zeros(k, np.int64), np.zeros(k, np.int64)
        sums[0], nodes[0] = size, i + 1
        heap.append((-size, i, sums, nodes))
    heapq.heapify(heap)
    order = n
    while len(heap) > 1:
        _, _, sums_a, nodes_a = heapq.heappop(heap)
        _, _, sums_b, nodes_b = heap[0]
        sums, a, b = sums_a + sums_b[::-1], nodes_a, nodes_b[::-1]
        nodes = np.maximum(a, b)
        both = np.flatnonzero((a > 0) & (b > 0))
        if len(both):
            joined.append((a[both], b[both]))
            nodes[both] = np.arange(upto, upto + len(both))
            upto += len(both)
        down = np.argsort(-sums, kind="stable")
        sums, nodes = sums[down], nodes[down]
        sums -= sums[-1]
        heapq.heapreplace(heap, (-int(sums[0]), order, sums, nodes))
        order += 1
    slot_of = np.full(upto, -1, np.int64)
    final = heap[0][3]
    slot_of[final[final > 0]] = np.flatnonzero(final > 0)
    a, b = np.concatenate([x[0] for x in joined]), np.concatenate([x[1] for x in joined])
    for node in range(upto - 1, n, -1):  # a node's parts have smaller numbers
        slot_of[a[node]] = slot_of[b[node]] = slot_of[node]
    return slot_of[1:n + 1]


def windows(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Window of each item, none of them over the capacity: near-equal windows,
    their number rising from the least that could do."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        slot = differencing(sizes, k)
        if np.bincount(slot, sizes, k).max() <= capacity:
            return slot
        k += 1


SCHEMA = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class _Packer:
    def __init__(self, capacity: int, group: int, grain: int):
        self.capacity, self.group, self.grain = capacity, group, grain
        self.task, self.sequences = (TaskContext.get().partitionId() if TaskContext.get() else 0), 0
        self.rows, self.items = [], []  # item: (doc index in ids, start, crc, doc_tokens, length)

    def _sequence(self) -> int:
        self.sequences += 1
        return (self.task << 40) + self.sequences - 1

    def add(self, doc, ids: np.ndarray) -> None:
        n, cap = len(ids), self.capacity
        raw = ids.astype("<u4").tobytes()
        full = n // cap * cap
        for start in range(0, full, cap):
            self.rows.append((doc, start, cap, zlib.crc32(raw[4 * start:4 * (start + cap)]), n, self._sequence(), 0))
        edge = full + (n - full) // self.grain * self.grain
        for start, end in ((full, edge), (edge, n)):
            if end > start:
                self.items.append((doc, start, zlib.crc32(raw[4 * start:4 * end]), n, end - start))

    def pack(self) -> None:
        items, self.items = self.items, []
        if not items:
            return
        slot = windows(np.array([x[4] for x in items], np.int64), self.capacity)
        ids: dict[int, list[int]] = {}
        for i in np.argsort(slot, kind="stable").tolist():
            doc, start, crc, n, length = items[i]
            place = ids.setdefault(int(slot[i]), [self._sequence() if int(slot[i]) not in ids else 0, 0])
            self.rows.append((doc, start, length, crc, n, place[0], place[1]))
            place[1] += length

    def take(self, kind: pa.DataType) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows)) if rows else [()] * 7
        arrays = [pa.array(columns[0], kind), *(pa.array(c, pa.int64()) for c in columns[1:])]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", *(x.split()[0] for x in SCHEMA.split(", "))])


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, separator: int = 1, group: int = 1024, grain: int = 512,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset).

    A document's ids are its text's tokens and ``separator``; a NULL or empty
    text is the separator alone. Each id lies in exactly one piece; offsets in
    a sequence run from 0 without gaps and no sequence is longer than
    ``capacity``. ``group`` is how many items are divided at once; the windows
    of one group differ by a few tokens. Each row of the input is a document of
    its own, whatever its id (NULL and repeated ids stay). Other columns are
    not read. An empty table gives an empty result.
    """
    rows = id_and_text(docs, id_col, text_col)

    def run(batches):
        machine, packer, kind = transducer(tokenizer_path), _Packer(capacity, group, grain), None
        for batch in batches:
            kind = batch.schema.field(0).type
            for part in slices(batch, most=2 << 20):
                ids, ends = machine.encode(part.column(1).to_pylist())
                for doc, own in zip(part.column(0).to_pylist(), np.split(ids, ends[:-1]) if len(ends) else []):
                    packer.add(doc, np.append(own, separator))
                    if len(packer.items) >= group:
                        packer.pack()
                yield packer.take(kind)
        packer.pack()
        if kind is not None:
            yield packer.take(kind)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, {SCHEMA}")
