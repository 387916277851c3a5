"""SimHash near-duplicates by anchor points of a covering code.

Anchors are the words of a covering code: the product of two perfect binary
Golay codes over the first 46 bits of a fingerprint (covering radius 3 in each
half, 2**24 anchors; the other 18 bits are free). A fingerprint has one home
anchor. Two fingerprints that differ in d bits meet at the home of either,
because the other lies within covering radius plus d of it, the excess over
the radius summed over both halves; so each fingerprint is replicated to every
anchor whose excess is at most the threshold, and anchors compare their
members on all 64 bits. Replication depends on the code alone (about 60 anchors
for two bits), not on the data.

Equal fingerprints are one node. An anchor emits at most one edge per member
(a spanning forest of its links), never its pairs. An anchor with very many
members (a large family of near copies) finds its links by looking up the
members' flipped free bits in a sorted table instead of comparing all.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldenrec.operators.components import components
from goldenrec.llm.text import id_and_text
from goldenrec.session import materialize

#: Shingles of a text whose bits are summed at once.
BLOCK = 1 << 16

WEIGHTS = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


def fingerprint(text: bytes, shingle: int, seed: int = 42) -> int:
    """64-bit SimHash of a text: bit i is set if it is set in over half of the
    hashes of the word shingles, repeats counted."""
    words = text.lower().split()  # of bytes: ASCII alone
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    begins, ends = begins[:max(len(words) - shingle, 0) + 1], ends[min(shingle, len(words)) - 1:]
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(begins), BLOCK):
        hashes = [digest(joined[a:b], seed) for a, b in zip(begins[k:k + BLOCK].tolist(), ends[k:k + BLOCK].tolist())]
        total += np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    over = total * 2 > len(begins)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long. NULL and empty texts have
    fingerprint zero; a text with fewer words than ``shingle`` is one shingle."""
    rows = id_and_text(docs, id_col, text_col)

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t.as_buffer().to_pybytes(), shingle) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


# --- The covering code ------------------------------------------------------

#: Generator polynomial of the Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR, LENGTH, RADIUS = 0b110001110101, 23, 3


def syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word by the generator polynomial."""
    rest = words.astype(np.int64)
    for bit in range(LENGTH - 1, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    return rest


@lru_cache(8)
def offsets(threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every syndrome the patterns that lead from a word to the code words
    within radius + threshold: (begin of each syndrome's patterns, patterns,
    their excess over the radius)."""
    patterns = np.array([sum(1 << b for b in bits) for w in range(RADIUS + threshold + 1) for bits in combinations(range(LENGTH), w)], np.int64)
    weight = WEIGHTS[patterns & 0xFFFF] + WEIGHTS[patterns >> 16]
    key = syndromes(patterns)
    order = np.lexsort((weight, key))
    begin = np.searchsorted(key[order], np.arange(1 << 11 | 1))
    return begin, patterns[order], np.maximum(weight[order].astype(np.int64) - RADIUS, 0)


def _expand(begin: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, position) for runs of ``count`` positions from ``begin``."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + begin[owner]


def anchors(fps: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the fingerprint, anchor) for all replicas; fps: uint64."""
    begin, pattern, excess = offsets(threshold)
    halves = [((fps >> np.uint64(LENGTH * h)) & np.uint64((1 << LENGTH) - 1)).astype(np.int64) for h in (0, 1)]
    first = syndromes(halves[0])
    owner, at = _expand(begin[first], begin[first + 1] - begin[first])
    second = syndromes(halves[1])[owner]
    pair, at_2 = _expand(begin[second], begin[second + 1] - begin[second])
    near = excess[at][pair] + excess[at_2] <= threshold
    pair, at_2 = pair[near], at_2[near]
    owner, at = owner[pair], at[pair]
    return owner, (halves[0][owner] ^ pattern[at]) | (halves[1][owner] ^ pattern[at_2]) << LENGTH


# --- Comparison at an anchor ------------------------------------------------


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which uint64 values differ."""
    x = a ^ b
    out = WEIGHTS[(x & np.uint64(0xFFFF)).astype(np.int64)].astype(np.int16)
    for shift in (16, 32, 48):
        out += WEIGHTS[((x >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.int64)]
    return out


def _least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member index of each member's component under links (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


SMALL = 48
PAIRS = 1 << 21

#: Members that one member of a large anchor may meet on average for all to be
#: compared at once.
FEW = 32


def _link_small(anchor: np.ndarray, fps: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within equal anchors (sorted), members compared at every lag."""
    found_a, found_b = [], []
    index = np.arange(len(anchor) - 1)
    for lag in range(1, SMALL):
        index = index[index + lag < len(anchor)]
        index = index[anchor[index] == anchor[index + lag]]
        if not len(index):
            break
        near = index[distance(fps[index], fps[index + lag]) <= threshold]
        found_a.append(near)
        found_b.append(near + lag)
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_a), np.concatenate(found_b)


def _link_large(fps: np.ndarray, threshold: int) -> np.ndarray:
    """Component label of each member of one large anchor. Members that share
    the free bits but for a flip pattern are compared: all at once where each
    meets few others, else one family after another (``_link_dense``)."""
    free = (fps >> np.uint64(2 * LENGTH)).astype(np.int64)
    flips = np.array([sum(1 << b for b in bits) for w in range(threshold + 1) for bits in combinations(range(64 - 2 * LENGTH), w)], np.int64)
    order = np.argsort(free, kind="stable")
    keys, found_a, found_b, met = free[order], [], [], 0
    for k in range(0, len(order), PAIRS // len(flips)):
        some = order[k:k + PAIRS // len(flips)]
        want = (free[some][:, None] ^ flips).reshape(-1)
        begin, end = np.searchsorted(keys, want), np.searchsorted(keys, want, "right")
        met += int((end - begin).sum())
        if met > FEW * (k + len(some)) + PAIRS:
            return _link_dense(fps, free, flips, threshold)
        asked = np.flatnonzero(end > begin)
        owner, at = _expand(begin[asked], end[asked] - begin[asked])
        a, b = some[asked[owner] // len(flips)], order[at]
        near = (a < b) & (distance(fps[a], fps[b]) <= threshold)
        found_a.append(a[near])
        found_b.append(b[near])
    return _least_labels(len(fps), np.concatenate(found_a), np.concatenate(found_b))


def _link_dense(fps: np.ndarray, free: np.ndarray, flips: np.ndarray, threshold: int) -> np.ndarray:
    """The same for an anchor whose members meet many others. A member that has
    been reached is taken out of the comparisons, so families stay cheap; the
    table of members is made anew whenever half of it has gone."""
    label = np.full(len(fps), -1, np.int64)
    rest = np.argsort(free, kind="stable")  # by free bits; holds all members not reached
    keys, left = free[rest], len(fps)
    for seed in range(len(fps)):
        if label[seed] >= 0:
            continue
        label[seed] = seed
        left -= 1
        front = np.array([seed])
        while len(front):
            if left * 2 < len(rest):
                rest = rest[label[rest] < 0]
                keys = free[rest]
            if not left:
                break
            reached = []
            step = max(1, PAIRS // len(rest) // 8)
            for k in range(0, len(front), step):
                some = front[k:k + step]
                want = (free[some][:, None] ^ flips).reshape(-1)
                begin, end = np.searchsorted(keys, want), np.searchsorted(keys, want, "right")
                asked = np.flatnonzero(end > begin)
                for c in range(0, len(asked), 4096):
                    q = asked[c:c + 4096]
                    owner, at = _expand(begin[q], end[q] - begin[q])
                    new = label[rest[at]] < 0
                    owner, at = owner[new], at[new]
                    hit = np.unique(rest[at[distance(fps[some[q[owner] // len(flips)]], fps[rest[at]]) <= threshold]])
                    label[hit] = seed
                    left -= len(hit)
                    reached.append(hit)
            front = np.concatenate(reached) if reached else front[:0]
    return label


def _edges(anchor: np.ndarray, fps: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links within each anchor; sorted by anchor."""
    bound = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1], [True])))
    size = np.diff(bound)
    out = []
    small = np.repeat((size > 1) & (size <= SMALL), size)
    if small.any():
        a, f = anchor[small], fps[small]
        label = _least_labels(len(f), *_link_small(a, f, threshold))
        moved = np.flatnonzero(label != np.arange(len(f)))
        out.append((f[moved], f[label[moved]]))
    for k in np.flatnonzero(size > SMALL):
        f = fps[bound[k]:bound[k + 1]]
        label = _link_large(f, threshold)
        moved = np.flatnonzero(label != np.arange(len(f)))
        out.append((f[moved], f[label[moved]]))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])


def links(fps: DataFrame, threshold: int = 2) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (column fp, signed long) that
    connect exactly what pairs within ``threshold`` bits connect."""

    def replicate(batches):
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k in range(0, len(own), 20_000):
                index, anchor = anchors(own[k:k + 20_000], threshold)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(own[k:k + 20_000][index].view(np.int64))], ["anchor", "fp"])

    def compare(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []  # parts of the last anchor, joined once at its end

        def found(parts):
            u, v = _edges(np.concatenate([a for a, _ in parts]), np.concatenate([f for _, f in parts]), threshold)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        for batch in batches:
            a, f = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if not len(a):
                continue
            if held and held[-1][0][-1] == a[-1]:  # the whole batch goes on with it
                held.append((a, f))
                continue
            cut = int(np.searchsorted(a, a[-1]))  # the last anchor may go on in the next batch
            if held or cut:
                yield found([*held, (a[:cut], f[:cut])])
            held = [(a[cut:], f[cut:])]
        if held:
            yield found(held)

    # Replication makes small partitions large: they are not coalesced before it.
    spread = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    replicas = fps.select("fp").distinct().repartition(spread, "fp").mapInArrow(replicate, "anchor long, fp long")
    return replicas.repartition(spread, "anchor").sortWithinPartitions("anchor").mapInArrow(compare, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = 3, threshold: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs``.

    Fingerprints link at ``threshold`` or fewer differing bits; component_id is
    the least doc_id reachable over links, itself included. NULL texts count as
    empty; empty texts have fingerprint zero and link like any other. Repeated
    rows stay. A row with a NULL id takes part in linking; the component_id of a
    component without ids is NULL. Other columns are not read, so names cannot
    clash. An empty table gives an empty result.
    """
    own = materialize(fingerprints(docs, shingle, id_col, text_col), "simhash")
    nodes = own.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(links(own, threshold))
    placed = materialize(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")), "simhash")
    # Only components of several fingerprints meet at their root; a fingerprint
    # of its own keeps its least id without a shuffle by root.
    several = roots.select("root").distinct()
    label = placed.join(several, "root", "left_semi").groupBy("root").agg(F.min("first").alias("least"))
    named = placed.join(label, "root", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    return own.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, threshold: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is its component's least one, all columns
    as they were. Rows that repeat an id are one document: one stays. Rows
    without an id have no rank and stay."""
    found = near_duplicates(docs, shingle, threshold, id_col, text_col)
    keep = found.filter(F.col("doc_id") == F.col("component_id")).groupBy(F.col("doc_id").alias("__keep_id")).agg(
        F.count(F.lit(1)).alias("__rows"))
    # Both joins read one exchange of docs; the second is over repeated ids alone.
    same = F.col(id_col) == F.col("__keep_id")
    once = docs.join(keep.filter("__rows = 1"), same, "left_semi")
    repeated = docs.join(keep.filter("__rows > 1"), same, "left_semi").dropDuplicates([id_col])
    return once.unionByName(repeated).unionByName(docs.filter(F.col(id_col).isNull()))
