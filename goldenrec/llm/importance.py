"""Quality classifier by importance resampling.

Two generative models of hashed n-grams (unigrams and bigrams of word and sign
runs) are counted in one pass: one of target texts (labelled rows of good
quality) and one of all texts. A document's log weight is the mean log ratio
of its n-grams under the two, drawn to zero for short texts. Documents are
sampled without replacement in proportion to their tempered weights by Gumbel
top-k: each gets its log weight over the temperature plus keyed Gumbel noise,
and the k greatest stay. k is the number of documents whose weight reaches the
cut that parts held-out labelled rows of good and bad quality best.

Counts are over every document and sized by ``buckets``; labelled rows are a
hash sample of at most ``max_labels``. The k-th greatest key comes from
repeated histograms of one column, so no ranking passes through one task.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldenrec.llm.text import id_and_text, mix, slices, span_hashes
from goldenrec.session import materialize

TARGET, HELD_OUT = 1, 2


@dataclass(frozen=True)
class Settings:
    """buckets: of the hashed n-grams; smoothing: added to each count; shrink:
    n-grams of weight zero added to each document; temperature: of the sampling
    weights; max_labels: labelled rows used, a fifth of them held out."""
    buckets: int = 1 << 15
    smoothing: float = 1.0
    shrink: int = 20
    temperature: float = 0.02
    max_labels: int = 20_000
    seed: int = 42


def _kinds() -> np.ndarray:
    kinds = np.full(256, 2, np.uint8)
    kinds[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
    kinds[[*range(9, 14), 32]] = 0
    return kinds


KINDS = _kinds()
AGAIN = np.uint64(0x5851F42D4C957F2D)


def ngrams(texts: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(document index, bucket) of every unigram and bigram of the texts. A word
    that follows itself also counts as one n-gram common to all words, as its
    own bigram would be new in each text."""
    raw = [t.as_buffer().to_pybytes() for t in texts]
    buf = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)) + 1)
    kind = KINDS[buf]
    change = np.flatnonzero(np.diff(kind)) + 1
    begin = np.concatenate(([0], change))
    end = np.append(change, len(buf))
    body = kind[begin] > 0
    begin, end = begin[body], end[body]
    one = span_hashes(buf, begin, end)
    owner = np.searchsorted(ends, begin, "right")
    same = owner[:-1] == owner[1:] if len(owner) else np.zeros(0, bool)
    two = mix(one[:-1] * np.uint64(3) + one[1:])[same]
    word = np.flatnonzero(kind[begin] == 1)
    again = word[1:][(one[word[1:]] == one[word[:-1]]) & (owner[word[1:]] == owner[word[:-1]])]
    hashes = np.concatenate((one, two, np.full(len(again), AGAIN, np.uint64)))
    return np.concatenate((owner, owner[:-1][same], owner[again])), (hashes % np.uint64(buckets)).astype(np.int64)


def labelled(labels: DataFrame, most: int, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(doc_id, good, role): at most ``most`` labelled ids, least hash first. An
    id with contradictory labels counts as bad; NULL ids or labels are left out."""
    rows = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("good")).dropna()
    rows = rows.groupBy("doc_id").agg(F.min("good").alias("good"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return rows.withColumn("role", F.when(F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(5)) == 0, HELD_OUT).when(
        F.col("good") == 1, TARGET).otherwise(0))


def log_ratios(docs: DataFrame, roles: DataFrame, s: Settings) -> np.ndarray | None:
    """Log ratio of target to raw probability for each bucket; None without
    target texts. ``docs``: (doc_id, text); ``roles``: at most max_labels rows."""
    marked = docs.join(F.broadcast(roles.select("doc_id", "role")), "doc_id", "left").select(
        "text", (F.coalesce("role", F.lit(0)) == TARGET).alias("target"))

    def count(batches):
        raw, target = np.zeros(s.buckets, np.int64), np.zeros(s.buckets, np.int64)
        for batch in batches:
            for part in slices(batch):
                owner, bucket = ngrams(part.column(0), s.buckets)
                raw += np.bincount(bucket, minlength=s.buckets)
                good = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
                target += np.bincount(bucket[good[owner]], minlength=s.buckets)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(raw[at]), pa.array(target[at])], ["bucket", "raw", "target"])

    sums = marked.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()  # at most s.buckets rows
    counts = np.zeros((2, s.buckets))
    for row in sums:
        counts[:, row["bucket"]] = row["raw"], row["target"]
    if not counts[1].any():
        return None
    p = (counts + s.smoothing) / (counts.sum(axis=1) + s.smoothing * s.buckets)[:, None]
    return np.log(p[1]) - np.log(p[0])


def _weights(texts: pa.Array, ratios: np.ndarray | None, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, log weight) of each text."""
    owner, bucket = ngrams(texts, s.buckets)
    n = np.bincount(owner, minlength=len(texts))
    if ratios is None:
        return n, np.zeros(len(texts))
    return n, np.bincount(owner, ratios[bucket], len(texts)) / (n + s.shrink)


def _noise(ids: pa.Array, texts: pa.Array, seed: int) -> np.ndarray:
    """Gumbel noise keyed by id and length of text."""
    raw = [f"{i}\0".encode() + str(len(t.as_buffer())).encode() for i, t in zip(ids.to_pylist(), texts)]
    ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
    h = span_hashes(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], ends[:-1])), ends) if raw else np.zeros(0, np.uint64)
    u = ((mix(h ^ mix(np.full(1, seed, np.uint64))) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53
    return -np.log(-np.log(u))


def _keys(ids: pa.Array, texts: pa.Array, ratios, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, weight = _weights(texts, ratios, s)
    return n, weight, weight / s.temperature + _noise(ids, texts, s.seed)


def scores(docs: DataFrame, ratios: np.ndarray | None, s: Settings) -> DataFrame:
    """(doc_id, n_grams, log_weight, sample_key) for rows (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)  # s.buckets doubles

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                arrays = map(pa.array, _keys(part.column(0), part.column(1), shared.value, s))
                yield pa.RecordBatch.from_arrays([part.column(0), *arrays], ["doc_id", "n_grams", "log_weight", "sample_key"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_grams long, log_weight double, sample_key double")


def best_cut(weight: np.ndarray, good: np.ndarray, cost: float = 4.0) -> float:
    """The weight that parts good from bad held-out rows best, in the middle of
    its gap; a lost share of good rows costs ``cost`` times one of bad rows kept.
    -inf if either kind is missing."""
    if good.all() or not good.any():
        return -np.inf
    order = np.argsort(weight, kind="stable")
    w, g = weight[order], good[order]
    right = np.cumsum(~g) / (~g).sum() - cost * np.cumsum(g) / g.sum()  # a cut just above each row
    k = int(np.argmax(right))
    return float((w[k] + w[min(k + 1, len(w) - 1)]) / 2)


def kth_greatest(rows: DataFrame, column: str, k: int, bins: int = 1024) -> float:
    """The k-th greatest value of a column without NaN or NULL, by histograms of
    ``bins`` rows; infinity for k <= 0."""
    if k <= 0:
        return np.inf
    low, high = rows.agg(F.min(column), F.max(column)).first()
    while low is not None and low < high:
        x = F.col(column)
        at = F.least(F.floor((x - F.lit(low)) / F.lit((high - low) / bins)), F.lit(bins - 1))
        found = rows.filter((x >= F.lit(low)) & (x <= F.lit(high))).groupBy(at.alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()
        for row in sorted(found, key=lambda r: -r["bin"]):
            if k <= row["n"]:
                low, high = row["low"], row["high"]
                break
            k -= row["n"]
        else:
            return low
    return low if low is not None else np.inf


@dataclass(frozen=True)
class Sample:
    ratios: np.ndarray | None
    cut: float
    least_key: float
    scores: DataFrame


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> Sample:
    """Counts the models, scores every document and finds the least sample key
    that stays."""
    rows = id_and_text(docs, id_col, text_col)
    roles = materialize(labelled(labels, settings.max_labels), "importance")
    ratios = log_ratios(rows, roles, settings)
    found = materialize(scores(rows, ratios, settings), "importance")
    # One row for each held-out id, however often it repeats: fewer than max_labels.
    held = found.join(F.broadcast(roles.filter(F.col("role") == HELD_OUT)), "doc_id").groupBy("doc_id").agg(
        F.min("log_weight").alias("log_weight"), F.first("good").alias("good")).collect()
    cut = best_cut(np.array([r["log_weight"] for r in held]), np.array([r["good"] == 1 for r in held], bool))
    k = found.filter(F.col("log_weight") >= F.lit(cut)).count()
    return Sample(ratios, cut, kth_greatest(found, "sample_key", k), found)


def classify(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_grams, log_weight, sample_key, kept) for each row of ``docs``.

    NULL and empty texts have no n-grams and weight zero (neutral). Rows that
    repeat an id and a text share their key and their fate, so ties at the edge
    all stay. A held-out id counts once for the cut, with the least weight of its
    rows. Without labels of both kinds every document stays. ``labels`` has
    doc_id and quality (1 good, 0 bad). An empty table gives an empty result.
    """
    sample = fit(docs, labels, settings, id_col, text_col)
    return sample.scores.withColumn("kept", F.col("sample_key") >= F.lit(sample.least_key))


def keep_good(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the sample keeps, all columns as they were. The
    keys are computed again beside the text, so texts are not shuffled."""
    sample = fit(docs, labels, settings, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(sample.ratios)
    least, at, text_at = sample.least_key, docs.columns.index(id_col), docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                texts = part.column(text_at).fill_null("")
                key = _keys(part.column(at), texts, shared.value, settings)[2]
                yield part.filter(pa.array(key >= least))

    return docs.mapInArrow(run, docs.schema)
