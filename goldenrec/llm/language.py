"""Language identification by unigrams over the pieces of a public vocabulary,
with all segmentations summed.

A text is a row of letter runs. A language gives each run the sum, over every
way to cut it into pieces of the vocabulary, of the product of its pieces'
probabilities: a forward pass over the run's letters. The probabilities are
learned by expectation maximisation, in which a forward and a backward pass give
each piece its expected count over all segmentations, from the words of all
learning texts and their counts.

Pieces of the vocabulary do not reach over a space, so a text's probability is
the product of its runs', and each distinct run is worked out once in a task.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldenrec.llm.text import id_and_text, slices, text_of
from goldenrec.session import materialize

#: Letters of a run that are segmented at once; a longer run is cut here.
UNIT = 24

#: Factor a letter in the sums, so that long runs stay far from the least double.
SCALE = 1e4

#: Places behind the point of an expected count; sums of whole numbers do not
#: depend on their order.
PLACES = 1 << 16

#: Characters that share the probability of a letter outside the vocabulary.
STRANGERS = 1 << 8

#: Distinct runs that a task remembers.
REMEMBER = 1 << 18

#: Distinct words that a task counts before it hands them on.
COUNT = 1 << 17

#: Characters of a text whose runs are listed at once.
PART = 1 << 20

_RUN = re.compile(r"[^\W\d_]+")
_BREAK = re.compile(r"[\W\d_]")
_BASE = np.uint64(0x9E3779B97F4A7C55)


def runs(text: str) -> Iterator[list[str]]:
    """The letter runs of a text, lower-cased, a list for each part of it. Signs
    that count as numbers but not as letters part no run and are left out."""
    text, start = text.lower(), 0
    while start < len(text):
        cut = _BREAK.search(text, start + PART)
        end = cut.start() if cut else len(text)
        found = _RUN.findall(text, start, end)
        if not "".join(found).isalpha():
            found = [w for w in ("".join(c for c in w if c.isalpha()) for w in found) if w]
        yield found
        start = end


def units(word: str) -> list[str]:
    """A run as the vocabulary spells it, the mark of a word's beginning first, in
    parts of at most UNIT letters."""
    return ["▁" + word[:UNIT], *(word[k:k + UNIT] for k in range(UNIT, len(word), UNIT))]


def load_pieces(path: str) -> list[str]:
    """The vocabulary's pieces that can stand in a run: letters, with the mark
    only at the beginning."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    every = (model.id_to_piece(k) for k in range(model.vocab_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k)))
    return sorted({p for p in every if p == "▁" or (p[p.startswith("▁"):].isalpha() and p == p.lower())})


class Lattice:
    """Every way to cut strings into pieces: for a piece length, the piece that
    starts at each place (``none``, the number of pieces, where there is none).

    Pieces are found by a rolling hash of their signs in a table of SLOTS places;
    the few whose place is taken stand in a second one.
    """

    SLOTS = 20

    def __init__(self, pieces: list[str]):
        self.none = len(pieces)
        self.longest = max(map(len, pieces), default=1)
        self.sizes = np.array([*map(len, pieces), 1])
        self.power = np.full(max(self.longest, UNIT + 1) + 1, _BASE, np.uint64)
        self.power[0] = 1
        self.power = np.cumprod(self.power)
        self.keys = np.array([*map(self._key, pieces), 0], np.uint64)
        self.tables: list[tuple[np.uint64, np.ndarray]] = []
        left = np.arange(self.none)
        while len(left):
            factor, table = np.uint64(2 * hash_seed(len(self.tables)) + 1), np.full(1 << self.SLOTS, self.none, np.int32)
            table[self._slot(self.keys[left], factor)[::-1]] = left[::-1]
            self.tables.append((factor, table))
            left = left[table[self._slot(self.keys[left], factor)] != left]

    def _slot(self, keys: np.ndarray, factor: np.uint64) -> np.ndarray:
        return ((keys * factor) >> np.uint64(64 - self.SLOTS)).astype(np.int64)

    @staticmethod
    def _key(piece: str) -> int:
        key = 0
        for c in piece:
            key = (key * int(_BASE) + ord(c) + 1) % (1 << 64)
        return key

    def look_up(self, strings: list[str]) -> list[np.ndarray]:
        """For strings of one length: [l - 1][j, s] is the piece of length l that
        starts at place j of string s."""
        size = len(strings[0])
        signs = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(strings), size).T.astype(np.uint64)
        run = np.zeros((size + 1, len(strings)), np.uint64)
        for j in range(size):
            run[j + 1] = run[j] * _BASE + signs[j] + np.uint64(1)
        found = []
        for n in range(1, min(self.longest, size) + 1):
            keys = run[n:] - run[:-n] * self.power[n]
            out = np.full(keys.shape, self.none, np.int32)
            for factor, table in self.tables:
                at = table[self._slot(keys, factor)]
                hit = (self.keys[at] == keys) & (self.sizes[at] == n)
                out[hit] = at[hit]
            found.append(out)
        return found


def hash_seed(k: int) -> int:
    """The k-th of a row of well mixed numbers below 2**62."""
    return ((k + 1) * 0x9E3779B97F4A7C15 ^ 0xBF58476D1CE4E5B9) % (1 << 62)


def forward(found: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """[place, string, language]: summed probability of all ways to reach a place.
    ``weights``: [piece, language], scaled; the last row is a strange letter's,
    which counts where no piece of one sign is."""
    size, strings = found[0].shape
    alpha = np.zeros((size + 1, strings, weights.shape[1]))
    alpha[0] = 1
    inside = np.vstack([weights[:-1], np.zeros((1, weights.shape[1]))])
    for j in range(1, size + 1):
        for n, at in enumerate(found[:j], 1):
            alpha[j] += alpha[j - n] * (weights if n == 1 else inside)[at[j - n]]
    return alpha


def backward(found: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    size, strings = found[0].shape
    beta = np.zeros((size + 1, strings, weights.shape[1]))
    beta[size] = 1
    inside = np.vstack([weights[:-1], np.zeros((1, weights.shape[1]))])
    for j in range(size - 1, -1, -1):
        for n, at in enumerate(found[:size - j], 1):
            beta[j] += beta[j + n] * (weights if n == 1 else inside)[at[j]]
    return beta


def same_length(strings: Iterable[str], most: int = 4096) -> Iterator[list[int]]:
    """Positions of strings of one length, in lists of at most ``most``."""
    by_size: dict[int, list[int]] = {}
    for k, s in enumerate(strings):
        by_size.setdefault(len(s), []).append(k)
    for places in by_size.values():
        for k in range(0, len(places), most):
            yield places[k:k + most]


@dataclass
class Model:
    """Languages, the logarithms of their shares and piece probabilities
    ([piece, language]; the last row is a letter outside the vocabulary)."""

    pieces: list[str]
    languages: list[str]
    prior: np.ndarray
    probability: np.ndarray

    def weights(self, lattice: Lattice) -> np.ndarray:
        share = np.where(np.arange(len(lattice.sizes)) == lattice.none, 1 / STRANGERS, 1.0)
        return self.probability * (SCALE ** lattice.sizes * share)[:, None]


def log_weights(model: Model, lattice: Lattice, weights: np.ndarray, words: list[str]) -> np.ndarray:
    """[word, language]: logarithm of each run's probability."""
    parts = [(k, u) for k, w in enumerate(words) for u in units(w)]
    out = np.zeros((len(words), len(model.languages)))
    for places in same_length(u for _, u in parts):
        strings = [parts[p][1] for p in places]
        whole = forward(lattice.look_up(strings), weights)[-1]
        np.add.at(out, [parts[p][0] for p in places], np.log(whole) - len(strings[0]) * np.log(SCALE))
    return out


class Runs:
    """The runs that a task has met, with their logarithms."""

    def __init__(self, model: Model, lattice: Lattice):
        self.model, self.lattice, self.weights = model, lattice, model.weights(lattice)
        self.place: dict[str, int] = {}
        self.table = np.zeros((0, len(model.languages)))

    def add(self, total: np.ndarray, texts: list[tuple[int, list[str]]]) -> None:
        """Adds the logarithms of each (row, runs) to its row of ``total``."""
        if len(self.place) > REMEMBER:
            self.place, self.table = {}, self.table[:0]
        new = {w for _, words in texts for w in words}.difference(self.place)
        if new:
            new = list(new)
            self.place.update(zip(new, range(len(self.table), len(self.table) + len(new))))
            self.table = np.vstack([self.table, log_weights(self.model, self.lattice, self.weights, new)])
        for row, words in texts:
            total[row] += self.table[list(map(self.place.__getitem__, words))].sum(0)


def _word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over the texts of ``docs`` (lang, text)."""
    schema = "lang string, word string, n long"
    arrow = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def table(counts: tuple[str, Counter]) -> pa.RecordBatch:
        lang, words = counts
        columns = [pa.array([lang] * len(words), pa.string()), pa.array(words, pa.string()), pa.array(words.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, schema=arrow)

    def count(batches):
        counts: dict[str, Counter] = {}
        for batch in batches:
            for part in slices(batch):
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    mine = counts.setdefault(lang, Counter())
                    for found in runs(text):
                        mine.update(found)
                        if sum(map(len, counts.values())) >= COUNT:
                            yield from map(table, counts.items())
                            counts.clear()
                            mine = counts.setdefault(lang, Counter())
        yield from map(table, counts.items())

    return docs.select("lang", text_of().alias("text")).mapInArrow(count, schema).groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _expected(words: DataFrame, model: Model) -> np.ndarray:
    """[piece, language]: expected counts over all segmentations of all words."""
    lattice, place = Lattice(model.pieces), {lang: k for k, lang in enumerate(model.languages)}
    shared = words.sparkSession.sparkContext.broadcast((model, lattice))
    arrow = pa.schema([("lang", pa.int32()), ("piece", pa.int32()), ("n", pa.int64())])

    def expect(batches):
        model, lattice = shared.value
        weights, total = model.weights(lattice), np.zeros((len(model.languages), lattice.none + 1), np.int64)
        for batch in batches:
            langs, texts, counts = (batch.column(k).to_pylist() for k in range(3))
            parts = [(place[lang], u, n) for lang, w, n in zip(langs, texts, counts) for u in units(w)]
            for at in same_length(u for _, u, _ in parts):
                for g in {parts[p][0] for p in at}:
                    mine = [p for p in at if parts[p][0] == g]
                    found, own = lattice.look_up([parts[p][1] for p in mine]), weights[:, g:g + 1]
                    alpha, beta = forward(found, own)[:, :, 0], backward(found, own)[:, :, 0]
                    times = np.array([parts[p][2] for p in mine], float) / alpha[-1]
                    inside = np.append(own[:-1, 0], 0)
                    for n, pieces in enumerate(found, 1):
                        share = alpha[:len(pieces)] * (own[:, 0] if n == 1 else inside)[pieces] * beta[n:n + len(pieces)] * times
                        sums = np.bincount(pieces.ravel(), np.rint(share * PLACES).ravel(), lattice.none + 1)  # whole numbers below 2**53
                        total[g] += sums.astype(np.int64)
        lang, piece = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int32()), pa.array(piece, pa.int32()), pa.array(total[lang, piece], pa.int64())], schema=arrow)

    sums = words.select("lang", "word", "n").mapInArrow(expect, "lang int, piece int, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
    found = sums.toArrow()  # at most languages x vocabulary rows
    out = np.zeros((len(model.pieces) + 1, len(model.languages)))
    out[found["piece"].to_numpy(), found["lang"].to_numpy()] = found["n"].to_numpy() / PLACES
    return out


def fit(docs: DataFrame, path: str, rounds: int = 2, smoothing: float = 100.0) -> Model | None:
    """The model of the languages of ``docs`` (text, lang) that are not NULL, from
    all their texts; None without any.

    The first round starts from equal probabilities. Each round's expected counts
    are smoothed with ``smoothing`` counts spread as all languages together spread
    theirs. What reaches the driver is a count for each language and piece.
    """
    known = docs.filter(F.col("lang").isNotNull())
    shares = sorted((r[0], r[1]) for r in known.groupBy(F.col("lang").cast("string")).count().collect())
    if not shares:
        return None
    pieces, languages = load_pieces(path), [lang for lang, _ in shares]
    sizes = np.array([n for _, n in shares], float)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = _word_counts(known.select(F.col("lang").cast("string").alias("lang"), "text"))
    # Few bytes, but much work a row: as many parts as a shuffle has.
    words = materialize(words.repartition(n, "lang", "word"), "language")
    model = Model(pieces, languages, np.log(sizes / sizes.sum()), np.full((len(pieces) + 1, len(languages)), 1 / (len(pieces) + 1)))
    for _ in range(rounds):
        counts = _expected(words, model)
        common = counts.sum(1) + 1
        counts += smoothing * (common / common.sum())[:, None]
        model.probability = counts / counts.sum(0)
    return model


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, lang_pred, score): the likeliest language of each whole text and
    its posterior probability; ``und`` and 0 for a text without a letter or
    without a model. Only the text is read."""
    rows = id_and_text(docs, id_col)
    if model is None:
        return rows.select("doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    lattice = Lattice(model.pieces)
    shared = docs.sparkSession.sparkContext.broadcast((model, lattice))  # languages x vocabulary probabilities
    schema = rows.select("doc_id").schema.add("lang_pred", "string").add("score", "double")

    def score(batches):
        model, lattice = shared.value
        known = Runs(model, lattice)
        for batch in batches:
            for part in slices(batch):
                total = np.tile(model.prior, (part.num_rows, 1))
                letters, held, size = np.zeros(part.num_rows, bool), [], 0
                for k, text in enumerate(part.column(1).to_pylist()):
                    for words in runs(text):
                        if words:
                            letters[k] = True
                            held.append((k, words))
                            size += len(words)
                        if size > PART:
                            known.add(total, held)
                            held, size = [], 0
                known.add(total, held)
                best = total.argmax(1)
                score = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
                langs = [model.languages[b] if any_letter else "und" for b, any_letter in zip(best, letters)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(langs, pa.string()), pa.array(np.where(letters, score, 0.0))],
                                                 names=["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(score, schema)


def held_out(id_col: str = "doc_id"):
    """Whether crc32 of the decimal id is 2 modulo 4 (a NULL id is the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def identify_held_out(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document, by a model of
    those that are not held out.

    NULL or empty texts and texts without a letter are ``und``; a language of
    texts without a letter is known by its share alone. Equal texts get equal
    answers. Ties go to the language that is first by name. Repeated and NULL ids
    are rows of their own. Other columns are not read, so names cannot clash. An
    empty table gives an empty result."""
    model = fit(docs.filter(~held_out()).select("text", "lang"), path)
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
