"""Language identification against sums over listed segmentations."""

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from goldenrec.llm import language as L

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
PIECES = ["▁", "▁a", "▁ab", "a", "ab", "b", "ba", "bab", "c", "é"]


def cuts(string):
    """All segmentations, letters outside the vocabulary as single signs."""
    if not string:
        yield ()
    for n in range(1, len(string) + 1):
        if string[:n] in PIECES or n == 1:
            for rest in cuts(string[n:]):
                yield (string[:n], *rest)


def model(rng, languages=2):
    p = np.array([[rng.random() for _ in range(languages)] for _ in range(len(PIECES) + 1)])
    return L.Model(PIECES, [f"l{k}" for k in range(languages)], np.log(np.full(languages, 1 / languages)), p / p.sum(0))


def chance(m, piece, g):
    return m.probability[PIECES.index(piece), g] if piece in PIECES else m.probability[-1, g] / L.STRANGERS


def plain(m, word, g):
    return sum(math.prod(chance(m, p, g) for u in [L.units(word)[0]] for p in cut) for cut in cuts(L.units(word)[0]))


def test_forward_sums_all_segmentations():
    rng = random.Random(1)
    m = model(rng)
    lattice = L.Lattice(PIECES)
    words = sorted({"".join(rng.choice("abcéxß") for _ in range(rng.randint(1, 9))) for _ in range(60)})
    found = L.log_weights(m, lattice, m.weights(lattice), words)
    for k, w in enumerate(words):
        for g in range(2):
            assert found[k, g] == pytest.approx(math.log(plain(m, w, g)), rel=1e-9)


def test_expected_counts_over_all_segmentations(llm_spark):
    rng = random.Random(2)
    m = model(rng)
    rows = [(f"l{g}", "".join(rng.choice("abcéx") for _ in range(rng.randint(1, 7))), rng.randint(1, 5)) for g in range(2) for _ in range(12)]
    rows = [(g, w, sum(r[2] for r in rows if r[:2] == (g, w))) for g, w in {r[:2] for r in rows}]
    got = L._expected(llm_spark.createDataFrame(rows, "lang string, word string, n long"), m)
    want = np.zeros_like(got)
    for lang, word, n in rows:
        g, whole = int(lang[1:]), plain(m, word, int(lang[1:]))
        for cut in cuts(L.units(word)[0]):
            share = math.prod(chance(m, p, g) for p in cut) / whole
            for p in cut:
                want[PIECES.index(p) if p in PIECES else -1, g] += n * share
    assert np.abs(got - want).max() < 1e-3


def test_look_up_over_a_whole_vocabulary():
    pieces = L.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    lattice, known = L.Lattice(pieces), set(pieces)
    assert len(pieces) > 10000 and len(lattice.tables) < 5
    rng = random.Random(3)
    strings = ["▁" + "".join(rng.choice(pieces).strip("▁") for _ in range(5))[:12].ljust(12, "q") for _ in range(300)]
    for n, at in enumerate(lattice.look_up(strings), 1):
        for j in range(len(at)):
            for s, string in enumerate(strings):
                piece = string[j:j + n]
                assert at[j, s] == (pieces.index(piece) if piece in known else lattice.none)


def test_runs_and_units():
    assert list(L.runs("Él 3x½y_z. ́É")) == [["él", "xy", "z", "é"]]
    assert list(L.runs("½ 12 _ . Ⅷ")) == [[]] and list(L.runs("")) == []
    long = "ab " * L.PART
    assert sum(map(len, L.runs(long))) == L.PART
    assert "".join(L.units("x" * 60)) == "▁" + "x" * 60 and max(map(len, L.units("x" * 60))) == L.UNIT + 1


def test_held_out_languages(llm_spark):
    docs = llm_spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = L.identify_held_out(docs, public_tokenizers.path("piece_bpe_32k.model")).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_only_learning_rows_teach(llm_spark, texts):
    """Labels of held-out rows, sources and ids change no answer; text alone does."""
    rng = random.Random(4)
    words = {"xx": ["der", "die", "und", "nicht"], "yy": ["the", "and", "with", "not"]}
    rows = [(k, " ".join(rng.choices(words[g], k=20)), g, "s", None) for k, g in enumerate(rng.choices(["xx", "yy"], k=120))]
    held = lambda k: zlib.crc32(str(k).encode()) % 4 == 2
    path = public_tokenizers.path("piece_bpe_32k.model")
    first = {r.doc_id: (r.lang_pred, r.score) for r in L.identify_held_out(llm_spark.createDataFrame(rows, DOCS), path).collect()}
    changed = [(k, t, "zz" if held(k) else g, "other", 5) for k, t, g, *_ in rows]
    second = {r.doc_id: (r.lang_pred, r.score) for r in L.identify_held_out(llm_spark.createDataFrame(changed, DOCS).repartition(7), path).collect()}
    assert first == second
    assert all(first[r[0]][0] == r[2] for r in rows)


def test_odd_rows(llm_spark, empty):
    path = public_tokenizers.path("piece_bpe_32k.model")
    assert L.identify_held_out(empty, path).count() == 0
    rows = [(1, None, "en"), (1, "", None), (None, "12 ½ !", "en"), (4, "漢字", None), (5, "the the", "en"), (5, "the the", "en"), (6, "le la " * 40000, "fr"),
            (7, "x" * 90000, "fr"), (8, "le la les", "fr"), (9, "with the and", "en")]
    docs = llm_spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(2)).withColumn("lang_pred", F.lit("q")).repartition(3)
    found = sorted(((r.doc_id or 0, r.lang_pred, r.score) for r in L.identify_held_out(docs, path).collect()))
    assert len(found) == len(rows)
    assert [f[1:] for f in found if f[0] <= 1] == [("und", 0.0)] * 3
    assert {f[1] for f in found if f[0] > 3} <= {"en", "fr"}
    assert [f for f in found if f[0] == 5][0] == [f for f in found if f[0] == 5][1]
    nolang = L.identify_held_out(llm_spark.createDataFrame([(1, "a", None)], "doc_id long, text string, lang string"), path).first()
    assert (nolang.lang_pred, nolang.score) == ("und", 0.0)
