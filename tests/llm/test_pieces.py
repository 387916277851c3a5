import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from goldenrec.llm import piece_dropout as D

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return D.Model(PATH)


@pytest.fixture(scope="module")
def samples(texts):
    rng = random.Random(1)
    signs = list("abcdes  rt\n\té漢字😀.,'01▁the")
    return [t or "" for t in texts] + ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(800)]


def brute(model, text, key, rate, seed):
    """The agenda as a plain search: no arrays, no heap, no memory of skips but
    the hash itself."""
    if not text:
        return []
    marked = D.MARK + text.replace(" ", D.MARK)
    drop = D._Drop(D.mix(np.array([key], np.uint64) ^ D.mix(np.full(1, seed, np.uint64))), np.zeros(len(marked), np.int64), np.zeros(len(marked), np.int64), rate)
    spans = [(i, i + 1, int(model.of_sign[ord(c)])) for i, c in enumerate(marked)]
    while True:
        best = None
        for k in range(len(spans) - 1):
            (a, b, x), (_, c, y) = spans[k], spans[k + 1]
            new = model.pairs.get(x << 20 | y) if x >= 0 and y >= 0 else None
            if new is not None and not drop.one(a, b, c) and (best is None or model.rank[new] < model.rank[best[1]]):
                best = (k, new)
        if best is None:
            break
        k, new = best
        spans[k:k + 2] = [(spans[k][0], spans[k + 1][1], new)]
    out = []
    for a, b, x in spans:
        out += [x] if 0 <= x < model.is_piece else [model.byte[bytes([v])] for v in marked[a:b].encode()]
    return out


def test_without_dropout_the_ids_are_the_librarys(model, samples):
    ids, ends = model.encode(samples, np.arange(len(samples)).astype(np.uint64), 0.0, 1)
    want = sentencepiece.SentencePieceProcessor(model_file=PATH).encode(samples)
    assert [list(x) for x in np.split(ids, ends[:-1])] == want


def test_dropout_equals_a_plain_agenda_and_varies(model, samples):
    some = [s for s in samples if len(s) < 300][:150]
    keys = np.arange(len(some)).astype(np.uint64)
    ids, ends = model.encode(some, keys, 0.3, 5)
    got = [list(x) for x in np.split(ids, ends[:-1])]
    assert got == [brute(model, s, k, 0.3, 5) for k, s in enumerate(some)]
    other, _ = model.encode(some, keys, 0.3, 6)
    assert len(other) != len(ids) or (other != ids).any()
    assert [model.decode(x) for x in got] == [s.replace(D.MARK, " ") for s in some]


def test_heap_and_arrays_agree(model, samples, monkeypatch):
    keys = np.arange(len(samples)).astype(np.uint64)
    together, _ = model.encode(samples, keys, 0.2, 1)
    monkeypatch.setattr(D, "LONG", 0)
    assert np.array_equal(together, model.encode(samples, keys, 0.2, 1)[0])


def test_full_dropout_leaves_signs(model):
    ids, _ = model.encode(["the the"], np.zeros(1, np.uint64), 1.0, 1)
    assert model.decode(ids.tolist()) == "the the" and len(ids) == 8


def test_over_a_table(docs, empty, texts, llm_spark):
    found = D.decode(D.encode(docs, PATH), PATH).collect()
    assert {r["doc_id"]: r["decoded"] for r in found} == {3 * k: (t or "").replace(D.MARK, " ") for k, t in enumerate(texts)}
    assert D.decode(D.encode(empty, PATH), PATH).count() == 0
    twice = llm_spark.createDataFrame([(None, "the theme of it all"), (None, "the theme of it all"), (4, None)], "doc_id long, text string")
    rows = D.encode(twice, PATH, dropout=0.5).collect()
    assert rows[0]["ids"] == rows[1]["ids"] and [r["ids"] for r in rows if r["doc_id"] == 4] == [[]]


def test_own_marks_come_back(model, samples):
    """Space marks of the texts are spelled in byte pieces; other texts are cut as ever."""
    some = samples + ["▁", "▁▁ ▁", " ▁", "▁ ", "▁▂▃▄▅ x▁y▁the", "the▁" * 40, "▁" * 300]
    keys = np.arange(len(some)).astype(np.uint64)
    for rate in (0.0, 0.2, 1.0):
        ids, ends = model.encode(some, keys, rate, 3, own_marks=True)
        got = [x.tolist() for x in np.split(ids, ends[:-1])]
        assert [model.decode(x) for x in got] == some
        ids, ends = model.encode(some, keys, rate, 3)
        plain = [x.tolist() for x in np.split(ids, ends[:-1])]
        assert all((a == b) == (D.MARK not in s) for a, b, s in zip(got, plain, some))


def test_query_hashes_the_untouched_text(llm_spark, tmp_path):
    import hashlib

    from goldenrec.llm.queries import op2_sentencepiece_dropout

    own = ["▁▂▃ bars", "a▁b c", "▁", "no mark", "", None]
    llm_spark.createDataFrame(list(enumerate(own)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = op2_sentencepiece_dropout(llm_spark, str(tmp_path)).collect()
    assert {r["doc_id"]: (r["decoded_sha256"], r["lossless"]) for r in rows} == {k: (hashlib.sha256((t or "").encode()).hexdigest(), True) for k, t in enumerate(own)}
