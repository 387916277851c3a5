import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from goldenrec.llm import packing
from goldenrec.llm.packing import differencing, pack, windows
from goldenrec.llm.token_counts import token_counts
from goldenrec.llm.transducer import FRESH, Transducer, character_classes, compose_scan, piece_begins

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def machine():
    return Transducer(PATH)


def same(machine, library, texts):
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    ids, ends = machine.encode(texts)
    assert [list(x) for x in np.split(ids, ends[:-1])] == want
    assert machine.count(texts).tolist() == [len(x) for x in want]


def test_fixture_and_random_texts_equal_the_library(machine, library, texts):
    rng = random.Random(1)
    signs = "abcdesrtvmld'' \n\t  !?.,0127éß漢字ي́½Ⅷ😀\r\x1c\x85​"
    same(machine, library, [t or "" for t in texts])
    same(machine, library, ["".join(rng.choices(signs, k=rng.randint(0, 40))) for _ in range(3000)])
    same(machine, library, ["".join(rng.choices("theanrisx", k=rng.randint(0, 60))) for _ in range(1000)])


def test_every_third_code_point_is_classed_as_the_library_does(machine, library):
    points = [chr(i) for i in range(0x30000) if not 0xD800 <= i < 0xE000][::3]
    same(machine, library, [f"a{c}1{c}a {c}!{c}" for c in points])


def test_scan_of_chunk_maps_equals_one_pass():
    kinds = character_classes()[np.frombuffer(("it's  a\n\ntest 'll " * 400).encode("utf-32-le"), np.uint32)]
    assert len(kinds) > 4 * 256
    import goldenrec.llm.transducer as T

    whole, chunk = piece_begins(kinds), T.CHUNK
    try:
        T.CHUNK = len(kinds)
        assert np.array_equal(whole, piece_begins(kinds))
    finally:
        T.CHUNK = chunk
    maps = np.random.default_rng(0).integers(0, 11, (37, 11)).astype(np.uint8)
    state, scan = FRESH, compose_scan(maps)
    for k in range(37):
        state = maps[k][state]
        assert scan[k][FRESH] == state


def test_a_table_that_is_begun_anew_changes_nothing(library):
    small = Transducer(PATH)
    small.MOST_STATES, small.WIDTH = 1 << 11, 256
    small._begin()
    rng = random.Random(3)
    same(small, library, ["".join(rng.choices("theanris", k=rng.randint(1, 300))) for _ in range(60)] + ["q" * 5000])


def test_counts_over_a_table(docs, empty, library, texts):
    want = {3 * k: len(library.encode(t or "", add_special_tokens=False).ids) for k, t in enumerate(texts)}
    rows = token_counts(docs.withColumnRenamed("lang", "n_tokens"), PATH).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == want
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in rows)
    assert {r["doc_id"]: r["n_bytes"] for r in rows} == {3 * k: len((t or "").encode()) for k, t in enumerate(texts)}
    assert token_counts(empty, PATH).count() == 0


def test_repeated_and_null_ids_keep_their_rows(llm_spark):
    df = llm_spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    assert sorted((r[0] is None, r[2]) for r in token_counts(df, PATH).collect()) == [(False, 2), (False, 2), (True, 1)]


def test_differencing_balances_and_windows_rise():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 500, 300)
    slot = differencing(sizes, 20)
    loads = np.bincount(slot, sizes, 20)
    assert loads.sum() == sizes.sum() and loads.max() - loads.min() < 30
    assert differencing(np.array([8, 7, 6, 5, 4]), 2).tolist() != [] and set(np.bincount(differencing(np.array([8, 7, 6, 5, 4]), 2), [8, 7, 6, 5, 4]).tolist()) == {14, 16}
    for sizes in (np.array([1500] * 5), rng.integers(1, 2049, 40), np.array([2048, 1])):
        loads = np.bincount(windows(sizes, 2048), sizes)
        assert loads.max() <= 2048


def test_packing_covers_every_id_once(docs, empty, library, texts):
    rows = pack(docs, PATH, group=32).collect()
    ids = {3 * k: [*library.encode(t or "", add_special_tokens=False).ids, 1] for k, t in enumerate(texts)}
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        own = ids[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(own) == r["length"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(ids)
    for doc, own in pieces.items():
        at = 0
        for start, length in sorted(own):
            assert start == at
            at += length
        assert at == len(ids[doc])
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert pack(empty, PATH).count() == 0
    assert packing.SCHEMA.startswith("start long")


def test_little_padding(llm_spark):
    docs = llm_spark.read.parquet("/root/testdata/sf0.01/documents.parquet").coalesce(1)
    total, n = pack(docs, PATH).selectExpr("sum(length)", "count(distinct sequence_id)").first()
    assert total / (2048 * n) > 0.98
