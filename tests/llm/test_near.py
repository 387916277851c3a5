import random
import time
import re

import numpy as np
import pytest
import xxhash

from goldenrec.llm import cover_tree as C
from goldenrec.llm import simhash as S
from goldenrec.operators.components import components


def least_labels(n, pairs):
    label = list(range(n))
    while True:
        new = label[:]
        for a, b in pairs:
            new[a] = new[b] = min(new[a], new[b])
        if new == label:
            return label
        label = new


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_components_of_chains_stars_and_loops(llm_spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (3, 2), (None, 4)]
    edges += [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    rows = components(llm_spark.createDataFrame(edges, "u long, v long").repartition(4)).collect()
    label = least_labels(300, [e for e in edges if None not in e])
    assert {r["node"]: r["root"] for r in rows} == {k: label[k] for k in range(300) if label[k] != k}
    assert components(llm_spark.createDataFrame([], "u long, v long")).count() == 0


def test_golay_code_is_perfect():
    begin, pattern, excess = S.offsets(2)
    assert len(begin) == 2049 and all((excess[begin[s]:begin[s + 1]] == 0).sum() == 1 for s in range(2048))
    words = np.random.default_rng(0).integers(0, 1 << 23, 500)
    s = S.syndromes(words)
    assert (S.syndromes(words ^ pattern[begin[s]]) == 0).all()


@pytest.fixture(scope="module")
def family():
    rng = np.random.default_rng(0)

    def flip(x, k):
        x = x.copy()
        for i in range(len(x)):
            for bit in rng.choice(64, k, replace=False):
                x[i] ^= np.uint64(1 << int(bit))
        return x

    base = rng.integers(0, 2 ** 63, 300, dtype=np.uint64)
    dense = np.concatenate([flip(np.repeat(base[:1], 400), k) for k in (1, 2, 3)])
    return np.unique(np.concatenate([base, flip(base, 1), flip(base, 2), flip(base, 3), dense]))


def brute_pairs(fps):
    return [(i, i + 1 + int(j)) for i in range(len(fps)) for j in np.flatnonzero(S.distance(fps[i:i + 1], fps[i + 1:]) <= 2)]


def test_anchor_links_connect_what_pairs_connect(family, llm_spark):
    index, anchor = S.anchors(family, 2)
    order = np.argsort(anchor, kind="stable")
    place = {int(f): k for k, f in enumerate(family)}
    u, v = S._edges(anchor[order], family[index][order], 2)
    label = least_labels(len(family), brute_pairs(family))
    assert least_labels(len(family), [(place[int(a)], place[int(b)]) for a, b in zip(u, v)]) == label
    frame = llm_spark.createDataFrame([(int(f),) for f in family.view(np.int64)], "fp long").repartition(5)
    rows = S.links(frame).collect()
    assert least_labels(len(family), [(place[r["u"] % 2 ** 64], place[r["v"] % 2 ** 64]) for r in rows]) == label


def test_large_anchor_equals_all_pairs(family):
    dense = family[S.distance(family, np.repeat(family[:1], len(family))) >= 0]
    assert S._link_large(dense, 2).tolist() == least_labels(len(dense), brute_pairs(dense))


def test_dense_and_sparse_ways_agree(family, monkeypatch):
    free = (family >> np.uint64(2 * S.LENGTH)).astype(np.int64)
    flips = np.array([0, *(1 << k for k in range(18)), *((1 << a) | (1 << b) for a in range(18) for b in range(a))])
    want = least_labels(len(family), brute_pairs(family))
    assert S._link_dense(family, free, flips, 2).tolist() == want
    monkeypatch.setattr(S, "FEW", 1 << 30)  # never dense
    assert S._link_large(family, 2).tolist() == want


def test_fifty_thousand_members_at_one_anchor():
    """Unrelated members, chains and a dense family; links as planted."""
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 2 ** 63, 50_000, dtype=np.uint64))
    near = base[:5000] ^ (np.uint64(1) << rng.integers(0, 63, 5000, dtype=np.uint64))
    far = near[:2500] ^ (np.uint64(1) << rng.integers(0, 63, 2500, dtype=np.uint64))
    members = np.concatenate([base, near, far])
    begun = time.perf_counter()
    label = S._link_large(members, 2)
    assert time.perf_counter() - begun < 60
    assert (label[len(base):len(base) + 5000] == label[:5000]).all() and (label[len(base) + 5000:] == label[:2500]).all()
    assert len(np.unique(label)) == len(base)  # random 63-bit values have no near pair


def test_a_long_text_is_summed_in_blocks(monkeypatch):
    text = " ".join(f"w{k % 977} x{k % 31}" for k in range(20_000)).encode()
    whole = S.fingerprint(text, 3)
    monkeypatch.setattr(S, "BLOCK", 1000)
    assert S.fingerprint(text, 3) == whole


def test_simhash_over_a_table(docs, empty, texts, llm_spark):
    fps = [slow_fingerprint(t) for t in texts]
    pairs = [(a, b) for a in range(len(fps)) for b in range(a) if bin(fps[a] ^ fps[b]).count("1") <= 2]
    label = least_labels(len(fps), pairs)
    rows = S.near_duplicates(docs.withColumnRenamed("lang", "component_id").withColumnRenamed("source", "fp")).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == {3 * k: (f"{fps[k]:016x}", 3 * label[k]) for k in range(len(fps))}
    assert S.near_duplicates(empty).count() == 0
    kept = S.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted({3 * x for x in label})


def test_simhash_without_ids_and_with_repeated_rows(llm_spark):
    df = llm_spark.createDataFrame([(None, "same text here now"), (9, "same text here now"), (9, "same text here now"), (None, "alone in the world")], "doc_id long, text string")
    rows = S.near_duplicates(df).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in rows) == [(0, 0), (0, 9), (9, 9), (9, 9)]
    assert sorted((r["doc_id"] or 0) for r in S.drop_near_duplicates(df).collect()) == [0, 0, 9]


# --- embeddings -------------------------------------------------------------


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 12))
    x = np.concatenate([centres, centres[rng.integers(0, 60, 200)] + rng.normal(size=(200, 12)) * rng.choice([0.02, 0.2, 0.35], (200, 1)),
                        centres[:1] + rng.normal(size=(150, 12)) * 0.1])
    return [row.astype(np.float32).tolist() for row in x]


def slow_links(vectors, least=0.9):
    x = np.array(vectors, np.float64)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x @ x.T >= least


def test_cover_tree_over_a_table(llm_spark, vectors):
    rows = [(5 * k, v, 0) for k, v in enumerate(vectors)]

    odd = [(10_000, None, 0), (10_001, [], 0), (10_002, [0.0] * 12, 0), (10_003, [float("nan")] * 12, 0), (10_004, [float("inf")] + [1.0] * 11, 0),
           (10_005, [None] + [1.0] * 11, 0), (10_006, [1.0, 0.0], 0), (10_007, [2.0, 0.0], 0)]
    copies = [(20_000 + k, vectors[k], 0) for k in (0, 0, 7)]
    frame = llm_spark.createDataFrame(rows + odd + copies, "vec_id long, embedding array<float>, n_links int").repartition(5)
    near = slow_links(vectors + [vectors[0], vectors[0], vectors[7]])
    ids = [r[0] for r in rows] + [c[0] for c in copies]
    label = least_labels(len(ids), [(a, b) for a, b in zip(*np.nonzero(near)) if a < b])
    want = {i: (int(near[k].sum()) - 1, ids[label[k]]) for k, i in enumerate(ids)}
    want |= {o[0]: (0, o[0]) for o in odd[:6]} | {10_006: (1, 10_006), 10_007: (1, 10_006)}
    for leaf in (8192, 60):  # one cell; many cells, parts and shares
        found = {r["vec_id"]: r for r in C.near_duplicates(frame, leaf=leaf).collect()}
        assert {i: (r["n_links"], r["component_id"]) for i, r in found.items()} == want
        assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found.values())
    assert C.near_duplicates(frame.limit(0)).count() == 0


def test_cells_parted_over_levels(llm_spark, monkeypatch):
    """A dense family and a loose one far over ``leaf``, multiples of one vector with
    one outlier, and stray vectors: many levels, whole cells, visitors of them."""
    rng = np.random.default_rng(9)
    centre = rng.normal(size=(2, 8))
    line = np.outer(np.arange(1, 61), rng.normal(size=8))
    x = np.concatenate([centre[:1] + rng.normal(size=(150, 8)) * 0.02, centre[1:] + rng.normal(size=(150, 8)) * 0.4, line, -line[:1], rng.normal(size=(80, 8))])
    near, levels, part = slow_links(x), [], C._part
    label = least_labels(len(x), [(a, b) for a, b in zip(*np.nonzero(near)) if a < b])

    def counted(*given):
        levels.append(given[6])
        return part(*given)

    monkeypatch.setattr(C, "_part", counted)
    monkeypatch.setattr(C, "FAN", 4)
    frame = llm_spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    rows = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in C.near_duplicates(frame, leaf=40).collect()}
    assert rows == {k: (int(near[k].sum()) - 1, label[k]) for k in range(len(x))}
    assert len(levels) > 2


def test_threshold_is_exact(llm_spark):
    def at(cosine):
        return [cosine, float(np.sqrt(1 - cosine ** 2))]

    frame = llm_spark.createDataFrame([(1, [3.0, 0.0]), (2, at(0.9 + 1e-9)), (3, [7 * v for v in at(0.9 - 1e-9)])], "vec_id long, embedding array<double>")
    rows = {r["vec_id"]: r["n_links"] for r in C.near_duplicates(frame).collect()}
    assert rows == {1: 1, 2: 2, 3: 1}


def test_null_ids(llm_spark):
    frame = llm_spark.createDataFrame([(None, [1.0, 0.0]), (4, [1.0, 0.01]), (None, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert sorted(((r["vec_id"] or 0), r["n_links"], r["component_id"] or 0, r["kept"]) for r in C.near_duplicates(frame).collect()) == [
        (0, 0, 0, False), (0, 1, 4, False), (4, 1, 4, True)]


def test_rows_dealt_grow_with_the_vectors_not_with_the_cells(llm_spark, monkeypatch):
    """Vectors without structure: every cell is in reach of every other."""
    x = np.random.default_rng(4).normal(size=(1200, 48)).astype(np.float32)
    x[600:640] = x[:40] + 0.01
    near, dealt, plans, shares, kept, pairs = slow_links(x), [], [], C._in_shares, C.materialize, C._pairs
    label = least_labels(len(x), [(a, b) for a, b in zip(*np.nonzero(near)) if a < b])

    def counted_shares(rows, *given):
        dealt.append(rows.count())
        return shares(rows, *given)

    def counted_tables(rows, *given):
        table = kept(rows, *given)
        dealt.append(table.count())
        return table

    def explained(*given):
        met = pairs(*given)
        plans.append(met._jdf.queryExecution().executedPlan().toString())
        return met

    monkeypatch.setattr(C, "_in_shares", counted_shares)
    monkeypatch.setattr(C, "materialize", counted_tables)
    monkeypatch.setattr(C, "_pairs", explained)
    frame = llm_spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(3)
    rows = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in C.near_duplicates(frame, leaf=60).collect()}
    assert rows == {k: (int(near[k].sum()) - 1, label[k]) for k in range(len(x))}
    assert sum(dealt) < 15 * len(x)
    assert "hashpartitioning" not in plans[0]


def test_cells_that_link_as_a_whole(llm_spark, monkeypatch):
    """Two tight families near each other, a third beside the second only, all in
    many cells and parts; strays; another dimension."""
    rng = np.random.default_rng(6)
    at = np.array([0.0, 0.3, 0.65])
    centre = np.stack([np.cos(at), np.sin(at), *np.zeros((4, 3))], axis=1)
    x = np.concatenate([np.repeat(centre, 90, axis=0) + rng.normal(size=(270, 6)) * 0.003, rng.normal(size=(80, 6))])
    near, whole, cells = slow_links(x), [], C._whole_cells
    label = least_labels(len(x), [(a, b) for a, b in zip(*np.nonzero(near)) if a < b])

    def counted(*given):
        links = cells(*given)
        whole.append(links[0].count())
        return links

    monkeypatch.setattr(C, "_whole_cells", counted)
    monkeypatch.setattr(C, "FAN", 8)
    flat = [(1000 + k, [1.0, 0.001 * k]) for k in range(3)]
    frame = llm_spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)] + flat, "vec_id long, embedding array<double>").repartition(3)
    rows = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in C.near_duplicates(frame, leaf=30).collect()}
    assert rows == {k: (int(near[k].sum()) - 1, label[k]) for k in range(len(x))} | {k: (2, 1000) for k, _ in flat}
    assert whole[0] > 0


def test_vectors_that_share_a_hash(llm_spark, monkeypatch):
    given = [(1, [1.0, 0.0]), (2, [1.0, -0.0]), (3, [0.0, 1.0]), (4, [3.0, 0.0]), (5, [-1.0, 0.0])]
    frame = llm_spark.createDataFrame(given, "vec_id long, embedding array<float>")
    want = {1: (2, 1), 2: (2, 1), 3: (0, 3), 4: (2, 1), 5: (0, 5)}
    for key in (C._key, lambda v: C.F.lit(7).cast("long")):
        monkeypatch.setattr(C, "_key", key)
        assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in C.near_duplicates(frame).collect()} == want
