"""Identities over several keys against union-find."""

import random

import pytest

from goldenrec.operators import linkage as K

SCHEMA = "id long, email string, phone string, tax string"
KEYS = {"email": "email", "phone": "phone", "tax": "tax"}


def union_find(records):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for k, (rid, *values) in enumerate(records):
        me = ("id", rid) if rid is not None else ("row", k)
        root(me)
        for name, v in zip(KEYS, values):
            if v is not None and v.strip():
                parent[root(me)] = root((name, v.strip()))
    least = {}
    for k, (rid, *_) in enumerate(records):
        r = root(("id", rid) if rid is not None else ("row", k))
        if rid is not None:
            least[r] = min(least.get(r, rid), rid)
    return {(rid, least.get(root(("id", rid) if rid is not None else ("row", k)))) for k, (rid, *_) in enumerate(records)}


def result(df):
    rows = [tuple(r) for r in df.select("id", "identity").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def feed(rng, n, values):
    pick = lambda p: f"{p}{rng.randrange(values)}" if rng.random() < 0.5 else None
    return [(k, pick("e"), pick("p"), pick("t")) for k in range(n)]


@pytest.mark.parametrize("seed,n,values", [(1, 40, 60), (2, 120, 200), (3, 200, 90)])
def test_random_feeds(spark, seed, n, values):
    records = feed(random.Random(seed), n, values)
    assert result(K.link_records(spark.createDataFrame(records, SCHEMA), "id", KEYS)) == union_find(records)


def test_chain_blanks_equal_texts_of_other_keys_and_odd_ids(spark):
    records = [(1, "a", None, None), (2, "a", "7", None), (3, None, "7 ", "t"), (4, " ", None, ""), (5, None, None, None), (6, "t", None, "a"),
               (7, None, "7", None), (8, "q", None, None), (8, None, "88", None), (9, None, "88", None), (None, "q", None, None), (None, "zz", None, None)]
    got = result(K.link_records(spark.createDataFrame(records, SCHEMA), "id", KEYS))
    assert {i: d for i, d in got if i is not None} == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 1, 8: 8, 9: 8}
    assert got == union_find(records)


def test_long_chain_and_hot_value(spark):
    chain = [(k, f"e{k}", f"e{k + 1}", None) for k in range(60)]
    chain = [(k, f"m{k // 2}", f"m{(k + 1) // 2}x", None) for k in range(80)]
    hot = [(1000 + k, f"h{k}", "000-000", None) for k in range(3000)] + [(5000 + k, f"h{k}", None, None) for k in range(50)]
    df = spark.createDataFrame(chain + hot, SCHEMA)
    assert result(K.link_records(df, "id", KEYS)) == union_find(chain + hot)
    crowded = K.crowded_keys(K.key_values(df, "id", KEYS), most=100).collect()
    assert [tuple(r) for r in crowded] == [("phone:000-000", 3000)]


def test_empty(spark):
    assert K.link_records(spark.createDataFrame([], SCHEMA), "id", KEYS).count() == 0


@pytest.mark.parametrize("runs", [1, 4])
def test_kept_between_runs(spark, tmp_dir, runs):
    records = feed(random.Random(6), 160, 110)
    store = K.LinkStore(f"{tmp_dir}/links", "id", KEYS)
    for run in range(runs):
        part = spark.createDataFrame([r for r in records if r[0] % runs == run], SCHEMA)
        store.add(part, run)
        if run == runs - 1:
            store.add(part, run)  # replayed
    df = spark.createDataFrame(records, SCHEMA)
    assert result(store.link(df, runs - 1)) == union_find(records)
    with_key = {r[0] for r in records if any(r[1:])}
    found = store.identities(spark, runs - 1).collect()
    assert sum(r.records for r in found) == len(with_key)
    assert {r.identity for r in found} == {i for r, i in union_find(records) if r in with_key}
    with pytest.raises(ValueError, match="cannot follow"):
        store.add(df, runs + 3)
