"""Edit distance k and set similarity against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from goldenrec.operators import editjoin as E
from goldenrec.operators import setjoin as S


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def clusters(nodes, linked):
    parent = {v: v for v in nodes}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in linked:
        ra, rb = sorted((root(a), root(b)))
        parent[rb] = ra
    return {v: root(v) for v in nodes}


def edit(rng, s, k, signs):
    for _ in range(k):
        p = rng.randrange(len(s) + 1)
        s = rng.choice([s[:p] + rng.choice(signs) + s[p:], s[:p] + s[p + 1:], s[:p] + rng.choice(signs) + s[p + 1:]])
    return s


def feed(rng, signs, n, longest, prefix=""):
    base = [prefix + "".join(rng.choice(signs) for _ in range(rng.randint(0, longest))) for _ in range(n)]
    return base + [edit(rng, rng.choice(base), rng.randint(1, 4), signs) for _ in range(n)]


@pytest.mark.parametrize("k", [1, 2, 3])
@pytest.mark.parametrize("kind", ["mixed", "short", "crowded"])
def test_all_pairs_by_edit_distance(spark, k, kind):
    rng = random.Random(10 * k + len(kind))
    values = {"mixed": lambda: feed(rng, "abé0", 60, 14), "short": lambda: feed(rng, "ab", 40, 5),
              "crowded": lambda: feed(rng, "01", 50, 5, "customer#") + feed(rng, "abcdefgh", 20, 20)}[kind]()
    df = spark.createDataFrame([(v, 1) for v in values + values[:5] + [None]], "v string, value int")
    got = {r.value: (r.records, r.n_links, r.cluster) for r in E.clusters_within(df, "v", k, crowded=5).collect()}
    distinct = sorted(set(values))
    linked = [(a, b) for a in distinct for b in distinct if a < b and abs(len(a) - len(b)) <= k and distance(a, b) <= k]
    found, all_values = clusters(distinct, linked), values + values[:5]
    assert got == {v: (all_values.count(v), sum(v in p for p in linked), found[v]) for v in distinct}


def test_deletion_forms(spark):
    got = spark.createDataFrame([("abc",), ("",)], "v string").select("v", E.deletions(F.col("v"), 2).alias("f")).collect()
    assert {r.v: sorted(r.f) for r in got} == {"abc": ["a", "ab", "abc", "ac", "b", "bc", "c"], "": [""]}


def test_crowded_segments_meet_in_small_groups(spark):
    """A segment of all values brings together only values that are near."""
    values = spark.createDataFrame([(f"customer#{k * 37 % 100000:05d}",) for k in range(3000)], "value string")
    index, probes = E.segments(values, 2), E.look_ups(values, 2)
    key = ["length", "i", "segment"]
    full = index.groupBy(*key).count().filter("count > 64")
    assert full.agg(F.max("count")).first()[0] == 3000
    split = E._told_apart(index.join(full, key, "left_semi"), 2)
    assert split.groupBy(*key, "before", "after").count().agg(F.max("count")).first()[0] < 120
    assert probes.count() < 30 * 3000


@pytest.mark.parametrize("k, forms", [(1, 8), (2, 0), (2, 60), (3, 100)])
def test_short_and_long_strings_meet(spark, k, forms):
    """Strings on both sides of the length up to which forms are made, and the
    segments alone, against all pairs."""
    rng = random.Random(k + forms)
    values = sorted(set(feed(rng, "ab0", 50, 14) + feed(rng, "01", 40, 5, "customer#")))
    df = spark.createDataFrame([(v,) for v in values], "value string")
    got = sorted(tuple(r) for r in E.edges_within(df, k, crowded=5, forms=forms).collect())
    assert got == sorted((a, b, distance(a, b)) for a in values for b in values
                         if a < b and abs(len(a) - len(b)) <= k < max(len(a), len(b)) and distance(a, b) <= k)


@pytest.mark.parametrize("forms", [0, 400])
def test_forms_are_never_broadcast(spark, monkeypatch, forms):
    """A small file of strings is many rows of forms, which a broadcast would
    bring to the driver."""
    plans = []

    def kept(df, *parts):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return materialize(df, *parts)

    materialize = E.materialize
    monkeypatch.setattr(E, "materialize", kept)
    values = spark.createDataFrame([(f"customer#{k * 37 % 10000:04d}",) for k in range(300)], "value string")
    plans.append(E.edges_within(values, 2, forms=forms)._jdf.queryExecution().executedPlan().toString())
    broadcast = [part for plan in plans for part in plan.split("BroadcastExchange")[1:]]
    assert any("Generate explode" in plan for plan in plans) and not any("Generate explode" in part.split("Join")[0] for part in broadcast)


def test_forms_are_made_once_and_few(spark):
    """Forms are one exchange for both sides, cut by the rows that are made, and
    the rows grow with the strings, not with what they share."""
    rows = spark.createDataFrame([(k, f"{k * 7919 % 100000:05d}" + "a" * (k % 2)) for k in range(400)], "id long, value string")
    counts = dict(rows.groupBy(F.length("value")).count().collect())
    found = E.meet_on_forms(rows, 2, counts)
    assert found.filter("a >= b").count() == 0 and found.groupBy("a", "b").count().filter("count > 1").count() == 0
    plan = found._jdf.queryExecution()
    found.collect()
    assert "ReusedExchange" in plan.executedPlan().toString() and "BroadcastHashJoin" not in plan.executedPlan().toString()
    assert E._lost(12, {11, 12}, 3) == [3] and E._lost(11, {11, 12}, 3) == [2, 3] and E._lost(1, {1, 2}, 3) == []


def test_few_rows_a_string(spark, monkeypatch):
    """A reference of 12 signs makes 66 forms within two edits where a shared
    segment made 471 rows; no segment is indexed."""
    monkeypatch.setattr(E, "segments", None)
    monkeypatch.setattr(E, "look_ups", None)
    rng, made, meet = random.Random(3), [], E.meet_on_forms
    monkeypatch.setattr(E, "meet_on_forms", lambda values, k, counts: made.append((k, counts)) or meet(values, k, counts))
    base = ["".join(rng.choice("0123456789abcdef") for _ in range(12)) for _ in range(100)]
    values = spark.createDataFrame([(v,) for v in base + [v[:5] + v[6:] for v in base[::2]]], "value string")
    assert E.clusters_within(values, "value", 2, crowded=1).filter("n_links > 0").count() == 100
    (k, counts), = made
    assert counts == {12: 100, 11: 50} and E._lost(12, set(counts), k) == [2] and E._lost(11, set(counts), k) == [1, 2]


def test_golden_reference_of_near_values(spark, monkeypatch):
    """One golden reference a cluster, over forms alone, as over all pairs."""
    from goldenrec.plans import catalog_linkage as c
    from shared_fixtures import SF0001

    monkeypatch.setattr(E, "segments", None)
    values = [r.value for r in c.references(spark, SF0001).collect()]
    distinct = sorted(set(values))
    found = clusters(distinct, [(a, b) for a in distinct for b in distinct if a < b and abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2])
    got = {r.unique_identifier: (r.repetition, r.value) for r in c.q_golden_near_references(spark, SF0001).collect()}
    want = {root: [v for v in distinct if found[v] == root] for root in found.values()}
    assert got == {root: (sum(values.count(v) for v in vs), min(vs, key=lambda v: (-values.count(v), v))) for root, vs in want.items()}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def gram_set(row, q=3):
    return frozenset(f"{k}:{t[p:p + q]}" for k, v in enumerate(row) if v and (t := v.strip().lower()) for p in range(max(len(t) - q + 1, 1)))


@pytest.mark.parametrize("crowded", [3, 64])
@pytest.mark.parametrize("threshold", [0.6, 0.8])
def test_all_pairs_by_set_similarity(spark, threshold, crowded):
    rng = random.Random(5)
    words = ["Limited", "Company", "Steel Works", "Boston", "Austin", "North", "and Sons", "Ünited"]
    rows = [(k, " ".join(rng.choices(words, k=rng.randint(1, 4))), rng.choice(["Boston", "Austin", None, "  "])) for k in range(120)]
    rows += [(200 + k, edit(rng, rows[k][1], 1, "xyz"), rows[k][2]) for k in range(60)] + [(300, None, ""), (301, None, None), (302, "a", None), (303, "A ", None)]
    got = {r.id: (r.copies, r.n_links, r.cluster) for r in
           S.similar_records(spark.createDataFrame(rows, "key long, cluster string, city string"), "key", ("cluster", "city"), threshold, crowded=crowded).collect()}
    sets = {k: gram_set(r) for k, *r in rows}
    linked = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and jaccard(sets[a], sets[b]) >= threshold]
    found = clusters(sorted(sets), linked)
    want = {k: (max(1, sum(bool(s) and t == s for t in sets.values())), sum(k in p for p in linked), found[k]) for k, s in sets.items()}
    assert got == want


def test_rarest_tokens_first_and_short_prefixes(spark):
    rows = [(k, f"common name {k:04d}") for k in range(300)]
    sets = spark.createDataFrame(rows, "rep long, t string").select("rep", S.grams(("t",)).alias("grams"))
    ranked = S.ranked_sets(sets).collect()
    assert all("0:" + r.tokens[0][2:] == r.tokens[0] and "com" not in r.tokens[0] for r in ranked)
    plan = S.similar_sets(sets, 0.8)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_empty_tables(spark):
    assert E.clusters_within(spark.createDataFrame([], "v string"), "v", 2).count() == 0
    assert S.similar_records(spark.createDataFrame([], "id long, t string"), "id", ("t",)).count() == 0
    with pytest.raises(ValueError):
        E.clusters_within(spark.createDataFrame([], "v string"), "v", 0)
