"""Near-duplicate clusters against brute force (all pairs, Python
Levenshtein, union-find) on small generated fixtures."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from goldenrec.operators import neardup


def lev(a: str, b: str) -> int:
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def brute_clusters(values):
    vals = sorted(set(values))
    parent = {v: v for v in vals}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, a in enumerate(vals):
        for b in vals[i + 1:]:
            if lev(a, b) == 1:
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {v: min((w for w in vals if find(w) == find(v))) for v in vals}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="abc", min_size=1, max_size=4), min_size=1, max_size=30))
def test_clusters_match_brute_force(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "name string")
    got = {r["value"]: r["cluster"] for r in neardup.near_duplicate_clusters(df, "name").collect()}
    assert got == brute_clusters(values)


def test_edges_are_exactly_distance_one(spark):
    vals = ["anna", "ana", "anne", "hanna", "bob", "bobb", "rob", "xyz"]
    nodes = spark.createDataFrame([(v,) for v in vals], "value string")
    edges = {(r["a"], r["b"]) for r in neardup.neighbour_edges(nodes).collect()}
    assert all(lev(a, b) == 1 for a, b in edges)
    got = {r["value"]: r["cluster"] for r in neardup.near_duplicate_clusters(
        spark.createDataFrame([(v,) for v in vals + ["anna", None]], "name string"), "name").collect()}
    assert got == brute_clusters(vals)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    """Each value is one letter longer than the one before: rounds grow with
    the logarithm of the chain, not with its length."""
    from goldenrec.operators import components as c

    rounds = []
    monkeypatch.setattr(c, "_least", lambda e, far, f=c._least: rounds.append(far) or f(e, far))
    values = ["a" * n for n in range(1, 65)]
    got = neardup.near_duplicate_clusters(spark.createDataFrame([(v,) for v in values], "name string"), "name").collect()
    assert {r["cluster"] for r in got} == {"a"} and len(got) == 64 and len(rounds) <= 20
