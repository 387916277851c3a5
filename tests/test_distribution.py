"""Frequent values and quantiles against plain counts."""

import random
from bisect import bisect_left, bisect_right
from collections import Counter

import pytest

from goldenrec.operators import distribution as D


def plain(rows, names, share):
    return {(c, v, n, len(rows)) for j, c in enumerate(names) for v, n in Counter(r[j] for r in rows).items()
            if v is not None and n >= share * len(rows)}


@pytest.mark.parametrize("share", [0.5, 0.05, 0.01, 0.002])
def test_frequent_values_are_exact(spark, share):
    """Hot values, a long tail of single ones, NULLs, blanks, long values, and
    columns named like those of the result."""
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", "", None, "x" * 5000]) if rng.random() < 0.4 else f"tail {k}", f"v{int(rng.paretovariate(0.7)) % 5000}", None)
            for k in range(6000)]
    rng.shuffle(rows)
    names = ("value", "rows", "column_name")
    df = spark.createDataFrame(rows, "value string, rows string, column_name string").repartition(7)
    got = [tuple(r) for r in D.frequent_values(df, share=share).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows, names, share)


def test_a_value_at_the_very_share(spark):
    """Values that hold just the share stay, the next below it does not, in many passes."""
    rows = [(f"k{v}",) for v in range(10) for _ in range(100)]
    df = spark.createDataFrame(rows[:-1] + [("other",)], "k string").repartition(5)
    got = {r.value: r.rows for r in D.frequent_values(df, share=0.1).collect()}
    assert got == {f"k{v}": 100 for v in range(9)}


def test_wide_tables_and_other_types(spark, monkeypatch):
    monkeypatch.setattr(D.settings, "PROFILE_COLUMNS_PER_PASS", 2)
    df = spark.createDataFrame([(1, True, 2.5), (1, False, None), (2, True, 2.5)], "a int, b boolean, c double")
    got = {(r.column_name, r.value, r.rows) for r in D.frequent_values(df, share=0.5).collect()}
    assert got == {("a", "1", 2), ("b", "true", 2), ("c", "2.5", 2)}
    assert {(r.column_name, r.value) for r in D.column_quantiles(df, at=(0.5,)).collect()} == {("a", 1.0), ("c", 2.5)}


def test_quantiles_within_their_bound(spark):
    rng = random.Random(8)
    values = [rng.choice([rng.gauss(0, 1), 0.0, rng.expovariate(1)]) for _ in range(20000)]
    df = spark.createDataFrame([(v, k) for k, v in enumerate(values)] + [(None, None)] * 50, "v double, k long").repartition(9)
    ordered, error = sorted(values), 1 / 100
    for r in D.column_quantiles(df, ("v",), accuracy=100).collect():
        lo, hi = bisect_left(ordered, r.value), bisect_right(ordered, r.value)
        assert lo <= (r.quantile + error) * len(values) + 1 and hi >= (r.quantile - error) * len(values) - 1


def test_empty_and_wrong_input(spark):
    empty = spark.createDataFrame([], "a string, n long")
    assert D.frequent_values(empty).collect() == []
    assert {r.value for r in D.column_quantiles(empty).collect()} == {None}
    with pytest.raises(ValueError):
        D.frequent_values(empty, share=0)
    with pytest.raises(ValueError):
        D.column_quantiles(empty.select("a"))
