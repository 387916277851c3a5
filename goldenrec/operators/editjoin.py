"""Near-equal strings within an edit distance k (G9), exactly.

If two strings are within k edits and the longer has m signs, they have a common
form of m - k signs: the longer loses k signs, the shorter the rest. So strings
are joined on the hashes of such forms, only for lengths that the table holds,
and candidates are verified. A string makes a number of rows that depends on its
length alone, so the join grows with the table, whatever its strings share.

Long strings have too many forms. If two strings are within k edits and the
shorter is cut into k + 1 segments, some segment stands in the longer one
unchanged. More than that: some segment i (from 1) stands there with at most
i - 1 edits before it and k + 1 - i after it. So the segments of every long
string are an index on (length, i, segment), and a string looks up, for each
length from its own down to k less, only the few substrings whose place fits
those bounds. Candidates are verified.

A segment that very many strings share ("customer#") would bring them all
together. Its strings are told apart by the rest: within i - 1 edits, what
stands before the segment has a common form after i - 1 deletions on each side,
and the same holds after it, so crowded segments are joined on such deletion
forms as well. Nothing is capped and no link is lost.

Strings of at most k signs are all within k of each other; they are linked to
the least of them.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldenrec.operators.components import components
from goldenrec.session import materialize

#: Strings that a segment may bring together before it counts as crowded.
CROWDED = 64

#: Deletion forms of a string up to which it is joined on them.
FORMS = 400

#: Rows that one task makes, sorts and joins.
TASK_ROWS = 1_500_000


def _less(v: Column, e: int) -> Column:
    """The forms of a string after exactly ``e`` deletions, repeats included."""
    def rest(done: Column, at: Column, left: int) -> Column:
        places = F.when(at + (left - 1) <= F.length(v), F.sequence(at, F.length(v) - (left - 1))).otherwise(F.array().cast("array<int>"))
        if left == 1:
            return F.transform(places, lambda p: F.concat(done, F.substring(v, at, p - at), F.substr(v, p + 1)))
        return F.flatten(F.transform(places, lambda p: rest(F.concat(done, F.substring(v, at, p - at)), p + 1, left - 1)))

    return rest(F.lit(""), F.lit(1), e) if e else F.array(v)


def deletions(c: Column, most: int) -> Column:
    """All distinct forms of a string after up to ``most`` deletions of a sign."""
    return F.array_distinct(F.concat(*(_less(c, e) for e in range(most + 1))))


def _lost(length: int, lengths: set[int], k: int) -> list[int]:
    """Numbers of signs that strings of ``length`` lose to meet those of
    ``lengths``; an empty form is none."""
    return sorted({min(k, k - other + length) for other in lengths if abs(other - length) <= k and max(other, length) > k})


def meet_on_forms(values: DataFrame, k: int, counts: dict[int, int]) -> DataFrame:
    """(a, b), distinct, of the ids of ``values`` (id, value) that have a common
    form; ``counts``: their rows by length. Forms are hashed to 48 bits."""
    lost = {length: _lost(length, set(counts), k) for length in counts}
    made = sum(n * sum(comb(length, e) for e in lost[length]) for length, n in counts.items())
    # Both sides are one exchange. The merge join is asked for since Spark takes
    # the forms of a small table to be as small, and would broadcast them.
    tasks = max(int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-made // TASK_ROWS))
    of = [[length for length in counts if e in lost[length]] for e in range(k + 1)]
    found = F.concat(*(F.when(F.length("value").isin(of[e]), _less(F.col("value"), e)).otherwise(F.array().cast("array<string>"))
                       for e in range(k + 1) if of[e])) if any(of) else F.array().cast("array<string>")
    hashes = F.array_distinct(F.transform(found, lambda form: F.xxhash64(form).bitwiseAND(F.lit((1 << 48) - 1))))
    rows = values.repartition(tasks, "id").select("id", F.explode(hashes).alias("form")).repartition(tasks, "form")
    left, right = rows.withColumnRenamed("id", "a"), rows.withColumnRenamed("id", "b")
    return left.hint("merge").join(right, "form").filter("a < b").select("a", "b").distinct()


def _segment(length: Column, i: Column, k: int) -> tuple[Column, Column]:
    """(first sign, size) of segment i of a string cut into k + 1 even parts, the
    longer ones last."""
    n = F.lit(k + 1)
    base = F.floor(length / n).cast("int")
    longer = (length % n).cast("int")
    start = F.lit(1) + base * (i - 1) + F.greatest(F.lit(0), longer - (n - i + 1))
    return start.cast("int"), (base + F.when(longer >= n - i + 1, 1).otherwise(0)).cast("int")


def _parts(rows: DataFrame) -> DataFrame:
    """(value, length, i, segment, before, after) of rows (value, length, i, at, size)."""
    v, at, size = F.col("value"), F.col("at"), F.col("size")
    return rows.select("value", "length", "i", F.substring(v, at, size).alias("segment"),
                       F.substring(v, F.lit(1), at - 1).alias("before"), F.substr(v, at + size).alias("after"))


def segments(values: DataFrame, k: int) -> DataFrame:
    """(value, length, i, segment, before, after): the index, of strings longer
    than k."""
    rows = values.filter(F.length("value") > k).select(
        "value", F.length("value").alias("length"), F.explode(F.array(*(F.lit(i) for i in range(1, k + 2)))).alias("i"))
    at, size = _segment(F.col("length"), F.col("i"), k)
    return _parts(rows.select("*", at.alias("at"), size.alias("size")))


def look_ups(values: DataFrame, k: int) -> DataFrame:
    """The substrings that a string looks up in the index, columns as there."""
    places = [F.struct(F.lit(less).alias("less"), F.lit(i).alias("i"), F.lit(shift).alias("shift"))
              for less in range(k + 1) for i in range(1, k + 2) for shift in range(-(i - 1), i) if abs(less - shift) <= k + 1 - i]
    rows = values.filter(F.length("value") > k).select("value", F.length("value").alias("own"), F.explode(F.array(*places)).alias("p"))
    rows = rows.select("value", "own", (F.col("own") - F.col("p.less")).alias("length"), F.col("p.i").alias("i"), F.col("p.shift").alias("shift"))
    start, size = _segment(F.col("length"), F.col("i"), k)
    rows = rows.select("value", "own", "length", "i", (start + F.col("shift")).alias("at"), size.alias("size"))
    return _parts(rows.filter((F.col("length") > k) & (F.col("at") >= 1) & (F.col("at") + F.col("size") - 1 <= F.col("own"))))


def _told_apart(rows: DataFrame, k: int) -> DataFrame:
    """Rows once for each pair of deletion forms of what stands around."""
    forms = [(F.when(F.col("i") == i, deletions(F.col(c), e))) for c in ("before", "after") for i in range(1, k + 2)
             for e in [i - 1 if c == "before" else k + 1 - i]]
    before, after = F.coalesce(*forms[:k + 1]), F.coalesce(*forms[k + 1:])
    return rows.select("value", "length", "i", "segment", F.explode(before).alias("before"), "after", after.alias("_after")) \
        .select("value", "length", "i", "segment", "before", F.explode("_after").alias("after"))


def _among_long(values: DataFrame, k: int, crowded: int) -> DataFrame:
    """(a, b) of ``values`` (value) longer than k, any order, that a segment
    brings together; with repeats."""
    key = ["length", "i", "segment"]
    index = materialize(segments(values, k), "editjoin")
    probes = materialize(look_ups(values, k), "editjoin")
    full = materialize(index.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowded).select(*key), "editjoin")

    def met(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        # A merge join: a small file of rows may be many rows once forms are made.
        return left.select(F.col("value").alias("a"), *on).hint("merge").join(right.select(F.col("value").alias("b"), *on), on).select("a", "b")

    plain = met(index.join(full, key, "left_anti"), probes.join(full, key, "left_anti"), key)
    # Written first: Spark pushes the filter of an explode (forms not empty) below
    # the semi join, where the forms of all rows would be made, not of these.
    crowd = (materialize(side.join(full, key, "left_semi"), "editjoin") for side in (index, probes))
    return plain.unionByName(met(*(_told_apart(side, k) for side in crowd), [*key, "before", "after"]))


def edges_within(values: DataFrame, k: int, crowded: int = CROWDED, forms: int = FORMS) -> DataFrame:
    """(a, b, distance), a < b, of distinct ``values`` (value) at most k edits
    apart, but for pairs in which both have at most k signs. Strings of at most
    ``forms`` forms, and all of at most 2 k signs, meet on forms."""
    numbered = materialize(values.select("value", F.monotonically_increasing_id().alias("id")), "editjoin")
    counts = dict(numbered.groupBy(F.length("value")).count().collect())  # a row for each length
    short = max([2 * k, *(n for n in counts if sum(comb(n, e) for e in range(k + 1)) <= forms)])
    near = {n: rows for n, rows in counts.items() if n <= short + k}  # the shortest of the long ones may be near short ones
    pairs = materialize(meet_on_forms(numbered.filter(F.length("value") <= short + k), k, near), "editjoin")
    linked = pairs.join(numbered.select(F.col("id").alias("a"), F.col("value").alias("va")), "a").join(
        numbered.select(F.col("id").alias("b"), F.col("value").alias("vb")), "b").select(F.col("va").alias("a"), F.col("vb").alias("b")) \
        .filter(F.greatest(F.length("a"), F.length("b")) > k)
    some_long = any(n > short for n in counts)
    if some_long:
        linked = linked.unionByName(_among_long(numbered.filter(F.length("value") > short).select("value"), k, crowded))
    # Verified before the distinct, so that only links are shuffled for it.
    linked = linked.filter(F.col("a") != F.col("b")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.levenshtein("a", "b", k).alias("distance")).filter(F.col("distance") >= 0)
    return linked.distinct() if some_long else linked


def clusters_within(df: DataFrame, col: str, k: int, crowded: int = CROWDED) -> DataFrame:
    """(value, records, n_links, cluster) of each distinct non-NULL value of
    ``col``: its rows, the other values within k edits, and the least value that
    is reached over such links. Empty values are values; other columns are not
    read. An empty table gives an empty result."""
    if k < 1:
        raise ValueError("k must be at least 1")
    counts = materialize(df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("records")), "editjoin")
    edges = materialize(edges_within(counts.select("value"), k, crowded), "editjoin")
    tiny = counts.filter(F.length("value") <= k)
    hub, among = tiny.agg(F.min("value"), F.count(F.lit(1))).first()
    star = tiny.filter(F.col("value") != F.lit(hub)).select(F.lit(hub).cast("string").alias("u"), F.col("value").alias("v"))
    roots = components(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(star)).withColumnRenamed("node", "value")
    ends = edges.select(F.col("a").alias("value")).unionByName(edges.select(F.col("b").alias("value")))
    links = ends.groupBy("value").agg(F.count(F.lit(1)).alias("links"))
    tiny_links = F.when(F.length("value") <= k, F.lit(among - 1)).otherwise(0)
    return counts.join(links, "value", "left").join(roots, "value", "left").select(
        "value", "records", (F.coalesce("links", F.lit(0)) + tiny_links).cast("long").alias("n_links"), F.coalesce("root", "value").alias("cluster"))
