"""Near-equal records over several attributes by set similarity (G9), exactly.

A record is the set of its attributes' q-grams. Two sets of Jaccard similarity t
or more share one of their first n - ceil(t n) + 1 tokens if the tokens of all
sets stand in one order, so only these prefixes are joined; with the rarest
tokens first, few records meet there. Lengths must fit too. What meets is
verified on the whole sets.

A token that even so stands in very many prefixes is not joined on alone: sets
that share nothing rarer share two tokens of the prefix that is one longer, so
records with such a token are joined on pairs of tokens. Equal sets are one set
before anything is joined. Nothing is capped and no link is lost.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldenrec.operators.components import components
from goldenrec.session import materialize

#: Prefixes that a token may stand in before it counts as crowded.
CROWDED = 64


def grams(attributes: Sequence[str], q: int = 3) -> Column:
    """The distinct q-grams of the attributes' trimmed lower-case texts, each with
    its attribute's number; a shorter text is one gram, NULL or blank none."""
    def of(k: int, text: Column) -> Column:
        places = F.sequence(F.lit(1), F.greatest(F.length(text) - (q - 1), F.lit(1)))
        pieces = F.transform(places, lambda p: F.concat(F.lit(f"{k}:"), F.substring(text, p, F.lit(q))))
        return F.when(F.length(text) > 0, pieces).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.flatten(F.array(*(of(k, F.lower(F.trim(F.col(c).cast("string")))) for k, c in enumerate(attributes)))))


def _least_overlap(n: Column, threshold: float) -> Column:
    """Tokens that a similar set at least shares with one of n tokens."""
    return F.ceil(n * F.lit(threshold) - F.lit(1e-9)).cast("int")


def ranked_sets(sets: DataFrame) -> DataFrame:
    """(rep, n, tokens) with each set's tokens rarest first; written out."""
    each = sets.select("rep", F.explode("grams").alias("gram"))
    counts = materialize(each.groupBy("gram").agg(F.count(F.lit(1)).alias("n")), "setjoin")
    ranked = each.join(counts, "gram").groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("n", "gram"))).alias("ranked"))  # one set's own tokens
    return materialize(ranked.select("rep", F.size("ranked").alias("n"), F.transform("ranked", lambda r: r["gram"]).alias("tokens")), "setjoin")


def similar_sets(sets: DataFrame, threshold: float, crowded: int = CROWDED) -> DataFrame:
    """(a, b, similarity), a < b, of the distinct sets (rep, grams)."""
    ranked = ranked_sets(sets)
    prefix = F.col("n") - _least_overlap(F.col("n"), threshold) + 1
    heads = materialize(ranked.select("rep", "n", F.posexplode(F.slice("tokens", F.lit(1), prefix)).alias("at", "token")), "setjoin")
    full = materialize(heads.groupBy("token").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > crowded).select("token"), "setjoin")

    def met(rows: DataFrame, on: list[str]) -> DataFrame:
        left, right = (rows.select(F.col("rep").alias(r), F.col("n").alias(f"n_{r}"), *on) for r in "ab")
        fits = (F.col("n_a") >= _least_overlap(F.col("n_b"), threshold)) & (F.col("n_b") >= _least_overlap(F.col("n_a"), threshold))
        return left.join(right, on).filter((F.col("a") < F.col("b")) & fits).select("a", "b")

    alone = met(heads.join(full, "token", "left_anti"), ["token"])
    with_crowd = heads.join(full, "token", "left_semi").select("rep").distinct()
    longer = ranked.join(with_crowd, "rep").select("rep", "n", F.array_sort(F.slice("tokens", F.lit(1), prefix + 1)).alias("head"))
    firsts = longer.select("rep", "n", "head", F.posexplode("head").alias("at", "t1"))
    two = firsts.select("rep", "n", "t1", F.explode(F.slice("head", F.col("at") + 2, F.size("head"))).alias("t2"))
    pairs = materialize(alone.unionByName(met(two, ["t1", "t2"])).distinct(), "setjoin")
    tokens = ranked.select("rep", "n", "tokens")
    sides = pairs.join(tokens.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta")), "a") \
        .join(tokens.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb")), "b")
    shared = F.size(F.array_intersect("ta", "tb"))
    scored = sides.select("a", "b", (shared / (F.col("na") + F.col("nb") - shared)).alias("similarity"))
    return scored.filter(F.col("similarity") >= threshold)


def similar_records(df: DataFrame, id_col: str, attributes: Sequence[str], threshold: float = 0.8, q: int = 3, crowded: int = CROWDED) -> DataFrame:
    """(id, copies, n_links, cluster) of each row: rows with the same set, itself
    included, other rows of similarity ``threshold`` or more, and the least id
    reached over such links. Rows without a gram link with nothing. NULL ids take
    no part. Other columns are not read. An empty table gives an empty result."""
    if not 0.5 < threshold <= 1:
        raise ValueError("threshold must be above 0.5 and at most 1")
    rows = df.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), grams(attributes, q).alias("grams"))
    keyed = materialize(rows.withColumn("set", F.sha2(F.array_join(F.array_sort("grams"), "\x00"), 256)), "setjoin")
    some = keyed.filter(F.size("grams") > 0)
    reps = materialize(some.groupBy("set").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("grams").alias("grams")), "setjoin")
    edges = materialize(similar_sets(reps.select("rep", "grams"), threshold, crowded), "setjoin")
    sizes = reps.select("rep", "copies")
    ends = edges.select(F.col("a").alias("rep"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("rep"), F.col("a").alias("other")))
    others = ends.join(sizes.select(F.col("rep").alias("other"), "copies"), "other").groupBy("rep").agg(F.sum("copies").alias("others"))
    roots = components(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))).withColumnRenamed("node", "rep")
    classes = reps.select("set", "rep", "copies").join(others, "rep", "left").join(roots, "rep", "left")
    classes = materialize(classes.select("set", "copies", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                                         F.coalesce("root", "rep").alias("cluster")), "setjoin")
    linked = some.select("id", "set").join(classes, "set").select("id", "copies", "n_links", "cluster")
    bare = keyed.filter(F.size("grams") == 0).select("id", F.lit(1).cast("long").alias("copies"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("cluster"))
    return linked.unionByName(bare)
