"""Prefix trie of conversations by truncation peeling.

The trie is found from its deepest nodes up. At a depth, the nodes that survive
from below meet the conversations that end there; equal prefixes are grouped,
which gives the nodes of this depth with all their figures; then the last turn
is stripped and the next smaller depth is grouped.

Where no conversation ends and no two nodes meet, stripping changes no group:
such runs of depths are stripped at once, and the nodes in between are read off
the path of their smallest member. So only depths at which something happens
take a grouping, and a conversation of very many turns that shares only its
first ones with others costs no more groupings than a short one.

A prefix is known by its depth and the XOR of 128-bit hashes of its (position,
role, text). Groups hold sums, minima and counts alone, combined before the
shuffle, so a prefix that most conversations share costs a row a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldenrec.llm.turns import joined_sha256, ordered, packed
from goldenrec.session import materialize, shared_dir

#: log2 of the most rows of a block of one conversation in a window.
BLOCK_BITS = 10

#: Depths grouped between two joins with the paths.
LEVELS = 32

#: Turns that a conversation may take over, and how far apart ids share them.
TAKEN, SHARE = 6, 100


def said(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, h1, h2, chars): rows with a conversation, each
    text as two hashes and its number of code points."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.filter(F.col("conv_id").isNotNull()).select("conv_id", "turn", role.alias("role"), text.alias("text"))
    return rows.select("conv_id", "turn", "role", F.xxhash64("role", "text").alias("h1"),
                       F.xxhash64(F.lit("second"), "role", "text").alias("h2"), F.length("text").cast("long").alias("chars"))


def placed(rows: DataFrame) -> DataFrame:
    """``said`` rows with ``depth``, their place in their conversation from 1, in
    the order of turn (NULL first), role and hash; written out."""
    line = ordered(rows).withColumn("block", F.shiftright("seq", BLOCK_BITS))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = line.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("low"))
    start = materialize(blocks.select("conv_id", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) + 1 - F.col("low")).alias("shift")), "trie")
    return materialize(line.join(start, ["conv_id", "block"]).select(
        "conv_id", (F.col("seq") + F.col("shift")).alias("depth"), "h1", "h2", "chars"), "trie")


def paths(rows: DataFrame) -> DataFrame:
    """(conv_id, depth, x1, x2, chars, cum): the rolling hash of the first depth
    turns, the characters of the last of them and of all; written out. Sums run
    in blocks of depths and over the blocks."""
    cut = F.shiftright(F.col("depth") - 1, BLOCK_BITS).alias("block")
    signs = rows.select("conv_id", cut, "depth", F.xxhash64("depth", "h1").alias("p1"), F.xxhash64("depth", "h2").alias("p2"), "chars")
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = signs.groupBy("conv_id", "block").agg(F.bit_xor("p1").alias("s1"), F.bit_xor("p2").alias("s2"), F.sum("chars").alias("s")).select(
        "conv_id", "block", *(F.coalesce(f(c).over(before), F.lit(0)).alias(c) for f, c in ((F.bit_xor, "s1"), (F.bit_xor, "s2"), (F.sum, "s"))))
    joined = signs.join(materialize(sums, "trie"), ["conv_id", "block"])
    return materialize(joined.select(
        "conv_id", "depth", F.col("s1").bitwiseXOR(F.bit_xor("p1").over(inside)).alias("x1"),
        F.col("s2").bitwiseXOR(F.bit_xor("p2").over(inside)).alias("x2"), "chars", (F.col("s") + F.sum("chars").over(inside)).alias("cum")), "trie")


def _ended(path: DataFrame, ids: DataFrame) -> DataFrame:
    """One row for each distinct whole conversation: (conv_id of the smallest,
    n, ends_sha256 and its last step), also for those without a turn; written."""
    last = path.groupBy("conv_id").agg(F.max(F.struct("depth", "x1", "x2", "chars", "cum")).alias("last"))
    every = ids.join(last, "conv_id", "left")
    whole = materialize(every.select("conv_id", *(F.coalesce(f"last.{c}", F.lit(0).cast("long")).alias(c) for c in ("depth", "x1", "x2", "chars", "cum"))), "trie")
    same = ["depth", "x1", "x2"]
    decimals = packed(whole.withColumn("decimal", F.col("conv_id").cast("string")), same, ["conv_id"], "decimal", ",")
    ends = joined_sha256(decimals, same, ["conv_id"], "decimal", ",", "ends_sha256")
    reps = whole.groupBy(*same).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"), F.max("chars").alias("chars"), F.max("cum").alias("cum"))
    return materialize(reps.join(ends, same), "trie")


def _busy_depths(path: DataFrame, ended: DataFrame) -> list[int]:
    """Depths, falling, at which conversations end or nodes meet; below the first
    of them no two different conversations share a node. 0 is always one."""
    nodes = path.groupBy("depth", "x1", "x2").agg(F.min("conv_id").alias("a"), F.max("conv_id").alias("b"))
    levels = materialize(nodes.groupBy("depth").agg(F.count(F.lit(1)).alias("nodes"), F.max(F.col("a") != F.col("b")).alias("shared")), "trie")
    deepest = levels.filter("shared").agg(F.max("depth")).first()[0] or 0
    below = levels.select((F.col("depth") - 1).alias("depth"), F.col("nodes").alias("below"))
    stops = ended.groupBy("depth").agg(F.count(F.lit(1)).alias("stops"))
    busy = levels.filter(F.col("depth") <= deepest).join(below, "depth", "left").join(stops, "depth", "left").filter(
        F.col("stops").isNotNull() | F.col("below").isNull() | (F.col("below") != F.col("nodes")))
    return sorted({0} | {r[0] for r in busy.select("depth").collect()}, reverse=True)


def _step(depth: int | Column, field: str) -> Column:
    """A field of the path's step at ``depth``; the root's are 0."""
    return F.coalesce(F.try_element_at("trail", F.lit(depth))[field], F.lit(0).cast("long"))


def _with_trail(rows: DataFrame, path: DataFrame, depths: list[int]) -> DataFrame:
    """``rows`` with the steps of conv_id's path at ``depths`` as a map."""
    step = F.struct("depth", F.struct("x1", "x2", "chars", "cum"))
    trail = path.filter(F.col("depth").isin(depths)).groupBy("conv_id").agg(F.map_from_entries(F.collect_list(step)).alias("trail"))
    return rows.join(trail, "conv_id", "left")


def _peel(path: DataFrame, ended: DataFrame, busy: list[int]) -> DataFrame:
    """(conv_id, depth, low, x1, x2, up1, up2, n_convs, n_children, n_leaves,
    saved, ends_sha256, cum_before): the nodes at the busy depths and the ends
    of conversations below them, with the key (up1, up2) of the ancestor at
    ``low``, the next smaller busy depth; written, a folder a level."""
    spark, root = path.sparkSession, shared_dir(path.sparkSession, "trie")

    def written(rows: DataFrame, level: int) -> DataFrame:
        where = f"{root}/level={level}"
        rows.write.parquet(where)
        return spark.read.parquet(where).select("conv_id", "depth", "n_convs", "n_leaves", "saved", "cum_before", "trail")

    def stripped(rows: DataFrame, low: int) -> DataFrame:
        return rows.withColumn("low", F.lit(low).cast("long")).withColumn("up1", _step(low, "x1")).withColumn("up2", _step(low, "x2"))

    def leaves(rows: DataFrame) -> DataFrame:
        return rows.select("conv_id", "depth", "x1", "x2", F.col("n").alias("n_convs"), F.lit(0).cast("long").alias("n_children"),
                           F.lit(1).cast("long").alias("n_leaves"), ((F.col("n") - 1) * F.col("chars")).alias("saved"), "ends_sha256",
                           (F.col("cum") - F.col("chars")).alias("cum_before"))

    alive = None
    for at in range(0, len(busy), LEVELS):
        block = busy[at:at + LEVELS]
        known = busy[at:at + LEVELS + 1]
        entrants = materialize(_with_trail(ended.filter(F.col("depth").isin(block)), path, known), "trie")
        if alive is None:
            tails = _with_trail(leaves(ended.filter(F.col("depth") > busy[0])), path, known)
            alive = written(stripped(tails, busy[0]), len(busy))
        else:
            alive = _with_trail(alive.drop("trail"), path, known)
        for k, depth in enumerate(block):
            up = alive.select(
                "conv_id", _step(depth, "x1").alias("x1"), _step(depth, "x2").alias("x2"), "n_convs", F.lit(1).cast("long").alias("kid"), "n_leaves",
                (F.col("saved") + (F.col("n_convs") - 1) * (F.col("cum_before") - _step(depth, "cum"))).alias("saved"), F.lit(None).cast("string").alias("ends_sha256"), "trail")
            new = entrants.filter(F.col("depth") == depth).select(
                "conv_id", "x1", "x2", F.col("n").alias("n_convs"), F.lit(0).cast("long").alias("kid"), F.lit(0).cast("long").alias("n_leaves"),
                F.lit(0).cast("long").alias("saved"), "ends_sha256", "trail")
            nodes = up.unionByName(new).groupBy("x1", "x2").agg(
                F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("kid").alias("n_children"),
                F.greatest(F.sum("n_leaves"), F.lit(1)).alias("n_leaves"), F.sum("saved").alias("saved"),
                F.coalesce(F.max("ends_sha256"), F.sha2(F.lit(""), 256)).alias("ends_sha256"), F.first("trail").alias("trail"))
            nodes = nodes.withColumn("depth", F.lit(depth).cast("long")).withColumn("saved", F.col("saved") + (F.col("n_convs") - 1) * _step(depth, "chars")) \
                .withColumn("cum_before", _step(depth, "cum") - _step(depth, "chars"))
            low = busy[at + k + 1] if at + k + 1 < len(busy) else -1
            alive = written(stripped(nodes, low), at + k)
    return spark.read.parquet(root).drop("level", "trail")


def prefix_trie(path: DataFrame, ids: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256) of every node over ``paths`` and ``ids``, the
    distinct conv_ids (also those without a turn, which end at the root). No
    conversation: no node."""
    ended = _ended(path, ids)
    own = materialize(path.join(ended.select("conv_id"), "conv_id", "left_semi"), "trie")
    busy = _busy_depths(own, ended)
    peeled = _peel(own, ended, busy)
    over = peeled.select(F.col("depth").alias("low"), F.col("x1").alias("up1"), F.col("x2").alias("up2"), F.col("conv_id").alias("over"))
    ends = materialize(peeled.join(over.filter(F.col("low") <= busy[0]), ["low", "up1", "up2"], "left"), "trie")
    parent = F.when(F.col("depth") - 1 > F.col("low"), F.col("conv_id")).otherwise(F.col("over"))
    figures = ("n_convs", "n_children", "n_leaves")
    tops = ends.select("conv_id", "depth", parent.alias("parent_conv_id"), *figures, F.col("saved").alias("saved_tokens"), "ends_sha256")
    # Between two busy depths: the path of the smallest member.
    stops = F.array(*(F.lit(d).cast("long") for d in busy))
    between = own.select("conv_id", F.col("depth").alias("at"), (F.col("cum") - F.col("chars")).alias("cum_above"),
                         F.array_max(F.filter(stops, lambda d: d < F.col("depth"))).alias("low"))
    run = between.join(ends, ["conv_id", "low"]).filter(F.col("at") < F.col("depth"))
    inner = run.select(
        "conv_id", F.col("at").alias("depth"), F.when(F.col("at") - 1 > F.col("low"), F.col("conv_id")).otherwise(F.col("over")).alias("parent_conv_id"),
        "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves",
        (F.col("saved") + (F.col("n_convs") - 1) * (F.col("cum_before") - F.col("cum_above"))).alias("saved_tokens"), F.sha2(F.lit(""), 256).alias("ends_sha256"))
    return tops.unionByName(inner)


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``placed`` rows with each conversation's first h turns, h = crc32 of its
    decimal id modulo TAKEN, taken from the conversation of the next lower
    multiple of SHARE, and all ids. A conversation that is absent gives none."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % TAKEN).cast("int")
    heads = rows.filter((F.col("conv_id") % SHARE == 0) & (F.col("depth") < TAKEN)).groupBy(F.col("conv_id").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("depth", "h1", "h2", "chars"))).alias("head"))  # fewer than TAKEN rows
    ids = rows.select("conv_id").distinct()
    bases = ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % SHARE).alias("base"), h.alias("h"))
    taken = F.slice(F.coalesce("head", F.array().cast("array<struct<depth:bigint,h1:bigint,h2:bigint,chars:bigint>>")), F.lit(1), F.col("h"))
    plan = materialize(bases.join(heads, "base", "left").select("conv_id", "h", taken.alias("taken")), "trie")
    first = plan.select("conv_id", F.inline("taken"))
    kept = rows.join(plan.select("conv_id", "h", F.size("taken").alias("n")), "conv_id").filter(F.col("depth") > F.col("h")).select(
        "conv_id", (F.col("depth") - F.col("h") + F.col("n")).alias("depth"), "h1", "h2", "chars")
    return materialize(first.unionByName(kept), "trie"), plan.select("conv_id")


def conversation_trie(turns: DataFrame) -> DataFrame:
    """The trie of ``turns`` (conv_id, turn, role, text) as they are.

    Turns are ordered by turn (NULL first), those of one turn by role and a hash
    of the text; repeated rows are turns of their own. NULL roles and texts are
    empty. Rows without conv_id belong to no conversation and go. Other columns
    are not read, so names cannot clash. An empty table gives no node."""
    rows = placed(said(turns))
    return prefix_trie(paths(rows), rows.select("conv_id").distinct())


def rebuilt_trie(turns: DataFrame) -> DataFrame:
    """``conversation_trie`` of the conversations that ``rebuilt`` makes."""
    rows, ids = rebuilt(placed(said(turns)))
    return prefix_trie(paths(rows), ids)
