"""Chat formatting with DataFrame functions alone: cumulative snapshots collapse.

Logs often hold a conversation many times, each time with one more exchange.
Every turn gets a rolling hash of the conversation up to it; a conversation
whose last hash is a hash that a longer one passes through is its prefix, and
goes. What is left is rendered.

Rolling hashes are prefix XORs of 128-bit hashes of (position, role, text), so
they can be summed in blocks of ``BLOCK`` turns: a window runs over one block of
one conversation, a second one over its blocks. Blocks are cut by place, not by
turn number, so a conversation that holds much of the table, or very many turns
without a number, is many groups; the rendered text comes in parts of one block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldenrec.llm.turns import ordered
from goldenrec.session import materialize

BLOCK = 1024


def _turns(turns: DataFrame) -> DataFrame:
    """Rows with a conversation: (conv_id, turn, role, text, h1, h2)."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.filter(F.col("conv_id").isNotNull()).select("conv_id", "turn", role.alias("role"), text.alias("text"))
    return rows.select("*", F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit("second"), "role", "text").alias("h2"))


def places(rows: DataFrame, block: int) -> DataFrame:
    """(conv_id, turn, h1, h2, pos): distinct rows with their place in their
    conversation from 1, by turn (NULL first), then by hash; written out."""
    line = ordered(rows, ("h1", "h2")).withColumn("run", F.floor(F.col("seq") / F.lit(block)))
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = line.groupBy("conv_id", "run").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("low")).select(
        "conv_id", "run", (F.coalesce(F.sum("n").over(before), F.lit(0)) + 1 - F.col("low")).alias("shift"))
    return materialize(line.join(runs, ["conv_id", "run"]).select("conv_id", "turn", "h1", "h2", (F.col("seq") + F.col("shift")).alias("pos")), "chat")


def prefixes(placed: DataFrame, block: int) -> DataFrame:
    """(conv_id, pos, x1, x2) for each turn: the rolling hash of the first pos
    turns."""
    part = F.floor((F.col("pos") - 1) / F.lit(block)).alias("part")
    hashed = placed.select("conv_id", part, "pos", F.xxhash64("pos", "h1").alias("p1"), F.xxhash64("pos", "h2").alias("p2"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = hashed.groupBy("conv_id", "part").agg(F.bit_xor("p1").alias("s1"), F.bit_xor("p2").alias("s2")).select(
        "conv_id", "part", *(F.coalesce(F.bit_xor(s).over(before), F.lit(0)).alias(s) for s in ("s1", "s2")))
    inside = Window.partitionBy("conv_id", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return hashed.join(sums, ["conv_id", "part"]).select(
        "conv_id", "pos", *(F.col(f"s{k}").bitwiseXOR(F.bit_xor(f"p{k}").over(inside)).alias(f"x{k}") for k in (1, 2)))


def maximal(placed: DataFrame, block: int) -> DataFrame:
    """(conv_id, n_turns, n_copies): conversations that are no proper prefix of
    another; of equal ones the least id, n_copies counts them all."""
    rolling = materialize(prefixes(placed, block), "chat")
    length = materialize(rolling.groupBy("conv_id").agg(F.max("pos").alias("n")), "chat")
    marked = rolling.join(length, "conv_id")
    whole = marked.filter("pos = n").groupBy("n", "x1", "x2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    inner = marked.filter("pos < n").select(F.col("pos").alias("n"), "x1", "x2").distinct()
    return whole.join(inner, ["n", "x1", "x2"], "left_anti").select("conv_id", F.col("n").alias("n_turns"), "n_copies")


def render_turn(role: Column, text: Column) -> Column:
    """One turn between its marks."""
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def format_chats(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, part, n_turns, n_copies, part_turns, rendered) of the maximal
    conversations of ``turns`` (conv_id, turn, role, text); a conversation's
    parts, in order, make up its text. Turns are ordered by turn (NULL first),
    then by hash.

    Rows that repeat a conversation's turn, role and text are one turn. NULL
    roles and texts count as empty. Rows without conv_id belong to no
    conversation and go. Other columns are not read, so names cannot clash. An
    empty table gives an empty result.
    """
    rows = _turns(turns)
    placed = places(rows.select("conv_id", "turn", "h1", "h2").distinct(), block)
    keep = materialize(maximal(placed, block), "chat")
    mine = materialize(placed.join(keep, "conv_id"), "chat")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"m.{c}")) for c in ("conv_id", "turn", "h1", "h2")]
    kept = rows.alias("r").join(mine.alias("m"), same).select(
        "m.conv_id", F.floor((F.col("pos") - 1) / F.lit(block)).alias("part"), "n_turns", "n_copies", "pos", "r.role", "r.text")
    said = F.array_sort(F.collect_set(F.struct("pos", "role", "text")))  # at most a block of turns
    parts = kept.groupBy("conv_id", "part", "n_turns", "n_copies").agg(said.alias("said"))
    rendered = F.array_join(F.transform("said", lambda x: render_turn(x["role"], x["text"])), "")
    return parts.select("conv_id", "part", "n_turns", "n_copies", F.size("said").cast("long").alias("part_turns"), rendered.alias("rendered"))
