"""Conversation structure repair: a generalised LR parser that may edit.

The roles of a legal conversation follow a small grammar (``PRODUCTIONS``). Its
LR automaton reads a conversation row by row; besides shifting the row's role it
may delete the row, give it another role or insert a row, each at a cost. All
ways of doing so are kept at once as a graph-structured stack, in which stacks
with equal tops are one, that of the least (cost, audit); the audit is the
string of edits made. Stacks that cost ``SLACK`` more than the best cannot win
any more and go.

A conversation is read in blocks, each in a task of its own: from every state
that the stack can be in at the block's start, the least (cost, audit) to each
state at its end. Putting blocks together is then a short pass over these
tables, so one conversation that holds much of the table is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldenrec.llm.turns import batches_of, joined_sha256, ordered, rows_of
from goldenrec.session import materialize

#: (s?(ua)+)? over the initials of system, user and assistant.
PRODUCTIONS = (("C", ""), ("C", "B"), ("B", "Bua"), ("B", "sua"), ("B", "ua"))
START = "C"
LEGAL_PAIRS = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}

#: Costs of the edits; a kept or reroled row without an end costs one more.
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1

#: Any state does what another can after at most two inserts and one delete.
SLACK = 2 * INSERT + DELETE

#: log2 of the most rows of a block.
BLOCK_BITS = 12

#: Rows after which the audits compared are cut back to where they differ.
REBASE = 64

BLANK, DUPLICATE, CUT = 1, 2, 3
SPACE = " \t\n\x0b\f\r"


def _automaton() -> tuple[list[dict[str, int]], dict[int, tuple[str, int]], set[int]]:
    """The LR(0) automaton: moves of each state, the production that a state
    completes (left side, length), and the states in which a text may end."""
    sides = {left for left, _ in PRODUCTIONS}

    def closure(items: set) -> frozenset:
        items, todo = set(items), list(items)
        while todo:
            p, dot = todo.pop()
            right = PRODUCTIONS[p][1]
            if dot < len(right) and right[dot] in sides:
                new = {(q, 0) for q, (left, _) in enumerate(PRODUCTIONS) if left == right[dot]} - items
                items |= new
                todo += new
        return frozenset(items)

    states = [closure({(q, 0) for q, (left, _) in enumerate(PRODUCTIONS) if left == START})]
    moves: list[dict[str, int]] = []
    while len(moves) < len(states):
        items, move = states[len(moves)], {}
        for sign in sorted({PRODUCTIONS[p][1][dot] for p, dot in items if dot < len(PRODUCTIONS[p][1])}):
            to = closure({(p, dot + 1) for p, dot in items if PRODUCTIONS[p][1][dot:dot + 1] == sign})
            if to not in states:
                states.append(to)
            move[sign] = states.index(to)
        moves.append(move)
    done = {k: {p for p, dot in items if dot == len(PRODUCTIONS[p][1])} for k, items in enumerate(states)}
    reduce = {k: (PRODUCTIONS[p][0], len(PRODUCTIONS[p][1])) for k, ps in done.items() for p in ps if PRODUCTIONS[p][0] != START}
    return moves, reduce, {k for k, ps in done.items() if any(PRODUCTIONS[p][0] == START for p in ps)}


MOVES, REDUCE, ENDS = _automaton()
BOTTOM = (0, None)


def shift(stack: tuple, sign: str) -> tuple | None:
    """The stack (state, below) after ``sign`` and the reductions that follow,
    or None where the grammar does not allow it."""
    to = MOVES[stack[0]].get(sign)
    if to is None:
        return None
    stack = (to, stack)
    while stack[0] in REDUCE:
        left, length = REDUCE[stack[0]]
        for _ in range(length):
            stack = stack[1]
        stack = (MOVES[stack[0]][left], stack)
    return stack


def _stacks() -> dict[int, tuple]:
    """The stack under each state that can be on top between two rows. The
    grammar has one for each, so merging equal tops loses nothing."""
    found, todo = {0: BOTTOM}, [BOTTOM]
    while todo:
        stack = todo.pop()
        for sign in "sua":
            new = shift(stack, sign)
            if new is not None and new[0] not in found:
                found[new[0]] = new
                todo.append(new)
    return found


STACKS = _stacks()

# A head of the graph-structured stack: (cost, word, cut, chain, stack). ``word``
# orders the heads of one row as their audits do; word[cut:] are the last edits
# and ``chain`` the linked strings of those before.


def _offer(heads: dict[int, tuple], head: tuple) -> bool:
    top = head[4][0]
    held = heads.get(top)
    if held is None or head[:2] < held[:2]:
        heads[top] = head
        return True
    return False


def _inserts(heads: dict[int, tuple]) -> dict[int, tuple]:
    """Heads after any number of inserted rows, without those that cannot win."""
    todo = list(heads)
    while todo:
        cost, word, cut, chain, stack = heads[todo.pop()]
        for sign in ROLES:
            new = shift(stack, sign)
            if new is not None and _offer(heads, (cost + INSERT, word + "I", cut, chain, new)):
                todo.append(new[0])
    best = min(head[0] for head in heads.values()) + SLACK
    return {top: head for top, head in heads.items() if head[0] <= best}


def _read(heads: dict[int, tuple], initial: str, fault: int) -> dict[int, tuple]:
    """Heads after one row."""
    after: dict[int, tuple] = {}
    end = TRUNCATED if fault == CUT else 0
    for cost, word, cut, chain, stack in heads.values():
        _offer(after, (cost + DELETE, word + "D", cut, chain, stack))
        if fault in (BLANK, DUPLICATE):
            continue
        kept = shift(stack, initial)
        if kept is not None:
            _offer(after, (cost + end, word + "K", cut, chain, kept))
        for sign in ROLES:
            new = shift(stack, sign)
            if new is not None:
                _offer(after, (cost + end + REROLE, word + "R", cut, chain, new))
    return _inserts(after)


def short_words(words: Iterable[str]) -> dict[str, str]:
    """Shorter strings that stand in the same order, also after more signs are
    put behind: the signs where sorted neighbours part, and the whole rest of a
    word that begins with its neighbour."""
    line, places = sorted(set(words)), set()
    for a, b in zip(line, line[1:]):
        k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        places |= {k} if k < len(a) else set(range(k, len(b)))
    order = sorted(places)
    return {w: "".join(w[k] for k in order if k < len(w)) for w in line}


def _rebase(heads: dict[int, tuple]) -> dict[int, tuple]:
    short = short_words(head[1] for head in heads.values())
    return {top: (cost, short[word], len(short[word]), (chain, word[cut:]), stack)
            for top, (cost, word, cut, chain, stack) in heads.items()}


def _audit(head: tuple) -> str:
    _, word, cut, chain, _ = head
    parts = [word[cut:]]
    while chain is not None:
        chain, part = chain
        parts.append(part)
    return "".join(reversed(parts))


def parse(rows: list[tuple[str, int]], start: int = 0, first: bool = True) -> dict[int, tuple[int, str]]:
    """State on top -> least (cost, audit) after ``rows`` (initial, fault), from
    a stack with ``start`` on top. ``first``: rows may be inserted before."""
    heads = {start: (0, "", 0, None, STACKS[start])}
    if first:
        heads = _inserts(heads)
    for k, (initial, fault) in enumerate(rows):
        heads = _read(heads, initial, fault)
        if k % REBASE == REBASE - 1:
            heads = _rebase(heads)
    return {top: (head[0], _audit(head)) for top, head in heads.items()}


def join_blocks(blocks: Iterable[dict[int, dict[int, tuple[int, str]]]]) -> tuple[int, str]:
    """Least (cost, audit) of a conversation from the tables of its blocks:
    state before -> state after -> (cost, audit)."""
    heads = {0: (0, "", 0, None, BOTTOM)}
    for table in blocks:
        after: dict[int, tuple] = {}
        for before, (cost, word, cut, chain, _) in heads.items():
            for top, (more, audit) in table[before].items():
                _offer(after, (cost + more, word + audit, cut, chain, STACKS[top]))
        heads = _rebase(after)
    best = min((head for top, head in heads.items() if top in ENDS), key=lambda head: head[:2])
    return best[0], _audit(best)


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the repaired rows of ``rows`` (role, text)."""
    stack = BOTTOM
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        sign = role[:1] if edit == "K" else next(s for s in ROLES if shift(stack, s))
        stack = shift(stack, sign)
        yield edit, role if edit == "K" else ROLES[sign], text


def _given(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def placed_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, seq, turn, role, text, h1, h2, fault) of all rows in order, fault
    0 or that of the row's first fault; written out."""
    rows = turns.select("conv_id", "turn", _given("role").alias("role"), _given("text").alias("text"))
    rows = ordered(rows.select("*", F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit("second"), "role", "text").alias("h2")))
    who = ("conv_id", "h1", "h2")
    again = materialize(rows.groupBy(*who).agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
                        .select(*(F.col(c).alias(f"_{c}") for c in who), "first"), "repair")
    same = F.col("conv_id").eqNullSafe(F.col("_conv_id")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
    last = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    fault = (F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).when(F.col("seq") > F.col("first"), DUPLICATE)
             .when(~last.isin(".", "!", "?"), CUT).otherwise(0))
    return rows.join(again, same, "left").select("conv_id", "seq", "turn", "role", "text", fault.alias("fault"))


_PIECES = "conv_id long, blank long, duplicate long, truncated long, illegal long, first string, last string, states array<int>, tops array<int>, costs array<long>, audits array<string>"
_REPAIRS = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _schema(text: str, conv_type) -> tuple:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(text)
    schema["conv_id"].dataType = conv_type
    return schema, to_arrow_schema(schema)


def repairs(placed: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """(conv_id, blank, duplicate, truncated, illegal, cost, audit) of each
    conversation of ``placed_turns``."""
    conv_type = placed.schema["conv_id"].dataType
    pieces, arrow_pieces = _schema(_PIECES, conv_type)
    found, arrow_found = _schema(_REPAIRS, conv_type)
    narrow = placed.select("conv_id", F.shiftright("seq", block_bits).alias("block"), "seq", F.left("role", F.lit(1)).alias("initial"), "fault")
    # A conversation of one block starts from the empty stack alone.
    spread = materialize(narrow.groupBy("conv_id").agg(F.min("block").alias("low"), F.max("block").alias("high")).filter("low < high")
                         .select(F.col("conv_id").alias("_conv_id"), "low"), "repair")
    narrow = narrow.join(spread, F.col("conv_id").eqNullSafe(F.col("_conv_id")), "left").drop("_conv_id")

    def read_block(key, group):
        conv, block, low = key
        rows = [(row[3], row[4]) for row in group]
        begins = low is None or block == low
        tables = {s: parse(rows, s, begins) for s in ([0] if begins else STACKS)}
        flat = [(s, top, cost, audit) for s, table in tables.items() for top, (cost, audit) in table.items()]
        faults, initials = [f for _, f in rows], [i for i, _ in rows]
        illegal = sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:]))
        return (conv, block, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal, initials[0], initials[-1],
                *([x[k] for x in flat] for k in range(4)))

    def read(batches):
        for key, group in groupby(rows_of(batches), key=lambda row: (row[0], row[1], row[5])):
            yield read_block(key, group)

    def put_together(batches):
        for conv, group in groupby(rows_of(batches), key=lambda row: row[0]):
            counts, before, tables = [0, 0, 0, 0], None, []
            for _, _, *faults, first, last, states, tops, costs, audits in group:
                counts = [a + b for a, b in zip(counts, faults)]
                counts[3] += before is not None and before + first not in LEGAL_PAIRS
                before = last
                table: dict[int, dict[int, tuple[int, str]]] = {}
                for s, top, cost, audit in zip(states, tops, costs, audits):
                    table.setdefault(s, {})[top] = (cost, audit)
                tables.append(table)
            yield (conv, *counts, *join_blocks(tables))

    with_block = type(pieces)(pieces.fields[:1] + type(pieces).fromDDL("block long").fields + pieces.fields[1:])
    arrow_block = pa.schema([arrow_pieces[0], pa.field("block", pa.int64()), *list(arrow_pieces)[1:]])
    tables = narrow.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "seq") \
        .select("conv_id", "block", "seq", "initial", "fault", "low").mapInArrow(lambda b: batches_of(read(b), arrow_block), with_block)
    return tables.repartition("conv_id").sortWithinPartitions("conv_id", "block") \
        .mapInArrow(lambda b: batches_of(put_together(b), arrow_found), found)


def repaired_turns(placed: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, pos, edit, role, text): the rows of the repaired conversations,
    pos from 0, edit K, R or I. ``found``: ``repairs`` of ``placed``."""
    schema, arrow = _schema("conv_id long, pos long, edit string, role string, text string", placed.schema["conv_id"].dataType)

    def edit(batches):
        for conv, group in groupby(rows_of(batches), key=lambda row: row[0]):
            audit = next(group)[2]
            for pos, row in enumerate(edited(audit, ((role, text) for _, role, text in group))):
                yield (conv, pos, *row)

    both = found.select("conv_id", F.lit(-1).cast("long").alias("seq"), F.lit("").alias("role"), F.col("audit").alias("text")).unionByName(
        placed.select("conv_id", "seq", "role", "text"))
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "seq").select("conv_id", "role", "text") \
        .mapInArrow(lambda b: batches_of(edit(b), arrow), schema)


def repair(turns: DataFrame, block_bits: int = BLOCK_BITS) -> tuple[DataFrame, DataFrame]:
    """Conversations of ``turns`` (conv_id, turn, role, text) and their repaired
    rows: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) and
    (conv_id, pos, edit, role, text).

    Rows stand in the order of their turns (NULL first); rows of one turn by role
    and a hash of the text. A NULL role or text is one space, rows with a NULL
    conv_id are a conversation of their own. Repeated rows count as duplicates.
    Other columns are not read, so names cannot clash. An empty table gives empty
    results. A text is never held more than once in a task; the audit of a
    conversation is one value of the result and is held whole when its blocks are
    put together.
    """
    placed = materialize(placed_turns(turns), "repair")
    found = materialize(repairs(placed, block_bits), "repair")
    span = placed.groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    both = span.unionByName(found, allowMissingColumns=True)
    rows = both.groupBy("conv_id").agg(*(F.max(c).alias(c) for c in both.columns if c != "conv_id"))
    return rows, repaired_turns(placed, found)


def damage(turns: DataFrame) -> DataFrame:
    """Turns with faults planted by crc32 of ``conv_id:turn`` modulo 20: 0 drops
    the row, 1 empties the text, 2 takes its end signs, 3 repeats the row, 4 makes
    the role user. NULLs are one space, but the turn and the id stay as they are."""
    fate = F.crc32(F.concat(_given("conv_id"), F.lit(":"), _given("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", _given("role").alias("role"), _given("text").alias("text"), fate.alias("fate")).filter("fate <> 0")
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_copy")).drop("_copy")


def repair_damaged(turns: DataFrame) -> DataFrame:
    """Every conv_id of ``turns`` with what ``repair`` finds and does after
    ``damage``; repaired_sha256 is that of the repaired ``role:text`` lines. A
    conversation without a row left has zeros, an empty audit and the empty
    text's hash."""
    found, rows = repair(damage(turns))
    lines = rows.withColumn("line", F.concat("role", F.lit(":"), "text"))
    digests = joined_sha256(lines, ["conv_id"], ["pos"], "line", "\n", "repaired_sha256")
    every = turns.select("conv_id").distinct().unionByName(found, allowMissingColumns=True).unionByName(digests, allowMissingColumns=True)
    zeros = [F.coalesce(F.max(c), F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.groupBy("conv_id").agg(*zeros, F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
                                        F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
