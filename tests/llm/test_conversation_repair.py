"""Conversation repair against exhaustive edits and a plain version over a table."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from goldenrec.llm import repair as R

TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def every_repair(rows, most_inserts=4):
    """Least (cost, audit, initials) over all edits of a short conversation."""
    ways = [[("D", "", 3)] if f in (R.BLANK, R.DUPLICATE) else
            [("D", "", 3), ("K", i, int(f == R.CUT)), *(("R", r, 2 + int(f == R.CUT)) for r in "ua")] for i, f in rows]
    best = None
    for n in range(most_inserts + 1):
        for places in itertools.combinations_with_replacement(range(len(rows) + 1), n):
            for roles in itertools.product("ua", repeat=n):
                for edits in itertools.product(*ways):
                    line = []
                    for k in range(len(rows) + 1):
                        line += [("I", r, 2) for p, r in zip(places, roles) if p == k]
                        line += [edits[k]] if k < len(rows) else []
                    signs = "".join(e[1] or "" if e[0] == "D" else e[1] or "?" for e in line)
                    if re.fullmatch("(s?(ua)+)?", signs):
                        found = (sum(e[2] for e in line), "".join(e[0] for e in line), signs)
                        best = found if best is None else min(best, found)
    return best


def plain_repair(rows):
    """Least (cost, audit): all audits of each (rows read, state), shortest first."""
    import heapq

    follow = {(0, "s"): 2, (0, "u"): 3, (2, "u"): 3, (3, "a"): 1, (1, "u"): 3}
    heap, seen, best = [(0, "", 0, 0)], set(), None
    while heap:
        cost, audit, k, state = heapq.heappop(heap)
        if (k, state) in seen:
            continue
        seen.add((k, state))
        if k == len(rows) and state in (0, 1):
            best = min(best or (cost, audit), (cost, audit))
        steps = [(2, "I", k, r) for r in "ua"]
        if k < len(rows):
            initial, fault = rows[k]
            heapq.heappush(heap, (cost + 3, audit + "D", k + 1, state))
            if fault not in (R.BLANK, R.DUPLICATE):
                end = int(fault == R.CUT)
                steps += [(end, "K", k + 1, initial), *((2 + end, "R", k + 1, r) for r in "ua")]
        for more, edit, then, sign in steps:
            if (state, sign) in follow:
                heapq.heappush(heap, (cost + more, audit + edit, then, follow[state, sign]))
    return best


def random_rows(rng, n):
    return [(rng.choice("ssuuuaaat") if rng.random() < 0.95 else "", rng.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(n)]


def test_all_edits_of_short_conversations():
    rng = random.Random(3)
    for n in (0, 1, 1, 2, 2, 2, 3, 3):
        for _ in range(6):
            rows = random_rows(rng, n)
            found = min(v for top, v in R.parse(rows).items() if top in R.ENDS)
            assert found == every_repair(rows, 3 if n < 3 else 2)[:2] == plain_repair(rows), rows


def test_blocks_put_together_give_the_whole(monkeypatch):
    monkeypatch.setattr(R, "REBASE", 3)
    rng = random.Random(4)
    for _ in range(400):
        rows = random_rows(rng, rng.randint(1, 16))
        cuts = [0, *sorted(rng.sample(range(1, len(rows)), min(len(rows) - 1, rng.randint(0, 3)))), len(rows)]
        blocks = [rows[a:b] for a, b in zip(cuts, cuts[1:])]
        tables = [{s: R.parse(b, s, k == 0) for s in ([0] if k == 0 else R.STACKS)} for k, b in enumerate(blocks)]
        assert R.join_blocks(tables) == plain_repair(rows), rows


def test_short_words_keep_their_order():
    rng = random.Random(5)
    for _ in range(300):
        words = ["".join(rng.choice("DK") for _ in range(9)) for _ in range(4)]
        words.append(words[0] + "I" * rng.randint(1, 3))
        short = R.short_words(words)
        for a, b in itertools.product(words, repeat=2):
            for x, y in (("", ""), ("DI", "DI"), ("K", "K"), ("I", "D"), ("D", "I")):
                assert (a + x < b + y) == (short[a] + x < short[b] + y)


def slow(turns, damaged=True):
    """conv_id -> the query's row, with plain Python."""
    convs = {}
    for conv, turn, role, text in turns:
        rows = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 5
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        rows += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    out = {}
    for conv, rows in convs.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        seen, faults = set(), []
        for _, role, text in rows:
            body = text.strip(R.SPACE)
            faults.append(R.BLANK if not body else R.DUPLICATE if (role, text) in seen else R.CUT if body[-1] not in ".!?" else 0)
            seen.add((role, text))
        numbers = [r[0] for r in rows if r[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        signs = [r[1][:1] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(signs, signs[1:]))
        cost, audit = plain_repair(list(zip(signs, faults)))
        lines, given = [], iter(rows)
        for edit in audit:
            row = None if edit == "I" else next(given)
            if edit == "K":
                lines.append((row[1], row[2]))
            elif edit in "RI":
                lines.append(("assistant" if lines and lines[-1][0][:1] == "u" else "user", row[2] if row else ""))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out[conv] = (conv, gaps, *(faults.count(k) for k in (1, 2, 3)), illegal, cost, audit, digest)
    return out


def result(df):
    rows = [tuple(r) for r in df.select(*COLUMNS).collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r for r in rows}


@pytest.fixture(scope="module")
def log():
    rng = random.Random(9)
    rows = []
    for conv in range(60):
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, turn, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "Assistant"]),
                         rng.choice(["Yes.", "No?", "and so", "  \t", "", "Done! \n", "ü." + "x" * 50, f"turn {turn}."])))
    rows += [(70, 3, "user", "What."), (70, 5, None, "That."), (70, None, "assistant", None), (70, None, "user", "Early!"), (70, None, "system", "S.")]
    rows += [(None, 1, "user", "Hm?"), (None, 2, "assistant", "Oh."), (71, None, None, None), (72, 0, "user", "long " * 60000 + ".")]
    rows += [(73, k, "user" if k % 2 == 0 else "assistant", "ok.") for k in range(40)] + [(74, 8, "assistant", "twice")] * 3
    return rows


def test_query_against_the_plain_version(llm_spark, log):
    turns = llm_spark.createDataFrame(log, TURNS).repartition(5)
    assert result(R.repair_damaged(turns)) == slow(log)


def test_blocks_over_a_table(llm_spark):
    rng = random.Random(11)
    rows = [(1, k, rng.choice(["user", "assistant"]), rng.choice(["a.", "b", f"{k}.", f"{k}"])) for k in range(900)]
    rows += [(2, None, rng.choice(["user", "assistant"]), f"{k}.") for k in range(2)] + [(3, 0, "user", "same.")] * 500
    found, lines = R.repair(llm_spark.createDataFrame(rows, TURNS).repartition(4), block_bits=4)
    want = slow(rows, damaged=False)
    got = {r.conv_id: r for r in found.collect()}
    for conv in (1, 3):
        assert tuple(got[conv][c] for c in COLUMNS[:-1]) == want[conv][:-1]
    said = sorted(lines.filter("conv_id = 1").collect(), key=lambda r: r.pos)
    assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in said).encode()).hexdigest() == want[1][-1]
    assert "".join(r.edit for r in said) == want[1][-2].replace("D", "")


def test_empty_table_and_clashing_names(llm_spark):
    assert R.repair_damaged(llm_spark.createDataFrame([], TURNS)).count() == 0
    extra = llm_spark.createDataFrame([(1, 0, "user", "A?", "x", 1, 2), (1, 1, "assistant", "B.", "y", 1, 2)],
                                      TURNS + ", fault string, seq long, h1 long")
    assert result(R.repair_damaged(extra)) == slow([(1, 0, "user", "A?"), (1, 1, "assistant", "B.")])
