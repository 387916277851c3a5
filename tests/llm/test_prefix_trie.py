"""The conversation trie against a plain version."""

import hashlib
import random
import zlib

import pytest

from goldenrec.llm import prefix_trie as T

TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain_convs(turns):
    convs = {}
    for conv, turn, role, text in turns:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [r[2:] for r in sorted(rows)] for c, rows in convs.items()}


def plain_rebuilt(convs):
    out = {}
    for c, rows in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + rows[h:]
    return out


def plain_trie(convs):
    members, ends = {}, {}
    for c, rows in convs.items():
        for d in range(len(rows) + 1):
            members.setdefault(tuple(rows[:d]), []).append(c)
        ends.setdefault(tuple(rows), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)

    figures = {}
    for node in sorted(members, key=len, reverse=True):
        below = [figures[k] for k in kids.get(node, [])]
        saved = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0) + sum(b[1] for b in below)
        figures[node] = (sum(b[0] for b in below) or 1, saved)
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids.get(node, [])), *figures[node],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()) for node, m in members.items())


def result(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.fixture(scope="module")
def log():
    rng = random.Random(2)
    rows = []
    for conv in [*range(0, 40), *range(95, 130), 200, 205, 399]:
        for turn in range(rng.randint(1, 7)):
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None, "long one", "ccc"])))
    rows += [(c, k, "user", f"step {k}") for c in (300, 301, 302, 310) for k in range(12 + c % 5)]  # long shared prefixes
    rows += [(500, 3, "user", "x"), (500, None, "user", "first"), (500, None, "assistant", "first"), (500, 3, "user", "x"), (501, None, None, None)]
    rows += [(None, 0, "user", "nobody"), (600, 0, "user", "w" * 70000), (600, 1, "user", "w" * 70000)]
    return rows


def test_query_against_the_plain_version(llm_spark, log):
    turns = llm_spark.createDataFrame(log, TURNS).repartition(5)
    assert result(T.rebuilt_trie(turns)) == plain_trie(plain_rebuilt(plain_convs(log)))


def test_blocks_and_many_levels(llm_spark, log, monkeypatch):
    monkeypatch.setattr(T, "LEVELS", 3)
    monkeypatch.setattr(T, "BLOCK_BITS", 1)
    turns = llm_spark.createDataFrame(log, TURNS).repartition(5)
    assert result(T.conversation_trie(turns)) == plain_trie(plain_convs(log))


def test_a_long_conversation_takes_no_groupings_of_its_own(llm_spark):
    rows = [(1, k, "user", str(k)) for k in range(700)] + [(2, k, "user", str(k)) for k in range(400)] + [(3, 0, "user", "0"), (4, 0, "user", "z")]
    rows += [(5, k, "user", str(k)) for k in range(700)]
    line = T.placed(T.said(llm_spark.createDataFrame(rows, TURNS)))
    path = T.paths(line)
    ended = T._ended(path, line.select("conv_id").distinct())
    own = path.join(ended.select("conv_id"), "conv_id", "left_semi")
    assert T._busy_depths(own, ended) == [400, 1, 0]
    assert result(T.prefix_trie(path, line.select("conv_id").distinct())) == plain_trie(plain_convs(rows))


def test_empty_one_turn_and_clashing_names(llm_spark):
    assert T.rebuilt_trie(llm_spark.createDataFrame([], TURNS)).count() == 0
    one = [(7, 0, "user", "hi", 1, "a", 5)]
    extra = llm_spark.createDataFrame(one, TURNS + ", depth long, x1 string, chars long")
    assert result(T.rebuilt_trie(extra)) == plain_trie(plain_rebuilt(plain_convs([r[:4] for r in one])))
