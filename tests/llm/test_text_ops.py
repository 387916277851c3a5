import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from goldenrec.llm import chat, licenses
from goldenrec.llm import importance as I
from goldenrec.llm import weighted_sampling as W
from goldenrec.llm.line_dedup import dedup_lines
from goldenrec.llm.text import span_hashes


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


# --- line dedup -------------------------------------------------------------


def slow_lines(texts, least=10):
    keys = {}
    for k, t in texts.items():
        keys[k] = [lower(x.strip(" \t\n\x0b\x0c\r")) for x in (t or "").split("\n")]
    holders = defaultdict(set)
    for k, own in keys.items():
        for x in own:
            if len(x) >= least:
                holders[x].add(k)
    out = {}
    for k, t in texts.items():
        lines = (t or "").split("\n")
        stay = [x for x, key in zip(lines, keys[k]) if len(holders[key]) < 2 or min(holders[key]) == k]
        out[k] = (len(lines), len(lines) - len(stay), "\n".join(stay))
    return out


def test_lines_over_a_table(docs, empty, texts):
    given = {3 * k: t for k, t in enumerate(texts)}
    frame = docs.withColumnRenamed("lang", "n_lines").withColumnRenamed("source", "drop")
    rows = dedup_lines(frame).collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in rows} == slow_lines(given)
    assert rows[0]["drop"] == "s" and dedup_lines(empty).count() == 0


def test_texts_of_very_many_lines(llm_spark):
    """Work grows with the lines, not with lines times text."""
    given = {1: "\n".join(f"shared line number {i}" for i in range(0, 100_000, 2)),
             2: "\n".join(f"{'own' if i % 2 else 'shared'} line number {i}" for i in range(100_000))}
    rows = dedup_lines(llm_spark.createDataFrame(list(given.items()), "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in rows} == slow_lines(given)


def test_lines_of_repeated_and_missing_ids(llm_spark):
    line = "a line that is long enough"
    df = llm_spark.createDataFrame([(1, line), (1, line), (2, "x\n  " + line.upper() + "\t\ny"), (None, line), (2, line + "\nz"), (3, "\x85" + line)], "doc_id long, text string")
    found = Counter((r["doc_id"], r["text"], r["n_dropped"]) for r in dedup_lines(df).collect())
    assert found == Counter({(1, line, 0): 2, (2, "x\ny", 1): 1, (None, line, 0): 1, (2, "z", 1): 1, (3, "\x85" + line, 0): 1})


# --- quality ----------------------------------------------------------------


def slow_ngrams(text):
    tokens = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x09-\x0d\x20]+", text.encode())
    return Counter(tokens), Counter(zip(tokens, tokens[1:]))


def test_ngrams_are_unigrams_bigrams_and_repeats():
    import pyarrow as pa

    texts = ["ab, cd!! ab\nab ab", "", "é x é x", "ab, cd"]
    owner, bucket = I.ngrams(pa.array(texts), 1 << 30)
    for k, t in enumerate(texts):
        one, two = slow_ngrams(t)
        again = 2 if k == 0 else 0
        assert (owner == k).sum() == sum(one.values()) + sum(two.values()) + again
        assert len(set(bucket[owner == k].tolist())) == len(one) + len(two) + bool(again)
    assert set(bucket[owner == 3].tolist()) <= set(bucket[owner == 0].tolist())


@pytest.fixture(scope="module")
def graded(llm_spark):
    """400 documents, a quarter of them junk in one of two forms, half labelled."""
    rng = random.Random(4)
    stock = [a + b for a in ("the", "an", "er", "sho", "ti") for b in ("ing", "la", "xu", "do", "na")]
    rows, labels = [], []
    for k in range(400):
        words = rng.choices(stock, k=rng.randint(5, 150))
        bad = k % 4 == 0
        text = " ".join(w + "$$$" for w in words) if k % 8 == 0 else " ".join(w.upper() + "!!" for w in words) if bad else " ".join(words) + "."
        rows.append((k, text, int(not bad)))
        if k % 2 == 0 or rng.random() < 0.4:
            labels.append((k, int(not bad), 0))
    return llm_spark.createDataFrame(rows, "doc_id long, text string, good int").repartition(4), llm_spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows_are_told_apart(graded):
    docs, labels = graded
    rows = I.classify(docs, labels).join(docs.select("doc_id", "good"), "doc_id").join(labels, "doc_id", "left_anti").collect()
    assert len(rows) > 50 and sum(r["kept"] == (r["good"] == 1) for r in rows) >= 0.97 * len(rows)


def test_weights_equal_a_plain_count(graded):
    docs, labels = graded
    s = I.Settings(buckets=1 << 12)
    sample = I.fit(docs, labels, s)
    roles = {r["doc_id"]: r["role"] for r in I.labelled(labels, s.max_labels).collect()}
    import pyarrow as pa

    grams = {r["doc_id"]: I.ngrams(pa.array([r["text"]]), s.buckets)[1].tolist() for r in docs.collect()}
    raw, target = Counter(x for g in grams.values() for x in g), Counter(x for k, g in grams.items() if roles.get(k) == I.TARGET for x in g)

    def log_p(c, x):
        return math.log((c[x] + s.smoothing) / (sum(c.values()) + s.smoothing * s.buckets))

    for r in sample.scores.limit(40).collect():
        g = grams[r["doc_id"]]
        assert r["log_weight"] == pytest.approx(sum(log_p(target, x) - log_p(raw, x) for x in g) / (len(g) + s.shrink))


def test_top_k_keeps_the_greatest_keys(graded, llm_spark):
    docs, labels = graded
    rows = I.classify(docs, labels).collect()
    kept = [r["sample_key"] for r in rows if r["kept"]]
    assert min(kept) > max(r["sample_key"] for r in rows if not r["kept"])
    rng = np.random.default_rng(0)
    values = [float(v) for v in np.concatenate((rng.normal(size=500), [1.5] * 300, rng.normal(size=5) * 1e9))]
    frame = llm_spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 2, 7, 100, 400, len(values)):
        assert I.kth_greatest(frame, "x", k, bins=7) == sorted(values, reverse=True)[k - 1]
    assert I.kth_greatest(frame, "x", 0) == math.inf


def test_filter_agrees_and_keeps_columns(graded):
    docs, labels = graded
    extra = docs.withColumnRenamed("good", "sample_key")
    kept = I.keep_good(extra, labels)
    assert kept.columns == extra.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in I.classify(docs, labels).filter("kept").collect())


def test_quality_of_odd_rows(docs, empty, llm_spark, texts):
    labels = llm_spark.createDataFrame([], "doc_id long, quality int")
    rows = I.classify(docs, labels).collect()
    assert len(rows) == len(texts) and all(r["kept"] and r["log_weight"] == 0 for r in rows)
    odd = llm_spark.createDataFrame([(0, 1), (0, 0), (None, 1), (3, None), (6, 1), (9, 0)], "doc_id long, quality int")
    assert {(r["doc_id"], r["good"]) for r in I.labelled(odd, 10).collect()} == {(0, 0), (6, 1), (9, 0)}
    assert I.classify(empty, odd).count() == 0 and I.keep_good(empty, odd).count() == 0
    twice = llm_spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None)], "doc_id long, text string")
    keys = [r["sample_key"] for r in I.classify(twice, odd).collect() if r["n_grams"]]
    assert len(keys) == 2 and keys[0] == keys[1]


def test_every_held_out_id_counts_once(graded, llm_spark):
    """Ids that repeat in documents beyond max_labels push no other out of the cut."""
    docs, labels = graded
    s = I.Settings(max_labels=100)
    held = {r["doc_id"]: r["good"] == 1 for r in I.labelled(labels, s.max_labels).filter(f"role = {I.HELD_OUT}").collect()}
    often = llm_spark.createDataFrame([(k, 300 if held.get(k) else 1) for k in range(400)], "doc_id long, times int")
    many = docs.join(often, "doc_id").selectExpr("doc_id", "text", "explode(sequence(1, times)) as copy").orderBy("copy", ascending=False).coalesce(1)
    many = many.unionByName(many.selectExpr("doc_id", "'ab ' || text as text", "copy").filter("copy = 1"))
    sample = I.fit(many, labels, s)
    weights = defaultdict(list)
    for r in sample.scores.collect():
        weights[r["doc_id"]].append(r["log_weight"])
    want = I.best_cut(np.array([min(weights[k]) for k in held]), np.array(list(held.values())))
    assert sample.cut == want > -math.inf


# --- chats ------------------------------------------------------------------


def slow_chats(turns):
    talks = defaultdict(set)
    for conv, turn, role, text in turns:
        if conv is not None:
            talks[conv].add((-1 if turn is None else turn, role or "", text or ""))
    talks = {c: [x[1:] for x in sorted(t)] for c, t in talks.items()}
    out = {}
    for c, own in talks.items():
        if not any(len(o) > len(own) and o[:len(own)] == own or o == own and d < c for d, o in talks.items()):
            out[c] = (len(own), sum(o == own for o in talks.values()), "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in own))
    return out


def test_snapshots_collapse(llm_spark):
    rng = random.Random(5)
    turns = []
    for base in range(12):
        own = [("user" if k % 2 == 0 else "assistant", "hello" if k == 0 else f"t{base % 5} {rng.randint(0, 1)} {k}") for k in range(rng.randint(1, 30))]
        for copy in range(4):
            n = rng.randint(1, len(own))
            turns += [(base * 10 + copy, k, *x) for k, x in enumerate(own[:n])]
    turns += [(500, 0, None, None), (None, 0, "user", "lost"), (501, None, "system", "first"), (501, 3, "user", "then"), turns[0], turns[0]]
    frame = llm_spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn int, role string, text string, n_turns int").repartition(4)
    for block in (1024, 4):
        rows = defaultdict(list)
        for r in chat.format_chats(frame, block).collect():
            rows[r["conv_id"]].append(r)
        got = {c: (x[0]["n_turns"], x[0]["n_copies"], "".join(r["rendered"] for r in sorted(x, key=lambda r: r["part"]))) for c, x in rows.items()}
        assert got == slow_chats(turns)
    assert chat.format_chats(frame.limit(0)).count() == 0


def test_many_turns_without_a_number_are_many_groups(llm_spark):
    turns = [(1, None, "user", f"u{k}") for k in range(5000)] + [(2, 7, "user", "same")] * 3000 + [(2, 7, "user", f"v{k}") for k in range(60)] + [(3, 7, "user", "same")]
    frame = llm_spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(4)
    placed = chat.places(chat._turns(frame).select("conv_id", "turn", "h1", "h2").distinct(), 256)
    assert sorted(r.pos for r in placed.filter("conv_id = 1").collect()) == list(range(1, 5001))
    rows = chat.format_chats(frame, 256).collect()
    assert sorted(r.part for r in rows if r.conv_id == 1) == list(range(20)) and max(r.part_turns for r in rows) == 256
    said = "".join(r.rendered for r in sorted(rows, key=lambda r: r.part) if r.conv_id == 1)
    assert sorted(said.split("<|im_start|>user\n")[1:]) == sorted(f"u{k}<|im_end|>\n" for k in range(5000))
    assert sum(r.part_turns for r in rows if r.conv_id == 2) == 61


# --- licences ---------------------------------------------------------------


def slow_licenses(texts):
    words = {k: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or "")) for k, t in texts.items()}
    out = {}
    for k, own in words.items():
        places, base, labels, score = [], set(), set(), 0.0
        for t in licenses.BASE:
            p = t.notice.split()
            at = [i for i in range(len(own)) if own[i:i + len(p)] == p]
            places += at
            base |= {t.label} if at else set()
        for t in licenses.TEMPLATES:
            notice, key = t.notice.split(), t.key.split()
            begin = next(i for i in range(len(notice)) if notice[i:i + len(key)] == key)
            for p in [i - begin for i in range(len(own)) if own[i:i + len(key)] == key]:
                # the phrase stands in full, so all of its rarest words agree on the place
                match = [0 <= p + i < len(own) and own[p + i] == w for i, w in enumerate(notice)]
                labels.add(t.label)
                score = max(score, sum(match) / len(notice))
        out[k] = (len(own), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | labels)), score)
    return out


def test_a_place_needs_its_whole_phrase_only(llm_spark):
    """The plain version and the operator agree where other template words abound."""
    own = {1: "subject to the terms of the V of any copy associated " * 20 + "Mozilla Public License 2.0.", 2: "Mozilla Public License",
           3: "permission is hereby granted free of charge to use this font any associated copy documentation", 4: "mozilla public", 5: None,
           6: "software files copy any person " * 3000 + "permission is hereby granted, free of charge", 7: "under the mit license under the mit license"}
    frame = llm_spark.createDataFrame(list(own.items()), "doc_id long, text string").repartition(3)
    assert {r[0]: tuple(r[1:7]) + (pytest.approx(r["score"]),) for r in licenses.scan_licenses(frame).collect()} == slow_licenses(own)


def test_licenses_over_a_table(llm_spark, docs, empty, texts):
    own = {3 * k: t for k, t in enumerate(texts)}
    own |= {1000: "MIT License mit-license MIT\nLicense. This work is licensed under the GNU General Public License, version 3.", 1001: "éMIT License mitlicense general public",
            1002: "cc by nc 4 0", 1003: "permission is hereby granted, free of charge. license", 1004: "Licensed under CC BY-NC 4.0.", 1005: "mit license " * 300,
            1006: "Redistribution and use in source and binary forms, with or without modification, are permitted provided"}
    frame = llm_spark.createDataFrame([(k, t, 1) for k, t in own.items()], "doc_id long, text string, n_words int").repartition(4)
    rows = licenses.scan_licenses(frame).collect()
    assert {r[0]: tuple(r[1:7]) + (pytest.approx(r["score"]),) for r in rows} == slow_licenses(own)
    assert licenses.scan_licenses(empty).count() == 0
    twice = llm_spark.createDataFrame([(None, "mit license"), (None, "mit license")], "doc_id long, text string")
    assert [r["n_base"] for r in licenses.scan_licenses(twice).collect()] == [1, 1]


def test_a_phrase_keeps_its_label_in_any_text(llm_spark):
    """Template words elsewhere in the text, however rare, take no phrase its label."""
    mozilla, granted = "Mozilla Public License 2.0.", "Permission is hereby granted, free of charge, to use this font."
    own = {1: mozilla, 2: mozilla + " some filler" * 2000 + " subject, terms of the V to", 3: granted, 4: "any associated copy documentation files. " + "more " * 2000 + granted}
    own |= {10 + k: "mozilla public license 2 0 permission is hereby granted free of charge to this" for k in range(5)}
    rows = {r["doc_id"]: r for r in licenses.scan_licenses(llm_spark.createDataFrame(list(own.items()), "doc_id long, text string")).collect()}
    assert [rows[k]["labels"] for k in (1, 2, 3, 4)] == ["mpl-2.0", "mpl-2.0", "mit", "mit"]
    assert rows[1]["score"] == rows[2]["score"] > 0 and rows[3]["score"] == rows[4]["score"] > 0


# --- weighted sampling ------------------------------------------------------


def test_collision_rate_is_generalised_jaccard():
    rng = random.Random(0)
    stock, errors = [f"w{i}" for i in range(300)], []
    for seed in range(40):
        a = rng.choices(stock, k=250, weights=[1 / (i + 1) for i in range(300)])
        b = a[:rng.randint(0, 250)] + rng.choices(stock, k=120)
        x, y = Counter(a), Counter(b)
        s = W.signatures([" ".join(a), " ".join(b)], 256, seed)
        errors.append(W.likeness(s[:1], s[1:])[0] - sum((x & y).values()) / sum((x | y).values()))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05


def test_signature_does_not_depend_on_company(texts):
    own = [t or "" for t in texts]
    whole = W.signatures(own)
    assert all(np.array_equal(W.signatures([t])[0], whole[k]) for k, t in enumerate(own[:60]))
    assert np.array_equal(W.signatures(["A b b"]), W.signatures(["b, a; B"])) and not W.signatures([" ! "]).any()


def plain_signature(text, slots, seed=42):
    """A signature term by term, from the words' hashes and the method's text."""
    words = Counter(re.findall(r"[0-9a-z\u0080-\U0010ffff]+", text.lower()))
    if not words:
        return [0] * slots
    names = list(words)
    spelled = [w.encode() for w in names]
    buf = np.frombuffer(b" ".join(spelled), np.uint8)
    end = np.cumsum([len(w) + 1 for w in spelled]) - 1
    r, b, base = W._variates(span_hashes(buf, end - [len(w) for w in spelled], end), slots, seed)
    out = []
    for slot in range(slots):
        least = None
        for k, w in enumerate(names):
            own_r, own_b = float(r[k, slot]), float(b[k, slot])
            log_c = float(base[k, slot]) + own_r - own_r * own_b
            t = math.floor(math.log(words[w]) / own_r + own_b)
            value = log_c - own_r * (t - own_b) - own_r
            if least is None or value < least[0]:
                least = (value, w, t)
        out.append(least)
    return out


def test_each_slot_takes_the_term_of_least_value():
    """Two texts share a slot exactly where plain sampling takes the same (term, t)."""
    rng = random.Random(12)
    stock = [f"w{k}" for k in range(40)] + ["é", "12", "ñandú"]
    texts = [" ".join(rng.choices(stock, k=rng.randint(1, 60))) for _ in range(12)]
    found, plain = W.signatures(texts), [plain_signature(t, W.SLOTS) for t in texts]
    same = total = 0
    for i in range(len(texts)):
        for j in range(i):
            for slot in range(W.SLOTS):
                a, b = plain[i][slot], plain[j][slot]
                equal = a[1:] == b[1:]
                total += 1
                same += (found[i, slot] == found[j, slot]) == equal
    assert same >= 0.9995 * total  # 16 bits of hash may meet by chance


def test_variates_follow_their_distributions():
    """r and c are Gamma(2, 1), b is uniform, all independent of the slot."""
    hashes = W.mix(np.arange(4000, dtype=np.uint64))
    r, b, base = W._variates(hashes, 16, 42)
    c = np.exp(base + r - r * b)
    for x in (r, c):
        assert abs(x.mean() - 2) < 0.03 and abs(x.var() - 2) < 0.1
    assert abs(b.mean() - 0.5) < 0.01 and abs(b.var() - 1 / 12) < 0.003
    assert abs(np.corrcoef(r.ravel(), b.ravel())[0, 1]) < 0.02 and abs(np.corrcoef(r.ravel(), c.ravel())[0, 1]) < 0.02


def test_rows_of_one_id_lie_in_many_ranges(llm_spark):
    rows = [(None if k % 2 else 5, f"text {k} " + "word " * (k % 7)) for k in range(400)]
    frame = llm_spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = W.edited_fingerprints(frame).collect()
    assert len(found) == 400 and Counter(r.doc_id for r in found) == {None: 200, 5: 200}
    assert sorted(r.n_chars for r in found) == sorted(len(t) for _, t in rows)


def test_fingerprints_over_a_table(docs, empty, texts, llm_spark, monkeypatch):
    own = [t or "" for t in texts]
    for gather in (1 << 20, 100):
        monkeypatch.setattr(W, "GATHER", gather)
        rows = {r["doc_id"]: r for r in W.edited_fingerprints(docs.withColumnRenamed("lang", "border")).collect()}
        assert len(rows) == len(own)
        for k, t in enumerate(own):
            after, r = own[(k + 1) % len(own)], rows[3 * k]
            half = len(t) // 2
            new = t[:len(t) - half] + after[:half]
            a, b, c = W.signatures([t, new, after])
            assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
            assert r["fingerprint"] == a.astype(">u2").tobytes().hex() and r["edited_fingerprint"] == b.astype(">u2").tobytes().hex()
            assert r["near_edited"] == (a == b).mean() and r["near_next"] == (a == c).mean()
    assert W.edited_fingerprints(empty).count() == 0
    one = W.edited_fingerprints(llm_spark.createDataFrame([(1, "ab cd")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    odd = W.edited_fingerprints(llm_spark.createDataFrame([(None, "x y"), (2, "z z"), (2, "z z")], "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] or 0 for r in odd) == [0, 2, 2]
