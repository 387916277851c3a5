"""A byte-level BPE tokenizer compiled to deterministic transducers.

Two machines read a text.

*Piece machine.* It cuts a text where the tokenizer's splitting pattern cuts
it. Its input is one class per character, it has eleven states, and each
transition says where pieces begin. Chunks of a text are read from all states
at once, which gives each chunk's state map; a parallel prefix scan composes
the maps, so each chunk learns the state it begins in without waiting for the
chunks before it.

*Merge machine.* It reads a piece byte by byte. Each transition is annotated
with the number of tokens that the byte adds to the encoding of the piece so
far (negative when a byte makes tokens fuse); the sum over a piece is its
token count. States come from a subset construction over the vocabulary's
prefix tree: a state holds every place where a token may still be open, the
token that ends there, and the count up to there. A prefix of a text has one
last token, and a token may follow another if no merge crosses their border
earlier than the merges that form the two, so a state determines the next one.
States are found as texts need them and kept in a table of bounded size.

The machine's state after a piece also names the piece's last token, so the
same run yields the token ids by walking back from the end.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import regex

# --- Piece machine ----------------------------------------------------------
# Character classes: letters that may form 's 't 'm 'd, 're 've, 'll are apart.
(LETTER, ONE, R_V, E, L, DIGIT, SPACE, BLANK, QUOTE, OTHER, END) = range(11)
# States: at the begin of a piece; in letters; in digits; in other signs; after
# a quote that begins a piece; after 'r or 'v; after 'l; after one space; after
# blanks that end in a space; after one other blank; after blanks that end in one.
(FRESH, WORD, NUMBER, SIGNS, APO, APO_E, APO_L, SP, SP_MORE, BL, BL_MORE) = range(11)
HERE, BEFORE = 1, 2  # a piece begins at this character / at the one before it

CHUNK = 256


@lru_cache(1)
def character_classes() -> np.ndarray:
    """Class of every code point, from the Unicode properties the splitting
    pattern names."""
    everything = "".join(map(chr, [*range(0xD800), *[0] * 0x800, *range(0xE000, 0x110000)]))
    table = np.full(0x110000, OTHER, np.uint8)
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", DIGIT), (r"\p{White_Space}+", BLANK)):
        for m in regex.finditer(pattern, everything):
            table[m.start():m.end()] = kind
    for letters, kind in (("stmd", ONE), ("rv", R_V), ("e", E), ("l", L), (" ", SPACE), ("'", QUOTE)):
        for ch in letters:
            table[ord(ch)] = kind
    return table


def _piece_transition(state: int, kind: int) -> tuple[int, int]:
    """(next state, where pieces begin) of the splitting pattern."""
    letter = kind in (LETTER, ONE, R_V, E, L)
    body = WORD if letter else {DIGIT: NUMBER, QUOTE: SIGNS, OTHER: SIGNS}.get(kind)
    if kind == END:
        return FRESH, HERE | (BEFORE if state in (APO_E, APO_L) else 0)
    if state == APO:
        if kind == ONE:
            return FRESH, 0
        if kind in (R_V, L):
            return (APO_E if kind == R_V else APO_L), 0
        if kind in (QUOTE, OTHER):
            return SIGNS, 0
    if (state, kind) in ((APO_E, E), (APO_L, L)):
        return FRESH, 0
    if state in (APO_E, APO_L):  # no contraction: the letter began a word
        follow, begins = _piece_transition(WORD, kind)
        return follow, begins | BEFORE
    if state in (SP, SP_MORE, BL, BL_MORE):
        if kind in (SPACE, BLANK):
            return (SP_MORE if kind == SPACE else BL_MORE), 0
        if state in (SP, SP_MORE):  # the last space goes with what follows
            return body, (BEFORE if state == SP_MORE else 0)
        follow, begins = _piece_transition(FRESH, kind)
        return follow, begins | (BEFORE if state == BL_MORE else 0)
    if (state, body) in ((WORD, WORD), (NUMBER, NUMBER), (SIGNS, SIGNS)):
        return state, 0
    if kind in (SPACE, BLANK):
        return (SP if kind == SPACE else BL), HERE
    return (APO if kind == QUOTE else body), HERE


@lru_cache(1)
def piece_tables() -> tuple[np.ndarray, np.ndarray]:
    to, begins = np.zeros((11, 16), np.uint8), np.zeros((11, 16), np.uint8)
    for s in range(11):
        for k in range(11):
            to[s, k], begins[s, k] = _piece_transition(s, k)
    return to.reshape(-1), begins.reshape(-1)


def compose_scan(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition of state maps (chunks x states) in a
    logarithmic number of parallel steps."""
    out, step = maps.copy(), 1
    while step < len(out):
        out[step:] = np.take_along_axis(out[step:], out[:-step], axis=1)
        step *= 2
    return out


def piece_begins(kinds: np.ndarray) -> np.ndarray:
    """Positions where a piece begins, END characters included."""
    to, begins = piece_tables()
    n = len(kinds)
    rows = np.full((-(-n // CHUNK), CHUNK), END, np.uint8)
    rows.reshape(-1)[:n] = kinds
    rows = np.ascontiguousarray(rows.T)
    state = np.repeat(np.arange(11, dtype=np.uint8)[:, None], rows.shape[1], axis=1)
    for row in rows:
        state = to.take((state << 4) | row)
    scan = compose_scan(np.ascontiguousarray(state.T))
    state = np.concatenate((np.array([FRESH], np.uint8), scan[:-1, FRESH]))
    marks = np.empty(rows.shape, np.uint8)
    for k, row in enumerate(rows):
        at = (state << 4) | row
        marks[k] = begins.take(at)
        state = to.take(at)
    marks = np.ascontiguousarray(marks.T).reshape(-1)[:n]
    at = (marks & HERE).astype(bool)
    at[:-1] |= (marks[1:] & BEFORE).astype(bool)
    return np.flatnonzero(at)


# --- Merge machine ----------------------------------------------------------


def byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in the vocabulary file: bytes that
    print are themselves, the others take the signs from 256 on, in order."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Transducer:
    """Counts tokens and encodes texts as the tokenizer of ``path`` does."""

    #: States kept. A row of the table takes 1 KB once it is used; when the
    #: table is full it is begun anew with the states in use.
    MOST_STATES = 1 << 17
    FEW = 24
    NONE = 0xFFFF  # before a piece's first token

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec.get("normalizer") or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("a byte-level BPE tokenizer without normalizer is expected")
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        signs, vocab = byte_signs(), spec["model"]["vocab"]
        word = {i: bytes(signs[c] for c in s) for s, i in vocab.items() if s not in self.special}
        most = max(word) + 1
        self.size = np.zeros(most, np.int64)
        self.born, self.left, self.right = [-1] * most, [-1] * most, [-1] * most
        self.rank: dict[int, int] = {}
        for k, (a, b) in enumerate(tuple(m.split(" ")) if isinstance(m, str) else m for m in spec["model"]["merges"]):
            x, y, z = vocab[a], vocab[b], vocab[a + b]
            self.rank[x << 16 | y] = k
            if self.born[z] < 0:
                self.born[z], self.left[z], self.right[z] = k, x, y
        self.made = {x: z for z in word for x in [self.left[z] << 16 | self.right[z]] if self.born[z] >= 0}
        self.tree: dict[int, int] = {}
        self.token_at = [-1]
        self.single = {w[0]: i for i, w in word.items() if len(w) == 1}
        for i, w in word.items():
            self.size[i] = len(w)
            at = 0
            for b in w:
                key = at << 8 | b
                at = self.tree.setdefault(key, len(self.token_at))
                if at == len(self.token_at):
                    self.token_at.append(-1)
            self.token_at[at] = i
        self.word = word
        self.below: list[list[int]] = [[] for _ in self.token_at]  # tokens that go on from a node, up to FEW
        for i, w in word.items():
            at = 0
            for b in w[:-1]:
                at = self.tree[at << 8 | b]
                if len(self.below[at]) <= self.FEW:
                    self.below[at].append(i)
        self.fits: dict[int, bool] = {}
        self.alike: dict[int, int] = {}
        self.first: dict[tuple, int] = {}
        self._begin()

    # -- lazily determinized states; a place is one number: node, token that ends
    # where the node begins, and 128 + the count up to there, from the last byte

    def _begin(self) -> None:
        self.step = np.zeros(self.MOST_STATES << 8, np.int32)  # next state << 8 | count + 128; 0 is not known yet
        self.last = np.zeros(self.MOST_STATES, np.int32)
        self.sets: list[tuple] = [()]
        self.number: dict[tuple, int] = {}
        self.start = self._state((self.NONE << 8 | 128,), 0)

    def _state(self, places: tuple, last: int) -> int:
        got = self.number.get(places)
        if got is None:
            got = self.number[places] = len(self.sets)
            self.sets.append(places)
            self.last[got] = last
        return got

    def _alone(self, token: int) -> bool:
        """Is the token the encoding of its own bytes?"""
        if len(self.word[token]) == 1:
            return True
        parts = [self.single[b] for b in self.word[token]]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get(parts[i] << 16 | parts[i + 1], 1 << 30))
            pair = parts[best] << 16 | parts[best + 1]
            if pair not in self.rank:
                return False
            parts[best:best + 2] = [self.made.get(pair, -1)]
            if parts[best] < 0:
                return False
        return parts[0] == token

    def _may_follow(self, a: int, b: int) -> bool:
        """No merge crosses the border of a and b while the symbols beside it
        exist; they are followed back in time, the younger one first."""
        end_a = end_b = 1 << 30
        while True:
            k = self.rank.get(a << 16 | b)
            if k is not None and k < end_a and k <= end_b:
                return False
            if self.born[a] > self.born[b]:
                end_a, a = self.born[a], self.right[a]
            elif self.born[b] >= 0:
                end_b, b = self.born[b], self.left[b]
            else:
                return True

    def _fit(self, a: int, b: int) -> bool:
        key = a << 16 | b
        got = self.fits.get(key)
        if got is None:
            if len(self.fits) > 300_000:
                self.fits.clear()
            got = self.fits[key] = self._alone(b) if a == self.NONE else self._may_follow(a, b) and self._fit(self.NONE, b)
        return got

    def _like(self, node: int, before: int) -> int:
        """The first token seen that allows the same tokens after it, among
        those that begin with ``node``; -1 if it allows none, so the place can
        be left out. Histories that cannot be told apart thus share a state.
        Nodes with many tokens below them keep the token itself."""
        below = self.below[node]
        if len(below) > self.FEW:
            return before
        key = node << 16 | before
        got = self.alike.get(key)
        if got is None:
            if len(self.alike) > 300_000:
                self.alike.clear()
            allowed = tuple([t for t in below if self._fit(before, t)])
            got = self.alike[key] = self.first.setdefault((node, allowed), before) if allowed else -1
        return got

    def _transition(self, state: int, byte: int) -> tuple[tuple, int, int]:
        places, last, count = [], -1, 0
        for place in self.sets[state]:
            before, c = place >> 8 & 0xFFFF, (place & 255) - 128
            to = self.tree.get(place >> 24 << 8 | byte)
            if to is None:
                continue
            token = self.token_at[to]
            if token >= 0 and last < 0 and self._fit(before, token):
                last, count = token, c + 1
            before = self._like(to, before)
            if before >= 0:
                places.append((to << 16 | before) << 8 | c + 128)
        if last < 0:
            raise AssertionError("the vocabulary has no token for this place")
        return (*(p - count for p in places), last << 8 | 128), last, count

    def _learn(self, keys: np.ndarray) -> None:
        for key in keys.tolist():
            places, last, count = self._transition(key >> 8, key & 255)
            self.step[key] = self._state(places, last) << 8 | (count + 128)

    def _room(self, state: np.ndarray) -> np.ndarray:
        """Begins the table anew if it is nearly full; ``state`` in new numbers."""
        if len(self.sets) < self.MOST_STATES - len(state) - 2 and len(self.sets) < self.MOST_STATES // 8 * 7:
            return state
        used, back = np.unique(state, return_inverse=True)
        kept = [(self.sets[s], int(self.last[s])) for s in used.tolist()]
        self._begin()
        return np.array([self._state(*x) for x in kept], np.int64)[back]

    #: Pieces that run at once; bounds the states that one step can add.
    WIDTH = 1 << 15

    def _run(self, buf: np.ndarray, begin: np.ndarray, end: np.ndarray, tokens: np.ndarray | None) -> np.ndarray:
        """Token count of each piece; ``tokens`` gets the last token at each byte."""
        counts = np.zeros(len(begin), np.int64)
        by_size = np.argsort(begin - end, kind="stable")
        for first in range(0, len(begin), self.WIDTH):
            rows = by_size[first:first + self.WIDTH]
            at, length = begin[rows], (end - begin)[rows]
            more = len(rows) - np.cumsum(np.bincount(length)) if len(rows) else []
            state, total = np.full(len(rows), self.start, np.int64), np.zeros(len(rows), np.int64)
            n = len(rows)
            for k in range(int(length[0]) if n else 0):
                n = int(more[k])
                if n < 2:
                    break
                state = self._room(state[:n])
                key = (state << 8) | buf[at[:n] + k]
                got = self.step[key]
                if not got.all():
                    self._learn(np.unique(key[got == 0]))
                    got = self.step[key]
                total[:n] += (got & 255) - 128
                state = (got >> 8).astype(np.int64)
                if tokens is not None:
                    tokens[at[:n] + k] = self.last[state]
            else:
                k = int(length[0]) if n else 0
            if n and k < length[0]:  # one long piece is left
                total[0] += self._one(buf, int(at[0]), int(at[0] + k), int(end[rows[0]]), int(state[0]), tokens)
            counts[rows] = total
        return counts

    def _one(self, buf, begin: int, at: int, end: int, state: int, tokens) -> int:
        total = 0
        for k, byte in enumerate(buf[at:end].tolist(), at):
            if not k % 4096:
                state = int(self._room(np.array([state]))[0])
            key = state << 8 | byte
            got = int(self.step[key])
            if not got:
                if len(self.sets) + 2 >= self.MOST_STATES:
                    state = int(self._room(np.array([state]))[0])
                    key = state << 8 | byte
                self._learn(np.array([key]))
                got = int(self.step[key])
            total += (got & 255) - 128
            state = got >> 8
            if tokens is not None:
                tokens[k] = self.last[state]
        return total

    # -- texts

    def _pieces(self, texts: list[str]):
        """One buffer for all texts: (bytes, piece begins, piece ends, the text
        of each piece, tokens that special strings add to each text, and where
        those stand)."""
        parts, owner, special = [], [], []
        if any(s in t for s in self.special for t in texts):
            cut = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)))
            for k, t in enumerate(texts):
                at = 0
                for m in cut.finditer(t):
                    parts.append(t[at:m.start()])
                    owner.append(k)
                    special.append((len(parts) - 1, k, self.special[m[0]]))
                    at = m.end()
                parts.append(t[at:])
                owner.append(k)
        else:
            parts, owner = texts, range(len(texts))
        flat = "\0".join(parts) + "\0"
        ends = np.cumsum(np.fromiter((len(p) + 1 for p in parts), np.int64, len(parts))) - 1
        buf = np.frombuffer(flat.encode("utf-8"), np.uint8)
        kinds = character_classes().take(np.frombuffer(flat.encode("utf-32-le"), np.uint32))
        kinds[ends] = END
        begins = piece_begins(kinds)
        if len(buf) != len(kinds):
            lead = np.append(np.flatnonzero((buf & 0xC0) != 0x80), len(buf))
            begins, ends = lead[begins], lead[ends]
        part = np.searchsorted(ends, begins)  # the END character is the last of its part
        body = begins != ends[np.minimum(part, len(ends) - 1)]
        stop = np.append(begins[1:], len(buf))
        owner = np.fromiter(owner, np.int64, len(parts))
        return buf, begins[body], stop[body], part[body], owner, special, ends

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        if not texts:
            return np.zeros(0, np.int64)
        buf, begin, end, part, owner, special, _ = self._pieces(texts)
        out = np.bincount(owner[part], self._run(buf, begin, end, None), len(texts)).astype(np.int64)
        for _, k, _ in special:
            out[k] += 1
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(token ids of all texts one after another, where each text's end)."""
        if not texts:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        buf, begin, end, part, owner, special, ends = self._pieces(texts)
        tokens = np.zeros(len(buf), np.int32)
        self._run(buf, begin, end, tokens)
        is_end = np.zeros(len(buf), bool)
        at = end - 1
        while len(at):  # back from each piece's last byte, a token at a time
            is_end[at] = True
            at = at - self.size[tokens[at]]
            going = at >= begin
            at, begin = at[going], begin[going]
        for p, _, token in special:  # in the place of the END character
            is_end[ends[p]], tokens[ends[p]] = True, token
        upto = np.cumsum(is_end)
        last_part = np.append(np.flatnonzero(np.diff(owner)), len(owner) - 1)
        return tokens[is_end], upto[ends[last_part]]


_kept: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """The machine for a tokenizer file; built once in each Python worker."""
    if path not in _kept:
        _kept[path] = Transducer(path)
    return _kept[path]
