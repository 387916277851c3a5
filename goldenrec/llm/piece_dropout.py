"""SentencePiece BPE with seeded merge-dropout, and its lossless decoding.

The agenda of a segment holds every pair of neighbouring symbols whose string
is a piece; the best score goes first, the leftmost of equal ones. A candidate
whose keyed hash (seed, document, begin, middle and end of the two symbols) is
under the dropout rate is skipped when its turn comes. As the hash depends on
the candidate alone, a document is always cut the same way for a seed, on any
machine, and differently for another seed. Without dropout the pieces are the
library's own.

The library takes a space mark in a text for a space, so it does not come back.
With ``own_marks`` such a mark becomes its three byte pieces instead, and every
text comes back as it was.

A text is cut into segments before each space mark that follows another sign,
which no piece of such a model crosses. All segments of a slice of texts take
their agenda's next candidate at once, in array operations; very long segments
(text without spaces) take theirs one by one from a heap.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldenrec.llm.text import mix, slices, text_of

MARK = "▁"  # stands for a space
OWN = "\ud800"  # stands for a text's own mark: no text holds half a surrogate pair
LONG = 64  # at most 255: places in short segments take a byte
SLICE = 1 << 17  # bytes of text at once: the arrays of a slice stay in a core's cache
NO = np.int64(1) << np.int64(62)
_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


class Model:
    """Pieces, pair table and decoder of a SentencePiece BPE model file."""

    def __init__(self, path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = " a  b\tc" + MARK + "d "
        if sp.normalize(probe) != MARK + probe.replace(" ", MARK) or sp.id_to_piece(sp.unk_id()) != "<unk>":
            raise ValueError("a model with a dummy prefix and no other normalization is expected")
        plain = {sp.id_to_piece(i): i for i in range(sp.vocab_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        if any(MARK in p.lstrip(MARK) for p in plain):
            raise ValueError("pieces that cross a space are not supported")
        self.unknown = sp.unk_id()
        #: Signs that are in pieces but are none themselves get symbols of their own.
        symbols = dict(plain)
        for p in plain:
            for c in p:
                symbols.setdefault(c, len(symbols) + sp.vocab_size())
        self.is_piece = sp.vocab_size()
        self.of_sign = np.full(0x110000, -1, np.int32)
        for s, i in symbols.items():
            if len(s) == 1:
                self.of_sign[ord(s)] = i
        order = sorted(plain, key=lambda p: (-sp.get_score(plain[p]), plain[p]))
        self.rank = np.zeros(sp.vocab_size(), np.int64)
        self.rank[[plain[p] for p in order]] = np.arange(len(order))
        # Equal scores are one rank: the leftmost goes first.
        score = np.array([sp.get_score(plain[p]) for p in order])
        self.rank[[plain[p] for p in order]] = np.searchsorted(-score, -score)
        self.pairs = {symbols[p[:k]] << 20 | symbols[p[k:]]: i for p, i in plain.items() for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols}
        self._hash_pairs()
        self.byte = {bytes([b]): sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
        self.bytes_of = [b""] * sp.vocab_size()
        for p, i in plain.items():
            self.bytes_of[i] = p.replace(MARK, " ").encode()
        for b, i in self.byte.items():
            if i == self.unknown:
                raise ValueError("a model with byte pieces is expected")
            self.bytes_of[i] = b

    def _hash_pairs(self) -> None:
        """Open addressing; an entry holds the pair and the piece it makes."""
        bits = max(4, (2 * len(self.pairs)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.entries = np.full(1 << bits, -1, np.int64)
        for key, value in self.pairs.items():
            at = (key * int(_C[0]) & (1 << 64) - 1) >> int(self.shift)
            while self.entries[at] >= 0:
                at = (at + 1) & (len(self.entries) - 1)
            self.entries[at] = key << 20 | value

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two symbols make, -1 if none. A symbol is under 2**20,
        or -1."""
        key = left.astype(np.int64)
        key <<= 20
        key |= right  # negative if either symbol is
        at = ((key.view(np.uint64) * _C[0]) >> self.shift).view(np.int64)
        found = self.entries.take(at)
        hit = found >> 20 == key
        out = np.where(hit, found & 0xFFFFF, -1)
        going = np.flatnonzero(~hit & (found >= 0) & (key >= 0))
        while len(going):
            at[going] = (at[going] + 1) & (len(self.entries) - 1)
            found = self.entries[at[going]]
            hit = found >> 20 == key[going]
            out[going[hit]] = found[hit] & 0xFFFFF
            going = going[~hit & (found >= 0)]
        out[key < 0] = -1
        return out

    # -- decoding

    def decode(self, ids) -> str:
        """The text that the ids encode. Marks turn to spaces piece by piece, so
        one that is spelled in byte pieces stays."""
        text = b"".join([self.bytes_of[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text

    # -- encoding

    def encode(self, texts: list[str], keys: np.ndarray, dropout: float, seed: int, own_marks: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's end). ``keys``: uint64 per text."""
        if own_marks:
            texts = [t.replace(MARK, OWN) for t in texts]
        marked = [MARK + t.replace(" ", MARK) if t else "" for t in texts]
        signs = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter(map(len, marked), np.int64, len(marked))
        doc = np.repeat(np.arange(len(marked)), sizes)
        origin = np.repeat(np.cumsum(sizes) - sizes, sizes)
        is_mark = signs == ord(MARK)
        begins = np.zeros(len(signs), bool)
        if len(signs):
            begins[1:] = is_mark[1:] & ~is_mark[:-1]
            begins[np.cumsum(sizes)[sizes > 0] - sizes[sizes > 0]] = True
        first = np.flatnonzero(begins)
        length = np.diff(np.append(first, len(signs)))
        symbol = self.of_sign[signs].astype(np.int64)
        keyed = mix(keys ^ mix(np.full(1, seed, np.uint64)))
        drop = _Drop(keyed, doc, origin, dropout)
        starts, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for k in np.flatnonzero(length > LONG).tolist():
            s, i = self._agenda(symbol[first[k]:first[k] + length[k]], int(first[k]), drop)
            starts.append(s)
            ids.append(i)
        short = length <= LONG
        s, i = self._together(symbol, first[short], length[short], drop)
        starts.append(s)
        ids.append(i)
        start, found = np.concatenate(starts), np.concatenate(ids)
        order = np.argsort(start, kind="stable")
        return self._with_bytes(start[order], found[order], signs, doc, len(texts))

    def _with_bytes(self, start, ids, signs, doc, n) -> tuple[np.ndarray, np.ndarray]:
        """Signs that are no piece become their bytes."""
        owner = doc[start]
        odd = np.flatnonzero((ids < 0) | (ids >= self.is_piece))
        if len(odd):
            raw = [(MARK if c == ord(OWN) else chr(c)).encode() for c in signs[start[odd]].tolist()]
            count = np.ones(len(ids), np.int64)
            count[odd] = [len(r) for r in raw]
            out = np.repeat(ids, count)
            at = np.repeat(np.cumsum(count)[odd] - count[odd], count[odd])
            at += np.arange(len(at)) - np.repeat(np.cumsum(count[odd]) - count[odd], count[odd])
            out[at] = [self.byte[r[k:k + 1]] for r in raw for k in range(len(r))]
            ids, owner = out, np.repeat(owner, count)
        return ids.astype(np.int32), np.searchsorted(owner, np.arange(n), "right")

    def _agenda(self, symbol: np.ndarray, offset: int, drop: "_Drop") -> tuple[np.ndarray, np.ndarray]:
        """One segment: (begins of the symbols left, symbols)."""
        a, n = symbol.tolist(), len(symbol)
        end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple] = []

        def add(i: int, j: int) -> None:
            new = self.pairs.get(a[i] << 20 | a[j], -1) if a[i] >= 0 and a[j] >= 0 else -1
            if new >= 0 and not drop.one(offset + i, offset + j, offset + end[j]):
                heapq.heappush(heap, (int(self.rank[new]), i, j, end[j], new))

        for i in range(n - 1):
            add(i, i + 1)
        alive = [True] * n
        while heap:
            _, i, j, upto, new = heapq.heappop(heap)
            if not (alive[i] and alive[j]) or end[i] != j or end[j] != upto:
                continue
            a[i], end[i], alive[j], after[i] = new, upto, False, after[j]
            if after[i] < n:
                before[after[i]] = i
                add(i, after[i])
            if before[i] >= 0:
                add(before[i], i)
        left = [i for i in range(n) if alive[i]]
        return np.array(left, np.int64) + offset, np.array([a[i] for i in left], np.int64)

    def _together(self, symbol, first, length, drop: "_Drop") -> tuple[np.ndarray, np.ndarray]:
        """Short segments, each taking its best candidate in every round."""
        count = int(length.sum())
        seg_at = np.cumsum(length) - length
        within = np.arange(count) - np.repeat(seg_at, length)
        begin = (within + np.repeat(first, length)).astype(np.int32)
        rel = within.astype(np.uint8)
        a, stop = symbol[begin].astype(np.int32), begin + np.int32(1)
        last = np.zeros(count, bool)  # ends its segment
        last[seg_at + length - 1] = True
        done_at, done_id = [], []
        # A candidate's turn: rank, place in its segment, and the piece it makes.
        order = np.full(count, NO, np.int64)

        def price(i: np.ndarray) -> None:
            """Candidates of the symbols at i, none of them the last of its
            segment, with their right neighbours."""
            new = self.merged(a[i], a[i + 1])
            fits = np.flatnonzero(new >= 0)
            j = i[fits]
            stays = ~drop.many(begin[j], stop[j], stop[j + 1])
            order[i] = NO
            j, new = j[stays], new[fits[stays]]
            order[j] = self.rank[new] << 28 | rel[j].astype(np.int64) << 20 | new

        price(np.flatnonzero(~last))
        while len(a):
            seg_at = np.flatnonzero(np.concatenate(([True], last[:-1])))
            best = np.minimum.reduceat(order, seg_at)
            size = np.diff(np.append(seg_at, len(a)))
            turn = np.repeat(best, size)
            i = np.flatnonzero((order == turn) & (turn != NO))
            keep = turn != NO
            out = np.flatnonzero(~keep)
            if len(out):
                done_at.append(begin[out].astype(np.int64))
                done_id.append(a[out].astype(np.int64))
            a[i], stop[i], last[i] = order[i] & 0xFFFFF, stop[i + 1], last[i + 1]
            keep[i + 1] = False
            place = np.cumsum(keep)[i] - 1
            stay = np.flatnonzero(keep)
            a, begin, stop, rel, last, order = (x.take(stay) for x in (a, begin, stop, rel, last, order))
            order[place] = NO
            left = place[rel[place] > 0] - 1
            price(np.concatenate((place[~last[place]], left)))
        if not done_at:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(done_at), np.concatenate(done_id)


class _Drop:
    """Which candidates are skipped: a hash of the document's key and the places
    of the two symbols in the document."""

    def __init__(self, keys: np.ndarray, doc: np.ndarray, origin: np.ndarray, rate: float):
        self.base = keys[doc] - origin.astype(np.uint64) * np.uint64(sum(map(int, _C)) & (1 << 64) - 1)
        self.under = np.uint64(min(int(rate * 2.0 ** 64), 2 ** 64 - 1))

    def many(self, begin: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
        if not self.under or not len(begin):
            return np.zeros(len(begin), bool)
        place = self.base.take(begin)
        for at, factor in zip((begin, middle, end), _C):
            place += at.astype(np.uint64) * factor
        return mix(place) < self.under

    def one(self, begin: int, middle: int, end: int) -> bool:
        return bool(self.under) and bool(self.many(np.array([begin]), np.array([middle]), np.array([end]))[0])


_kept: dict[str, Model] = {}


def model(path: str) -> Model:
    """The model of a file; read once in each Python worker."""
    if path not in _kept:
        _kept[path] = Model(path)
    return _kept[path]


def _keys(ids: pa.Array) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh64_intdigest("" if i is None else str(i)) for i in ids.to_pylist()], np.uint64)


def encode(docs: DataFrame, model_path: str, dropout: float = 0.1, seed: int = 42, id_col: str = "doc_id", text_col: str = "text",
           carry: tuple[str, ...] = (), own_marks: bool = False) -> DataFrame:
    """(doc_id, ids) for each row of ``docs``, and its columns ``carry``.

    NULL texts count as empty and have no ids. Rows with the same id and text
    are cut alike; a NULL id is a key like any other. With ``dropout`` 0 the ids
    are those of the library; at 1 no merge is made. With ``own_marks`` space
    marks in the texts become byte pieces, which ``decode`` brings back. Other columns are not read,
    so names cannot clash. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"), *(F.col(c) for c in carry))
    names = ["doc_id", "ids", *carry]

    def run(batches):
        own = model(model_path)
        for batch in batches:
            for part in slices(batch, most=SLICE):
                ids, ends = own.encode(part.column(1).to_pylist(), _keys(part.column(0)), dropout, seed, own_marks)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([part.column(0), lists, *part.columns[2:]], names)

    fields = {f.name: f for f in rows.schema.fields}
    schema = T.StructType([fields["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType())), *(fields[c] for c in carry)])
    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``encoded`` with the text that its ids stand for; NULL ids give NULL. A
    column named ``out_col`` is replaced. Every text comes back as it was if it
    was encoded with ``own_marks``; otherwise the space mark itself comes back as
    a space, as the library has it."""
    names = [c for c in encoded.columns if c != out_col]
    rows = encoded.select(*names)
    at = names.index(ids_col)
    schema = T.StructType([*rows.schema.fields, T.StructField(out_col, T.StringType())])

    def run(batches):
        own = model(model_path)
        for batch in batches:
            flat, ends = batch.column(at).flatten().to_numpy(zero_copy_only=False).tolist(), batch.column(at).value_lengths().fill_null(0).to_numpy(zero_copy_only=False).cumsum().tolist()
            texts = [None if null else own.decode(flat[a:b]) for a, b, null in zip([0, *ends], ends, batch.column(at).is_null().to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, out_col])

    return rows.mapInArrow(run, schema)
