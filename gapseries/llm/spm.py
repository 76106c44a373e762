"""SentencePiece encoding and decoding by a batched numpy Viterbi.

A batch of texts is one array of characters, cut into units that no piece can
cross: between two characters that follow each other in no piece. Units are
told apart by 64-bit polynomial hashes that their characters confirm, and each distinct unit is encoded once.
Units of equal length form one character matrix and advance together: the polynomial
hashes of all substrings probe the sorted piece keys, and for each end position
the best (previous score + step) over the piece lengths is a vectorised
maximum whose argument is kept as back pointer.

The step of a unigram model is the piece's score. A BPE model (the public
vocabulary at hand) merges by priority, which no sum of piece scores can
express. Its step is 0 if the piece may follow the best encoding of the
prefix and minus infinity otherwise: a piece sequence is the merge result
exactly if each piece is the merge result of its own string and each
neighbouring pair stays apart when merged together, so each prefix has one
last piece. Whether a pair stays apart is found by undoing the merges next to
the boundary, latest first, and looking for one across it that would have come
earlier (vectorised over all pairs). Units of more than ``LONG`` characters,
or with several space marks (whose pieces tie in score), take a scalar merge
with a heap instead; results are the same.

The model file is read on the driver (its size is checked) and broadcast.
"""

from __future__ import annotations

import heapq
import struct
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapseries.llm.common import arrow_rows, pieces, without

SPACE = "▁"
LONG = 64
MAX_MODEL_BYTES = 64 << 20
CACHED = 400_000                     # units whose encoding a task keeps, in two generations
KEPT = 50_000                        # of them, for the next task in the same worker
CHARACTERS = 0x110000
DENSE = 4096                         # joining characters up to which all pairs are a table
_HASH = np.uint64(0x9E3779B97F4A7C15)
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def _fields(data: bytes):
    """Fields (number, value) of a protocol buffer message."""
    at = 0
    while at < len(data):
        values = []
        for _ in range(2):                   # the key, then a varint value or a length
            value = shift = 0
            while True:
                byte = data[at]
                at += 1
                value |= (byte & 127) << shift
                shift += 7
                if byte < 128:
                    break
            values.append(value)
            if len(values) == 1 and value & 7 in (1, 5):
                break
        kind = values[0] & 7
        if kind in (1, 5):
            size = 8 if kind == 1 else 4
            yield values[0] >> 3, struct.unpack("<d" if kind == 1 else "<f", data[at:at + size])[0]
            at += size
        elif kind == 2:
            yield values[0] >> 3, data[at:at + values[1]]
            at += values[1]
        else:
            yield values[0] >> 3, values[1]


class Model:
    """Tables of a serialized SentencePiece model (BPE or unigram, identity normaliser)."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        trainer, normaliser = {}, {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append((piece.get(1, b"").decode(), piece.get(2, 0.0), piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        self.bpe = trainer.get(3, 1) == 2
        if trainer.get(3, 1) not in (1, 2):
            raise ValueError("only BPE and unigram models")
        if normaliser.get(2) or normaliser.get(4, 1) or not normaliser.get(5, 1):
            raise ValueError("only the identity normaliser that keeps and escapes white space")
        if {k for _, _, k in self.pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("user-defined and unused pieces are not supported")
        self.prefix = bool(normaliser.get(3, 1))
        self.unknown = next(i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN)
        byte = {p[0]: i for i, p in enumerate(self.pieces) if p[2] == BYTE}
        self.bytes = [byte[f"<0x{b:02X}>"] for b in range(256)] if len(byte) == 256 else None
        self.by_text = {p[0]: i for i, p in enumerate(self.pieces) if p[2] == NORMAL}
        self.raw = [b"" if k in (CONTROL, UNKNOWN) else bytes([int(p[3:5], 16)]) if k == BYTE
                    else p.replace(SPACE, " ").encode() for p, _, k in self.pieces]
        self.raw[self.unknown] = " ⁇ ".encode()
        # class 0: characters that no longer piece holds; joined: the pairs of classes that follow each other in some piece
        joining = sorted({c for p in self.by_text if len(p) > 1 for c in p})
        self.classes = np.zeros(CHARACTERS, np.int16 if len(joining) < 1 << 15 else np.int32)
        self.classes[[ord(c) for c in joining]] = np.arange(1, len(joining) + 1)
        follows = {p[k:k + 2] for p in self.by_text for k in range(len(p) - 1)}
        pairs = self.classes[[[ord(c) for c in f] for f in follows]].astype(np.int64) if follows else np.zeros((0, 2), np.int64)
        self.joined = np.sort(pairs[:, 0] * (len(joining) + 1) + pairs[:, 1])
        self.matrix = None
        if len(joining) <= DENSE:               # a table of all pairs is quicker than a search
            self.matrix = np.zeros((len(joining) + 1, len(joining) + 1), bool)
            self.matrix[pairs[:, 0], pairs[:, 1]] = True
        self.raw_bytes = np.frombuffer(b"".join(self.raw), np.uint8)
        self.raw_size = np.array([len(r) for r in self.raw], np.int64)
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size
        self.scores = np.array([p[1] for p in self.pieces], np.float64)
        self._tables()
        # by unit hash (by text where hashes clash): the unit and its ids, of this generation and of the one before
        self.cache: dict[int | str, tuple[str, bytes]] = {}
        self.old: dict[int | str, tuple[str, bytes]] = {}
        self.powers = np.ones(1, np.uint64)

    def _tables(self) -> None:
        """Sorted substring keys and, for BPE, ranks, splits and joins."""
        atoms = {c for p in self.by_text for c in p} - set(self.by_text)
        self.extra = {c: len(self.pieces) + i for i, c in enumerate(sorted(atoms))}     # characters without a piece
        ids = self.by_text | self.extra
        order = sorted(self.by_text, key=lambda p: (-self.pieces[self.by_text[p]][1], self.by_text[p]))
        self.rank_of = {p: r for r, p in enumerate(order)}
        keep = list(ids)
        if self.bpe:
            last: dict[str, float] = {}
            for r, p in enumerate(order):      # pieces of equal score share the first one's rank: the leftmost goes first
                s = self.pieces[self.by_text[p]][1]
                self.rank_of[p] = last.setdefault(s, r)
            size = len(self.pieces) + len(self.extra)
            self.rank = np.full(size, -1, np.int64)
            self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
            keep, joins = list(self.extra), {}
            for p, i in self.by_text.items():
                for k in range(1, len(p)):
                    if p[:k] in ids and p[k:] in ids:
                        joins[ids[p[:k]] * size + ids[p[k:]]] = self.rank_of[p]
                if p.count(SPACE) > 1:
                    continue
                if len(p) == 1:
                    keep.append(p)
                    continue
                end, split = self.merge(p)
                if end == [p]:
                    keep.append(p)
                    self.rank[i], self.left[i], self.right[i] = self.rank_of[p], ids[split[0]], ids[split[1]]
            self.joins = np.array(sorted(joins), np.int64)
            self.join_ranks = np.array([joins[k] for k in self.joins.tolist()], np.int64)
            merged = np.flatnonzero(self.rank >= 0)
            inner = np.maximum(self.rank[self.left[merged]], self.rank[self.right[merged]])
            # undoing merges by rank needs distinct ranks and parts that rank before the whole
            self.ordered = len(np.unique(self.rank[merged])) == len(merged) and bool((inner < self.rank[merged]).all())
        else:
            self.ordered = True
        self.longest = max(map(len, keep), default=1)
        keys = np.array([self._key(p) for p in keep], np.uint64)
        sort = np.argsort(keys)
        self.keys, self.key_ids = keys[sort], np.array([ids[p] for p in keep], np.int64)[sort]
        self.seen = np.zeros(1 << 20, bool)         # low bits of the keys: most substrings need no probe
        self.seen[keys & np.uint64((1 << 20) - 1)] = True
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two pieces share a substring key")
        self.key_scores = np.append(self.scores, np.zeros(len(self.extra)))
        self.floor = float(self.scores[[self.by_text[p] for p in self.by_text]].min()) - 10 if self.by_text else -10.0

    @staticmethod
    def _key(text: str) -> int:
        value = 0
        for c in text:
            value = (value * int(_HASH) + ord(c) + 1) & (1 << 64) - 1
        return value

    def merge(self, unit: str) -> tuple[list[str], tuple[str, str] | None]:
        """Scalar BPE: the pieces of a unit, and the two parts of its last merge."""
        texts: list[str | None] = list(unit)
        following, previous = list(range(1, len(unit) + 1)), list(range(-1, len(unit) - 1))
        heap: list[tuple[int, int, str]] = []

        def push(i: int) -> None:
            j = following[i]
            if j < len(texts) and (r := self.rank_of.get(texts[i] + texts[j])) is not None:
                heapq.heappush(heap, (r, i, texts[i] + texts[j]))
        for i in range(len(unit) - 1):
            push(i)
        split = None
        while heap:
            _, i, joined = heapq.heappop(heap)
            if texts[i] is None or (j := following[i]) >= len(texts) or texts[i] + texts[j] != joined:
                continue
            split = (texts[i], texts[j])
            texts[i], texts[j] = joined, None
            following[i] = following[j]
            if following[i] < len(texts):
                previous[following[i]] = i
            push(i)
            if previous[i] >= 0:
                push(previous[i])
        return [t for t in texts if t is not None], split

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether BPE of the two pieces' joined string leaves them as they are."""
        size, ok = len(self.rank), np.ones(len(a), bool)
        at, limit = np.arange(len(a)), np.full(len(a), np.iinfo(np.int64).max)
        while len(at):
            key = a * size + b
            k = np.minimum(np.searchsorted(self.joins, key), len(self.joins) - 1)
            crossing = (self.joins[k] == key) & (self.join_ranks[k] < limit)
            ok[at[crossing]] = False
            ra, rb = self.rank[a], self.rank[b]
            undo_a = ra > rb
            limit = np.where(undo_a, ra, rb + 1)
            go = ~crossing & ((ra >= 0) | (rb >= 0))
            a, b = np.where(undo_a, self.right[a], a)[go], np.where(undo_a, b, self.left[b])[go]
            at, limit = at[go], limit[go]
        return ok

    def viterbi(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Internal ids of units of one length, one unit after the other, and how many each has."""
        n, size = len(units), len(units[0])
        chars = np.frombuffer("".join(units).encode("utf-32-le"), "<u4").reshape(n, size).astype(np.uint64) + np.uint64(1)
        found: list[np.ndarray] = []               # found[l - 1][:, j]: piece of l characters from j, or -1
        hashes = np.zeros((n, size), np.uint64)
        for length in range(1, min(size, self.longest) + 1):
            hashes = hashes[:, :size - length + 1] * _HASH + chars[:, length - 1:]
            piece = np.full(hashes.shape, -1, np.int64)
            maybe = self.seen[hashes & np.uint64((1 << 20) - 1)]
            wanted = hashes[maybe]
            k = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            piece[maybe] = np.where(self.keys[k] == wanted, self.key_ids[k], -1)
            found.append(piece)
        single = found[0]
        if not self.bpe:
            single = np.where(single < 0, self.unknown, single)
        best = np.full((n, size + 1), -np.inf)
        best[:, 0] = 0
        last, back = np.full((n, size + 1), -1, np.int64), np.zeros((n, size + 1), np.int64)
        for end in range(1, size + 1):
            # BPE: one piece only can end a prefix, so a row is done once it has one (long ones are likelier)
            for length in range(min(end, self.longest), 0, -1):
                start = end - length
                piece = single[:, start] if length == 1 else found[length - 1][:, start]
                open_ = (piece >= 0) & (best[:, start] > -np.inf)
                if self.bpe:
                    open_ &= best[:, end] == -np.inf
                rows = np.flatnonzero(open_)
                if not len(rows):
                    continue
                own, before = piece[rows], last[rows, start]
                if self.bpe:
                    step = np.zeros(len(rows))
                    if start:
                        step[~self.apart(before, own)] = -np.inf
                else:
                    step = np.where(own == self.unknown, self.floor, self.key_scores[own])
                score = best[rows, start] + step
                better = score > best[rows, end]
                at = rows[better]
                best[at, end], last[at, end], back[at, end] = score[better], own[better], start
        # follow the back pointers of all units at once
        here, going, path = np.full(n, size), np.arange(n), []
        while going.size:
            end = here[going]
            path.append((going, end, last[going, end]))
            here[going] = back[going, end]
            going = going[here[going] > 0]
        row, end, piece = (np.concatenate(x) for x in zip(*path))
        order = np.lexsort((end, row))
        return piece[order], np.bincount(row, minlength=n)

    def _ids(self, unit: str, internal: list[int]) -> bytes:
        """Public ids as 32-bit integers: characters without a piece become their UTF-8 bytes, or the unknown piece."""
        if max(internal) < len(self.pieces) and (self.unknown not in internal or self.bytes is None):
            return struct.pack(f"<{len(internal)}i", *internal)
        out: list[int] = []
        at = 0
        for i in internal:
            text = next(c for c, k in self.extra.items() if k == i) if i >= len(self.pieces) else \
                unit[at] if i == self.unknown else self.pieces[i][0]
            at += len(text)
            if i < len(self.pieces) and i != self.unknown:
                out.append(i)
            else:
                out += [self.bytes[b] for b in text.encode()] if self.bytes else [self.unknown]
        return struct.pack(f"<{len(out)}i", *out)

    def encode_units(self, units: list[str]) -> dict[str, bytes]:
        """Ids of distinct units."""
        out, by_length = {}, {}
        for u in units:
            if len(u) == 1 and u not in self.by_text:
                out[u] = np.array([self.bytes[b] for b in u.encode()] if self.bytes else [self.unknown], "<i4").tobytes()
            elif self.bpe and (not self.ordered or len(u) > LONG or u.startswith(SPACE * 2)):
                ids = self.by_text | self.extra
                out[u] = self._ids(u, [ids[p] for p in self.merge(u)[0]])
            else:
                by_length.setdefault(len(u), []).append(u)
        for own in by_length.values():
            for at in range(0, len(own), 20_000):
                part = own[at:at + 20_000]
                ids, counts = self.viterbi(part)
                plain, ends = ids.astype("<i4").tobytes(), np.cumsum(counts) * 4
                out.update(zip(part, map(plain.__getitem__, map(slice, (ends - counts * 4).tolist(), ends.tolist()))))
                odd = (ids >= len(self.pieces)) | (ids == self.unknown)
                for k in np.unique(np.repeat(np.arange(len(part)), counts)[odd]).tolist():
                    out[part[k]] = self._ids(part[k], ids[ends[k] // 4 - counts[k]:ends[k] // 4].tolist())
        return out

    def units(self, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Starts of the units; ``starts``: of the texts."""
        own = self.classes[codes]
        cut = np.ones(len(codes), bool)
        if self.matrix is not None:
            cut[1:] = ~self.matrix[own[:-1], own[1:]]
        elif len(self.joined):
            key = own[:-1].astype(np.int64) * (int(self.classes.max()) + 1) + own[1:]
            cut[1:] = self.joined[np.minimum(np.searchsorted(self.joined, key), len(self.joined) - 1)] != key
        cut[starts] = True
        return np.flatnonzero(cut)

    def unit_hashes(self, codes: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        longest = int(sizes.max(initial=1))
        if len(self.powers) < longest:
            self.powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(2 * longest, _HASH)]))
        inside = np.arange(len(codes), dtype=np.int32) - np.repeat(at.astype(np.int32), sizes)
        weighed = self.powers[inside]
        weighed *= codes + np.uint64(1)
        sums = np.add.reduceat(weighed, at)
        mixed = (sums ^ (sums >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + sizes.astype(np.uint64)
        return mixed ^ (mixed >> np.uint64(29))

    def agree(self, codes: np.ndarray, at: np.ndarray, sizes: np.ndarray, like: np.ndarray) -> bool:
        """Whether every unit has the characters of the unit ``like``, compared some at a time."""
        if (sizes != sizes[like]).any():
            return False
        for a in range(0, len(at), 1 << 16):
            s = slice(a, a + (1 << 16))
            size = sizes[s]
            inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            if (codes[np.repeat(at[s], size) + inside] != codes[np.repeat(at[like[s]], size) + inside]).any():
                return False
        return True

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the bounds of each text's."""
        marked = [t.replace(" ", SPACE) for t in texts]
        if self.prefix:
            marked = [SPACE + t if t else t for t in marked]
        every, lengths = "".join(marked), np.array([len(t) for t in marked], np.int64)
        if not every:
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        codes = np.frombuffer(every.encode("utf-32-le"), "<u4")
        begin = np.cumsum(lengths) - lengths
        at = self.units(codes, begin[lengths > 0])
        sizes = np.diff(at, append=len(codes))
        distinct, first, which = np.unique(self.unit_hashes(codes, at, sizes), return_index=True, return_inverse=True)
        keys = distinct.tolist()
        if not self.agree(codes, at, sizes, first[which]):
            # units that share a hash: told apart by their texts, here and by what follows
            index: dict[str, int] = {}
            which = np.array([index.setdefault(every[a:a + n], len(index)) for a, n in zip(at.tolist(), sizes.tolist())])
            names, keys = list(index), list(index)
        else:
            names = [every[a:a + n] for a, n in zip(at[first].tolist(), sizes[first].tolist())]
        for k in self.old.keys() & keys:                    # what the older generation has is kept on
            self.cache[k] = self.old[k]
        # a hash stands for the text it was kept with, for no other
        new = [j for j, k in enumerate(keys) if k not in self.cache or self.cache[k][0] != names[j]]
        if new:
            ids = self.encode_units([names[j] for j in new])
            self.cache.update((keys[j], (names[j], ids[names[j]])) for j in new)
        found = [self.cache[k][1] for k in keys]
        if len(self.cache) > CACHED // 2:
            self.old, self.cache = self.cache, {}
        counts = np.array([len(f) for f in found], np.int64) // 4
        out = _spread(np.frombuffer(b"".join(found), "<i4"), np.cumsum(counts) - counts, counts, which)
        ends = np.concatenate([[0], np.cumsum(counts[which])])
        return out, ends[np.searchsorted(at, np.concatenate([begin, [len(codes)]]))]

    def trim(self) -> None:
        """Forget most units: a worker that waits for its next task should hold little memory."""
        self.cache, self.old = dict(islice((self.old or self.cache).items(), KEPT)), {}

    def decode_flat(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Texts of ids that lie one after the other."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.raw)):
            raise ValueError("id outside the vocabulary")
        data = _spread(self.raw_bytes, self.raw_start, self.raw_size, ids).tobytes()
        ends = np.concatenate([[0], np.cumsum(self.raw_size[ids])])[bounds].tolist()
        texts = [data[a:b].decode(errors="replace") for a, b in zip(ends, ends[1:])]
        return [t[1:] if self.prefix and t.startswith(" ") else t for t in texts]

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Ids of each text; null stays null."""
        ids, bounds = self.encode_flat([t or "" for t in texts])
        return [None if t is None else ids[a:b] for t, a, b in zip(texts, bounds.tolist(), bounds[1:].tolist())]

    def decode(self, ids: list[int]) -> str:
        """Text of ids; bytes that are not UTF-8 become U+FFFD, an id outside the vocabulary raises."""
        return self.decode_flat(np.array(ids, np.int64), np.array([0, len(ids)]))[0]


def _spread(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs ``data[start:start + size]`` of the entries ``which``, one after the other."""
    size = sizes[which]
    shift = starts[which] - np.cumsum(size) + size
    return data[np.repeat(shift, size) + np.arange(size.sum())]


def read_model(path: str) -> bytes:
    """Model file, refused above ``MAX_MODEL_BYTES`` (it is broadcast)."""
    with open(path, "rb") as f:
        data = f.read(MAX_MODEL_BYTES + 1)
    if len(data) > MAX_MODEL_BYTES:
        raise ValueError("model file is too large to broadcast")
    return data


_MODELS: dict[int, Model] = {}


def _model(shared) -> Model:
    """The worker's tables of a broadcast model."""
    key = hash(shared.value)
    if key not in _MODELS:
        _MODELS[key] = Model(shared.value)
    return _MODELS[key]


def _list(ids: np.ndarray, bounds: np.ndarray, null: list[bool]) -> pa.ListArray:
    offsets = pa.array(bounds, pa.int32(), mask=np.array([*null, False]))       # a null offset makes a null list
    return pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))


def encode(docs: DataFrame, model: bytes, text_col: str = "text", ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """All columns of ``docs`` and ``ids_col`` (array<int>), which replaces a column of that name.

    ``decoded_col`` adds the text that the ids decode to, in the same pass.

    Null text: null ids; empty text: no ids. A space mark (U+2581) in a text is
    treated as a space, as the library does. Repeated rows are all returned; an
    empty table gives an empty result.
    """
    new = [T.StructField(ids_col, T.ArrayType(T.IntegerType()))] + ([T.StructField(decoded_col, T.StringType())] if decoded_col else [])

    def run(tables: Model, column: pa.Array) -> list:
        texts = column.to_pylist()
        null = [t is None for t in texts]
        ids, bounds = tables.encode_flat([t or "" for t in texts])
        out: list = [_list(ids, bounds, null)]
        if decoded_col:
            out.append([None if n else t for n, t in zip(null, tables.decode_flat(ids, bounds))])
        return out
    return _map(docs, model, text_col, new, run)


def decode(docs: DataFrame, model: bytes, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """All columns of ``docs`` and ``text_col`` (string), which replaces a column of that name; null ids: null."""
    def run(tables: Model, column: pa.Array) -> list:
        ids = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = np.array([0 if x is None else x for x in column.value_lengths().to_pylist()], np.int64)
        texts = tables.decode_flat(ids, np.concatenate([[0], np.cumsum(sizes)]))
        return [[t if ok else None for t, ok in zip(texts, column.is_valid().to_pylist())]]
    return _map(docs, model, ids_col, [T.StructField(text_col, T.StringType())], run)


def _map(docs: DataFrame, model: bytes, source: str, new: list[T.StructField], fn) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)
    taken = {f.name.lower() for f in new}
    kept = [f for f in docs.schema.fields if f.name.lower() not in taken]
    schema = T.StructType(kept + new)
    extra = without([f.name for f in kept], "_source")

    def run(batches):
        tables = _model(shared)
        for batch in pieces(batches, limit=2 << 20):
            yield [batch.column(i) for i in range(len(kept))] + fn(tables, batch.column(len(kept)))
        tables.trim()
    return docs.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{source}`").alias(extra)).mapInArrow(
        arrow_rows(run, schema), schema)
