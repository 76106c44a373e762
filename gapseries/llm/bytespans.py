"""Removal of repeated byte strings by sorting suffixes at content-defined anchors.

A string of ``LENGTH`` bytes that starts at byte ``i`` of a text is its window
``i``; a byte goes when a window that also starts anywhere else covers it. A
suffix array over every byte of a corpus would be many times its size, so only
some suffixes are sorted, chosen such that no repeat is lost:

1. *Anchors.* The anchor of a window is the place of its smallest ``GRAM``-byte
   hash (the last of equal ones), hence a function of its bytes: equal windows
   have their anchor at the same offset, and it holds equal bytes. Consecutive
   windows with one anchor form a segment, some 100 to 170 windows on average.
2. *Copies.* Segments are grouped by hash of the anchor bytes and 128-bit hash
   of the whole segment (partial aggregation). A segment that occurs twice has
   all its windows repeated. One of each set of copies goes on, and only where
   the same anchor bytes occur in a different segment too: ends of copied
   passages, near copies, common phrases.
3. *Suffix sorting.* The segments of one anchor are aligned there. Their
   suffixes to the right and their reversed prefixes to the left are sorted by
   deep-shallow sorting (``suffixes``). Window ``m - o`` is shared by two
   segments exactly if ``o`` bytes left and ``LENGTH - o`` bytes right of the
   anchor ``m`` agree, so for each offset the two orders, cut where neighbours
   share less, give the classes of equal windows. Bytes are compared, not hashes.

An anchor with more than ``MOST`` different segments is not sorted in one task:
the windows of its segments are grouped one by one by 128-bit hash, with
partial aggregation, which is exact too and has no bound on the group.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapseries.llm.common import arrow_rows, discard, groups, materialise, pieces
from gapseries.llm.substring import mix
from gapseries.llm.suffixes import deep_shallow

LENGTH = 400
GRAM = 64
MOST = 4096                         # different segments of one anchor that are sorted in one task
PIECE = 1 << 20                     # bytes hashed at a time
_LOW = np.uint64(PIECE - 1)
_ODD = 0x9E3779B97F4A7C15
_LONG, _INT, _BYTES = T.LongType(), T.IntegerType(), T.BinaryType()
_tables: dict[str, np.ndarray] = {}


def _powers(which: str) -> np.ndarray:
    """Powers of an odd number modulo 2^64 ("up"), or of its inverse ("down")."""
    if which not in _tables:
        row = np.full(PIECE + 1, _ODD if which == "up" else pow(_ODD, -1, 1 << 64), np.uint64)
        row[0] = 1
        _tables[which] = np.multiply.accumulate(row)
    return _tables[which]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of every run of ``gram`` bytes (it only chooses anchors and groups them: equal bytes, equal hash)."""
    if "bytes" not in _tables:
        _tables["bytes"] = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_tables["bytes"][data] * _powers("up")[:len(data)], out=sums[1:])
    return mix((sums[gram:] - sums[:-gram]) * _powers("down")[:len(data) - gram + 1])


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by prefix and suffix minima of blocks."""
    n = len(x) - width + 1
    padded = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max)
    padded[:len(x)] = x
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def segments(buffer: bytes, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Segments of the texts in ``buffer`` (at most ``PIECE`` bytes), which end at ``ends``: (start, windows, anchor, gram hash)."""
    none = (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    if len(buffer) < length:
        return none
    hashes = gram_hashes(np.frombuffer(buffer, np.uint8), gram)
    # the place is in the low bits, upside down: of equal hashes the last is least
    least = _least((hashes & ~_LOW) | (_LOW - np.arange(len(hashes), dtype=np.uint64)), length - gram + 1)
    anchor = (_LOW - (least & _LOW)).astype(np.int64)
    begins = np.append(0, ends[:-1])
    long = ends - begins >= length
    inside = np.zeros(len(anchor) + 1, np.int32)
    np.add.at(inside, begins[long], 1)
    np.add.at(inside, ends[long] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    if not len(starts):
        return none
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(starts) != 1) | (anchor[starts[1:]] != anchor[starts[:-1]])
    first = np.flatnonzero(new)
    at = starts[first]
    return at, np.diff(np.append(first, len(starts))), anchor[at], hashes[anchor[at]]


def _cover(starts: list[int], windows: list[int], n: int, length: int) -> np.ndarray:
    """Mask of the bytes that the windows cover."""
    edge = np.zeros(n + 1, np.int64)
    starts = np.array(starts, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + np.array(windows, np.int64) + length - 1, -1)
    return np.cumsum(edge[:-1]) > 0


def shared_windows(left: list[bytes], right: list[bytes], low: np.ndarray, high: np.ndarray, length: int) -> tuple[int, np.ndarray]:
    """``(first offset, matrix)``: at each offset, which segments have a window that another one has at that offset too.

    ``left``: bytes before the anchor, backwards; ``right``: bytes from the anchor on; ``low`` to ``high``: the offsets of
    a segment's windows.
    """
    n = len(left)
    (by_left, same_left), (by_right, same_right) = deep_shallow(left), deep_shallow(right)
    first, last = int(low.min()), int(high.max())
    out = np.zeros((last - first + 1, n), bool)
    step = max(1, (1 << 20) // n)
    one, two, alone = np.empty((step, n), np.int64), np.empty((step, n), np.int64), -1 - np.arange(n)
    same_left, same_right = np.array(same_left), np.array(same_right)
    for a in range(first, last + 1, step):
        offsets = np.arange(a, min(a + step, last + 1))
        k = len(offsets)
        one[:k, by_left] = np.cumsum(same_left < offsets[:, None], 1)
        two[:k, by_right] = np.cumsum(same_right < length - offsets[:, None], 1)
        classes = np.where((low <= offsets[:, None]) & (offsets[:, None] <= high), one[:k] * (n + 1) + two[:k], alone)
        order = np.argsort(classes, 1)
        ranked = np.take_along_axis(classes, order, 1)
        pair = ranked[:, 1:] == ranked[:, :-1]
        hit = np.zeros((k, n), bool)
        hit[:, 1:] |= pair
        hit[:, :-1] |= pair
        np.put_along_axis(out[a - first:a - first + k], order, hit, 1)
    return first, out


def _ranges(hit: np.ndarray) -> tuple[list[int], list[int]]:
    """Starts and lengths of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return edge[::2].tolist(), (edge[1::2] - edge[::2]).tolist()


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   most: int = MOST) -> DataFrame:
    """One row per row of ``docs``: ``(id, n_bytes, n_removed, n_spans, kept_sha256, kept)``.

    ``kept`` (bytes, as a cut may split a character): null when nothing was removed. Texts are UTF-8, null and empty ones
    have no bytes, those under ``length`` bytes no windows. Every row counts, so repeated rows, rows that share an id and
    rows with a null id are repeats of each other. Other columns are ignored; an empty table gives an empty result.
    """
    if not 0 < gram < length <= PIECE // 2:
        raise ValueError("0 < gram < length <= half a piece")
    spark = docs.sparkSession
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    id_type = docs.schema["id"].dataType
    ints, longs, shorts = T.ArrayType(_INT), T.ArrayType(_LONG), T.ArrayType(T.ShortType())
    head = [T.StructField("row", _LONG), T.StructField("id", id_type), T.StructField("n", _LONG), T.StructField("sha", T.StringType())]
    first = T.StructType([*head, T.StructField("text", _BYTES), T.StructField("f", longs), T.StructField("k1", longs), T.StructField("k2", longs),
                          T.StructField("start", ints), T.StructField("windows", ints), T.StructField("anchor", ints)])

    def scan(batches):
        pack = zstandard.ZstdCompressor(level=3).compress

        def flush(rows):
            """Rows (head..., text) with their segments; texts that fit go through numpy together."""
            found: list[list] = [[] for _ in rows]
            parts, held, size = [], [], 0
            for r, row in enumerate(rows):
                text = row[-1]
                for start in range(0, max(1, len(text) - length + 1), PIECE - length + 1):
                    piece = text[start:start + PIECE] if len(text) > PIECE else text
                    if len(piece) < length:
                        continue
                    if size + len(piece) > PIECE:
                        parts.append(held)
                        held, size = [], 0
                    held.append((r, start, piece))
                    size += len(piece)
            if held:
                parts.append(held)
            for held in parts:
                buffer = b"".join(h[2] for h in held)
                ends = np.cumsum([len(h[2]) for h in held])
                begins = ends - [len(h[2]) for h in held]
                at, windows, anchor, f = segments(buffer, ends, length, gram)
                view = memoryview(buffer)
                keys = np.frombuffer(b"".join([xxhash.xxh3_128_digest(view[a:a + w + length - 1]) for a, w in zip(at.tolist(), windows.tolist())]),
                                     "<i8").reshape(-1, 2)
                owner = np.searchsorted(begins, at, "right") - 1
                cut = np.searchsorted(owner, np.arange(len(held) + 1))
                for j, (r, start, _) in enumerate(held):
                    s = slice(cut[j], cut[j + 1])
                    shift = start - begins[j]
                    found[r].append((f[s].view(np.int64), keys[s, 0], keys[s, 1], at[s] + shift, windows[s], anchor[s] - at[s]))
            none = np.zeros(0, np.int64)
            columns: list[list] = [[] for _ in first.fields]
            for row, own in zip(rows, found):
                own = [np.concatenate(x) for x in zip(*own)] if own else [none] * 6
                for column, value in zip(columns, (*row[:-1], pack(row[-1]) if len(own[0]) else None, *own)):
                    column.append(value)
            return columns
        rows, size = [], 0
        for batch in pieces(batches):
            for row, i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                text = text.as_py() or b""
                rows.append((row, i, len(text), hashlib.sha256(text).hexdigest(), text))
                size += len(text) + 64
                if size >= 4 * PIECE:
                    yield flush(rows)
                    rows, size = [], 0
        if rows:
            yield flush(rows)
    own = materialise(docs.mapInArrow(arrow_rows(scan, first), first), "segments")
    rows = own.where(F.size("f") > 0).select("row", F.explode(F.arrays_zip("f", "k1", "k2", "start", "windows", "anchor")).alias("s")).select("row", "s.*")
    place = F.struct("row", "start", "windows", "anchor")
    copies = rows.groupBy("f", "k1", "k2").agg(F.count("*").alias("times"), F.min(place).alias("one"))
    copies = materialise(copies, "copies")
    anchors = copies.groupBy("f").agg(F.sum("times").alias("total"), F.count("*").alias("kinds")).where("total > 1")
    repeated = materialise(copies.join(anchors.drop("total"), "f"), "repeated")
    known = rows.join(repeated.where("times > 1").select("f", "k1", "k2"), ["f", "k1", "k2"]).select(
        "row", F.struct("start", "windows").alias("known"), F.lit(None).cast("struct<start:int,windows:int,anchor:int,f:bigint,kinds:bigint,wanted:boolean>").alias("open"))
    open_ = repeated.where("kinds > 1").select(
        "one.row", F.lit(None).cast("struct<start:int,windows:int>").alias("known"),
        F.struct("one.start", "one.windows", "one.anchor", "f", "kinds", (F.col("times") == 1).alias("wanted")).alias("open"))
    lists = known.unionByName(open_).groupBy("row").agg(F.collect_list("known").alias("known"), F.collect_list("open").alias("open"))
    # rows without an open segment are done; the others keep their text
    second = T.StructType([*head, T.StructField("removed", _LONG), T.StructField("spans", _LONG), T.StructField("kept", _BYTES),
                           T.StructField("text", _BYTES), T.StructField("wanted", T.BooleanType()),
                           T.StructField("start", ints), T.StructField("windows", ints),
                           *[T.StructField(f"open_{c}", ints) for c in ("start", "windows", "anchor")], T.StructField("open_f", longs),
                           T.StructField("open_kinds", longs), T.StructField("open_wanted", T.ArrayType(T.BooleanType()))])

    def strip(text: bytes, starts: list[int], windows: list[int]):
        """(removed, spans, sha, kept)"""
        if not starts:
            return 0, 0, None, None
        gone = _cover(starts, windows, len(text), length)
        data = np.frombuffer(text, np.uint8)
        kept = data[~gone].tobytes()
        return int(gone.sum()), len(_ranges(gone)[0]), hashlib.sha256(kept).hexdigest(), kept

    def settle(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in pieces(batches, 4):
            columns: list[list] = [[] for _ in second.fields]
            for row, i, n, sha, text, known, opened in zip(*(c.to_pylist() for c in batch.columns)):
                known, opened = known or [], opened or []
                starts, windows = [k["start"] for k in known], [k["windows"] for k in known]
                wanted = any(o["wanted"] for o in opened)
                removed, spans, kept = 0, 0, None
                if not wanted and starts:
                    removed, spans, sha, kept = strip(unpack(text), starts, windows)
                values = (row, i, n, sha, removed, spans, kept, text if opened else None, wanted, starts if wanted else [], windows if wanted else [],
                          *([o[c] for o in opened] for c in ("start", "windows", "anchor", "f", "kinds", "wanted")))
                for column, value in zip(columns, values):
                    column.append(value)
            yield columns
    told = (own.select("row", "id", "n", "sha", "text").join(lists, "row", "left").select("row", "id", "n", "sha", "text", "known", "open")
            .mapInArrow(arrow_rows(settle, second), second))
    told = materialise(told, "settled")
    discard(own, copies, repeated)
    opened = told.where(F.size("open_start") > 0).select("row", "text", *[c for c in second.names if c.startswith("open_")])
    third = T.StructType([T.StructField("f", _LONG), T.StructField("row", _LONG), T.StructField("start", _INT), T.StructField("windows", _INT),
                          T.StructField("anchor", _INT), T.StructField("wanted", T.BooleanType()), T.StructField("data", _BYTES)])

    def cut(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in pieces(batches, 1, 2 << 20):
            columns: list[list] = [[] for _ in third.fields]
            size = 0
            for row, text, starts, windows, anchors, fs, kinds, wanted in zip(*(c.to_pylist() for c in batch.columns)):
                text = unpack(text)
                for a, w, m, f, many, want in zip(starts, windows, anchors, fs, kinds, wanted):
                    if many <= most:
                        for column, value in zip(columns, (f, row, a, w, m, want, text[a:a + w + length - 1])):
                            column.append(value)
                        size += w + length
                        if size >= 8 << 20:
                            yield columns
                            columns, size = [[] for _ in third.fields], 0
            yield columns
    found_fields = T.StructType([T.StructField("row", _LONG), T.StructField("start", ints), T.StructField("windows", ints)])

    def compare(batches):
        for group in groups(batches, 1):
            starts, windows, anchors, wanted, data = (group.column(c).to_pylist() for c in ("start", "windows", "anchor", "wanted", "data"))
            high = np.array(anchors)                    # offset of the first window
            low = high - np.array(windows) + 1
            first_, hit = shared_windows([d[:m][::-1] for d, m in zip(data, anchors)], [d[m:m + length] for d, m in zip(data, anchors)], low, high, length)
            columns: list[list] = [[], [], []]
            for j in np.flatnonzero(hit.any(0) & np.array(wanted)).tolist():
                at, many = _ranges(hit[low[j] - first_:high[j] - first_ + 1, j][::-1])
                for column, value in zip(columns, (group.column("row")[j].as_py(), [starts[j] + a for a in at], many)):
                    column.append(value)
            if columns[0]:
                yield columns
    found = (opened.mapInArrow(arrow_rows(cut, third), third).repartition("f").sortWithinPartitions("f")
             .mapInArrow(arrow_rows(compare, found_fields), found_fields)).select("row", F.arrays_zip("start", "windows").alias("spans"))
    # anchors with very many segments: window by window
    window = T.StructType([T.StructField("h1", _LONG), T.StructField("h2", _LONG), T.StructField("row", _LONG), T.StructField("start", _INT),
                           T.StructField("wanted", T.BooleanType())])

    def single(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in pieces(batches, 1, 2 << 20):
            columns: list[list] = [[] for _ in window.fields]
            for row, text, starts, windows, kinds, wanted in zip(*(c.to_pylist() for c in batch.columns)):
                view = memoryview(unpack(text))
                for a, w, many, want in zip(starts, windows, kinds, wanted):
                    if many > most:
                        keys = np.frombuffer(b"".join([xxhash.xxh3_128_digest(view[i:i + length]) for i in range(a, a + w)]), "<i8").reshape(-1, 2)
                        for column, value in zip(columns, (keys[:, 0].tolist(), keys[:, 1].tolist(), [row] * w, range(a, a + w), [want] * w)):
                            column += value
                if len(columns[0]) >= 1 << 16:
                    yield columns
                    columns = [[] for _ in window.fields]
            yield columns
    hot = opened.where(F.exists("open_kinds", lambda k: k > most)).select("row", "text", "open_start", "open_windows", "open_kinds", "open_wanted")
    hot = materialise(hot.mapInArrow(arrow_rows(single, window), window), "windows")
    twice = hot.groupBy("h1", "h2").agg(F.count("*").alias("times")).where("times > 1").drop("times")
    singles = hot.where("wanted").join(twice, ["h1", "h2"]).groupBy("row").agg(
        F.collect_list(F.struct("start", F.lit(1).alias("windows"))).alias("spans"))
    found = found.unionByName(singles).groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("found"))
    last = T.StructType([head[1], T.StructField("n_bytes", _LONG), T.StructField("n_removed", _LONG), T.StructField("n_spans", _LONG),
                         T.StructField("kept_sha256", T.StringType()), T.StructField("kept", _BYTES)])

    def finish(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in pieces(batches, 3):
            columns: list[list] = [[] for _ in last.fields]
            for i, n, sha, text, starts, windows, more in zip(*(c.to_pylist() for c in batch.columns)):
                more = more or []
                starts, windows = starts + [m["start"] for m in more], windows + [m["windows"] for m in more]
                removed, spans, cut_sha, kept = strip(unpack(text), starts, windows)
                for column, value in zip(columns, (i, n, removed, spans, cut_sha or sha, kept)):
                    column.append(value)
            yield columns
    ended = (told.where("wanted").select("row", "id", "n", "sha", "text", "start", "windows").join(found, "row", "left")
             .select("id", "n", "sha", "text", "start", "windows", "found").mapInArrow(arrow_rows(finish, last), last))
    done = told.where("not wanted").select("id", F.col("n").alias("n_bytes"), F.col("removed").alias("n_removed"), F.col("spans").alias("n_spans"),
                                           F.col("sha").alias("kept_sha256"), "kept")
    return done.unionByName(ended).withColumnRenamed("id", id_col)
