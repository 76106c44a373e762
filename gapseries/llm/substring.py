"""Removal of repeated 50-word passages with a count-min prefilter.

A window is ``WINDOW`` consecutive words of one document. A word goes when it
lies in a window whose word sequence also starts in a document with a smaller
id. Two passes over the texts:

1. *Sketch.* Every partition counts the blocks (``WINDOW / 2`` words) that
   start at multiples of ``WINDOW / 2`` in its documents into a count-min
   sketch; the partition sketches are added up, saturating at 3, in ranges of
   counters. Any occurrence of a window holds at least one of these aligned
   blocks, so the sum of the sketch over the blocks inside a window is never
   below the window's number of occurrences: the estimate is too high at times
   and never too low. Counting aligned blocks instead of all windows keeps the
   sketch 25 times smaller.
2. *Exact grouping.* Only windows whose estimate exceeds their own aligned
   blocks (that is, which may occur elsewhere) are grouped, by 128-bit (96-bit
   for single windows) hashes of word sequences and in two steps that keep the shuffle small. Runs of such
   windows are cut at content-defined places into chunks of about ``CHUNK``
   windows; a chunk that a smaller id also holds is gone as a whole, and of
   each distinct chunk only the smallest id's stays open. The windows of the
   open chunks (any repeated window has its smallest holder among them) are then
   grouped one by one. Each batch of documents first resolves its own repeats,
   so a passage shared by very many documents reaches its group as one row a
   batch (map-side combine); a window function over the rest finds the least id.

The sketch has ``ROWS`` rows of at least ``LOAD`` counters a block (false
estimate about 2e-4 a block), two bits each, up to ``max_sketch_bytes``: the
bound of what is broadcast. Beyond that size more windows pass the prefilter
than need to and the second pass stays exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapseries.llm.common import arrow_rows, materialise, pieces

WINDOW = 50
ROWS = 4
LOAD = 8
CHUNK = 32                          # mean windows between cuts of a run
RANGE_BITS = 20                     # counters a merged range
MAX_SKETCH_BYTES = 256 << 20
_BASE = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))    # odd, hence invertible mod 2^64
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def words(text: str | None) -> list[bytes]:
    """Words of ``[^\\x20\\x09-\\x0D]+``, unchanged."""
    return (text or "").encode().split()


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of them."""
    have = _POWERS.get(which)
    if have is None or len(have[0]) < n:
        size = max(1 << 14, 1 << (n - 1).bit_length())
        base = int(_BASE[which])
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            row = np.full(size, b, np.uint64)
            row[0] = 1
            out.append(np.multiply.accumulate(row))
        have = _POWERS[which] = (out[0], out[1])
    return have


def word_hashes(own: list[bytes]) -> np.ndarray:
    """(n, 2) uint64: the XXH3-128 of every word."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, own)), "<u8").reshape(-1, 2)


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(hashes: np.ndarray, length: int, which: int = 0) -> np.ndarray:
    """Hash of every run of ``length`` words, from prefix sums of a polynomial mod 2^64."""
    n = len(hashes)
    if n < length:
        return np.zeros(0, np.uint64)
    up, down = _powers(which, n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes[:, which] * up[:n], out=sums[1:])
    return mix((sums[length:] - sums[:-length]) * down[:n - length + 1])


def cells(blocks: np.ndarray, row: int, width: int) -> np.ndarray:
    """Counter of each block in a sketch row; ``width`` is a power of two."""
    seed = np.uint64((row + 1) * int(_BASE[0]) & (1 << 64) - 1)
    return (mix(blocks + seed) & np.uint64(width - 1)) + np.uint64(row * width)


def sketch(docs: DataFrame, text_col: str, width: int, window: int = WINDOW) -> bytes:
    """Count-min sketch of the aligned blocks, 2 bits a counter, ``ROWS * width / 4`` bytes."""
    half = window // 2
    schema = T.StructType([T.StructField("range", T.IntegerType()), T.StructField("offsets", T.BinaryType())])
    merged = T.StructType([T.StructField("range", T.IntegerType()), T.StructField("counters", T.BinaryType())])
    range_bits = min(RANGE_BITS, width.bit_length() - 1)

    def emit(held: list[np.ndarray]):
        blocks = np.concatenate(held)
        at, times = np.unique(np.concatenate([cells(blocks, r, width) for r in range(ROWS)]), return_counts=True)
        at = np.repeat(at, np.minimum(times, 3))        # a hot counter is sent at most three times
        ranges, starts = np.unique(at >> np.uint64(range_bits), return_index=True)
        offsets = (at & np.uint64((1 << range_bits) - 1)).astype("<u4")
        ends = np.append(starts[1:], len(at))
        return [ranges.astype(np.int32).tolist(), [offsets[a:b].tobytes() for a, b in zip(starts, ends)]]

    def count(batches):
        held, size = [], 0
        for batch in pieces(batches):
            for text in batch.column(0):
                own = words(text.as_py())
                if len(own) >= window:
                    held.append(rolling(word_hashes(own), half)[::half])
                    size += len(held[-1])
                    if size >= 1 << 18:
                        yield emit(held)
                        held, size = [], 0
        if size:
            yield emit(held)

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << range_bits, np.uint8)
        for batch in batches:
            for part in batch.column(1):
                at = np.frombuffer(part.as_buffer(), "<u4")
                np.minimum(total + np.minimum(np.bincount(at, minlength=len(total)), 3), 3, out=total, casting="unsafe")
        four = total.reshape(-1, 4)
        packed = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([packed.tobytes()], pa.binary())],
                                         names=["range", "counters"])
    rows = (docs.select(text_col).mapInArrow(arrow_rows(count, schema), schema)
            .groupBy("range").applyInArrow(add, merged).collect())       # at most ROWS * width / 4 bytes in all
    out = np.zeros(ROWS * width // 4, np.uint8)
    step = (1 << range_bits) // 4
    for r in rows:
        out[r["range"] * step:(r["range"] + 1) * step] = np.frombuffer(r["counters"], np.uint8)
    return out.tobytes()


def estimate(blocks: np.ndarray, counters: np.ndarray, width: int) -> np.ndarray:
    """Count-min estimate of each block (at most 3)."""
    least = np.full(len(blocks), 3, np.uint8)
    for row in range(ROWS):
        at = cells(blocks, row, width)
        np.minimum(least, counters[at >> np.uint64(2)] >> ((at & np.uint64(3)) << np.uint64(1)).astype(np.uint8) & 3, out=least)
    return least


def candidates(hashes: np.ndarray, counters: np.ndarray, width: int, window: int) -> np.ndarray:
    """Starts of the windows whose estimate says that they may occur elsewhere too."""
    half = window // 2
    if len(hashes) < window:
        return np.zeros(0, np.int64)
    over = estimate(rolling(hashes, half), counters, width)
    over[::half] -= over[::half] > 0            # the document's own aligned block
    sums = np.concatenate([[0], np.cumsum(over > 0)])
    n = len(hashes) - window + 1
    inside = window - half + 1                  # starts of the blocks inside a window
    return np.flatnonzero(sums[inside:inside + n] > sums[:n])


def _runs(starts: np.ndarray, window: int, n: int) -> np.ndarray:
    """Mask of the words that the windows at ``starts`` cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return np.cumsum(edge[:-1]) > 0


def _spread(starts: list[int], lengths: list[int]) -> np.ndarray:
    """All window starts of ranges."""
    starts, lengths = np.array(starts, np.int64), np.array(lengths, np.int64)
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())


def _sketch_width(docs: DataFrame, text_col: str, window: int, max_sketch_bytes: int) -> int:
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    blocks = max(1, size // (6 * (window // 2)))
    width = 1 << max(10, (LOAD * blocks - 1).bit_length())
    return min(width, 1 << ((4 * max_sketch_bytes // ROWS).bit_length() - 1))


def chunks(starts: np.ndarray, keys: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Cut runs of consecutive windows at windows whose hash says so: (key 1, key 2, start, windows) of each chunk.

    A chunk spans at most ``window`` windows, so its first and last window cover
    all its words and their hashes name it.
    """
    if not len(starts):
        return (np.zeros(0, np.int64),) * 4
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(starts) != 1) | (keys[1:, 0] % np.uint64(CHUNK) == 0)
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    new |= (np.arange(len(starts)) - first) % window == 0
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(starts)))
    last = first + length - 1
    one, two = (mix(mix(keys[first, k] + length.astype(np.uint64)) * _BASE[1] + keys[last, k]).view(np.int64) for k in (0, 1))
    return one, two, starts[first], length


def window_keys(hashes: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """(n, 2) 64-bit hashes of the windows at ``starts``."""
    return np.stack([rolling(hashes, window, k)[starts] for k in (0, 1)], 1)


def settle(ids: list[int], held: list[tuple[np.ndarray, ...]]) -> tuple[list[list], list[list]]:
    """Columns (key 1, key 2, values...) per document: those left open, and those known to be in a smaller id.

    Of a key that several of the documents hold, only the smallest id's stays open.
    """
    counts = [len(h[0]) for h in held]
    columns = [np.concatenate(c) for c in zip(*held)]
    owner = np.repeat(np.array(ids, np.int64), counts)
    order = np.lexsort((owner, columns[1], columns[0]))
    a, b = columns[0][order], columns[1][order]
    first = np.ones(len(order), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    later = np.zeros(len(order), bool)
    if len(order):
        later[order] = owner[order] > owner[order][first][np.cumsum(first) - 1]
    cut = np.cumsum(counts)[:-1]
    parts = list(zip(*(np.split(c, cut) for c in columns), np.split(later, cut)))
    return ([[p[k][~p[-1]] for p in parts] for k in range(len(columns))],
            [[p[k][p[-1]] for p in parts] for k in range(2, len(columns))])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   max_sketch_bytes: int = MAX_SKETCH_BYTES, carry: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: ``(id, n_words, n_removed, kept_sha256, kept_text)``.

    ``kept_text``: null when nothing was removed, else the kept words joined by
    one space; ``kept_sha256``: of the kept words joined by one space, UTF-8.

    Null and empty texts have no words; texts under ``window`` words no
    windows. Rows with a null id are returned unchanged and delete nothing.
    Rows that share an id count as one document: no repeat among them is
    removed. Other columns are ignored, but for those in ``carry``, which every
    row then brings back as one struct ``carried`` besides its ``text``, the
    original one or, when something was removed, the kept words (the texts
    travel with the rows, so nothing is joined back); an empty table gives an
    empty result.
    """
    if window < 2 or window % 2:
        raise ValueError("window must be even")
    spark = docs.sparkSession
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                       F.struct(*[F.col(f"`{c}`") for c in carry]).alias("key") if carry else F.lit(None).cast("binary").alias("key"),
                       F.col(text_col).alias("text"))
    key_type = docs.schema["key"].dataType
    width = _sketch_width(docs, "text", window, max_sketch_bytes)
    shared = spark.sparkContext.broadcast(sketch(docs, "text", width, window))
    long, ints = T.LongType(), T.ArrayType(T.IntegerType())
    ranges = ["start", "length"]
    first = T.StructType([T.StructField("row", long), T.StructField("id", long), T.StructField("key", key_type), T.StructField("n_words", long),
                          T.StructField("sha", T.StringType()), T.StructField("text", T.BinaryType()), T.StructField("open", T.BooleanType()),
                          T.StructField("k1", T.ArrayType(long)), T.StructField("k2", T.ArrayType(long)),
                          *[T.StructField(c, ints) for c in ranges], *[T.StructField(f"known_{c}", ints) for c in ranges]])

    def probe(batches):
        counters = np.frombuffer(shared.value, np.uint8)
        none = (np.zeros(0, np.int64),) * 4
        pack = zstandard.ZstdCompressor(level=3).compress       # the words travel twice from here on
        held, size = [], 0
        for batch in pieces(batches):
            for row, i, key, text in zip(*(batch.column(c).to_pylist() for c in range(3)), batch.column(3)):
                text = text.as_py()
                own, found = words(text), none
                if i is not None and len(own) >= window:
                    hashes = word_hashes(own)
                    starts = candidates(hashes, counters, width, window)
                    if len(starts):
                        found = chunks(starts, window_keys(hashes, starts, window), window)
                kept = b" ".join(own)
                # a carried text goes on as it is (split, it gives the same words); else only the words of an open row are needed
                packed = (None if text is None else pack(text.encode())) if carry else pack(kept) if len(found[0]) else None
                held.append((row, i, key, len(own), hashlib.sha256(kept).hexdigest(), packed, len(found[0]) > 0, found))
                size += len(own) + 100
                if size >= 1 << 20:
                    yield chunked(held)
                    held, size = [], 0
        if held:
            yield chunked(held)

    def chunked(held: list[tuple]) -> list[list]:
        rest, known = settle([h[1] or 0 for h in held], [h[7] for h in held])
        return [list(c) for c in zip(*(h[:7] for h in held))] + rest + known
    own = materialise(docs.mapInArrow(arrow_rows(probe, first), first), "chunks")
    # chunks whose words also lie in a smaller id are gone as a whole; of the others the first holder's stay open
    rows = (own.where(F.size("start") > 0).select("row", "id", F.explode(F.arrays_zip("k1", "k2", "start", "length")).alias("c"))
            .select("row", "id", "c.*"))
    least = F.min("id").over(Window.partitionBy("k1", "k2"))
    decided = (rows.withColumn("gone", F.col("id") > least).groupBy("row")
               .agg(F.collect_list(F.struct("start", "length", "gone")).alias("parts")))
    wanted = T.StructType([T.StructField("row", long), T.StructField("id", long), T.StructField("key", key_type), T.StructField("n_words", long),
                           T.StructField("sha", T.StringType()), T.StructField("text", T.BinaryType()),
                           *[T.StructField(f"{k}_{c}", ints) for k in ("open", "known") for c in ranges]])
    known = F.filter(F.coalesce("parts", F.array().cast("array<struct<start:int,length:int,gone:boolean>>")), lambda p: p["gone"])
    still = F.filter(F.coalesce("parts", F.array().cast("array<struct<start:int,length:int,gone:boolean>>")), lambda p: ~p["gone"])
    repeats = own.where("open").join(decided, "row", "left").select(
        "row", "id", "key", "n_words", "sha", "text", still["start"].alias("open_start"), still["length"].alias("open_length"),
        F.concat("known_start", known["start"]).alias("known_start"), F.concat("known_length", known["length"]).alias("known_length"))
    repeats = materialise(repeats.select(*wanted.names), "repeats")
    # the same by single windows, over the open chunks
    single = T.StructType([T.StructField("row", long), T.StructField("id", long), T.StructField("k1", T.ArrayType(long)),
                           T.StructField("k2", ints), T.StructField("at", ints), T.StructField("known", ints)])

    def windows(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        held, size = [], 0
        for batch in pieces(batches, 2):
            for row, i, text, starts, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                starts = _spread(starts, lengths)
                keys = window_keys(word_hashes(unpack(text).split()), starts, window)
                # 96 bits a window
                held.append((row, i, (keys[:, 0].view(np.int64), (keys[:, 1] >> np.uint64(32)).astype(np.uint32).view(np.int32), starts)))
                size += len(starts)
                if size >= 1 << 19:
                    yield opened(held)
                    held, size = [], 0
        if held:
            yield opened(held)

    def opened(held: list[tuple]) -> list[list]:
        rest, known = settle([h[1] for h in held], [h[2] for h in held])
        return [[h[0] for h in held], [h[1] for h in held], *rest, *known]
    opens = repeats.where(F.size("open_start") > 0).select("row", "id", "text", "open_start", "open_length")
    opens = materialise(opens.mapInArrow(arrow_rows(windows, single), single), "windows")
    rows = (opens.where(F.size("at") > 0).select("row", "id", F.explode(F.arrays_zip("k1", "k2", "at")).alias("w"))
            .select("row", "id", "w.k1", "w.k2", "w.at"))
    found = rows.withColumn("least", least).where("id > least").groupBy("row").agg(F.collect_list("at").alias("found"))
    none = F.array().cast("array<int>")
    single_starts = opens.select("row", "known").join(found, "row", "left").select(
        "row", F.concat("known", F.coalesce("found", none)).alias("single"))
    out = T.StructType([T.StructField("id", long), T.StructField("n_words", long), T.StructField("n_removed", long),
                        T.StructField("kept_sha256", T.StringType()), T.StructField("kept_text", T.StringType()),
                        T.StructField("key", key_type), *([T.StructField("text", T.StringType())] if carry else [])])

    def cut(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in pieces(batches, 4):
            columns: list[list] = [[] for _ in out.fields]
            for i, key, n, sha, text, start, length, one in zip(*(c.to_pylist() for c in batch.columns)):
                starts = np.concatenate([_spread(start, length), np.array(one or [], np.int64)])
                kept, removed, whole = None, 0, unpack(text).decode() if carry else None
                if len(starts):
                    own = unpack(text).split()
                    gone = _runs(starts, window, n)
                    removed = int(gone.sum())
                    kept = b" ".join(w for w, g in zip(own, gone.tolist()) if not g)
                    sha, kept = hashlib.sha256(kept).hexdigest(), kept.decode()
                for column, value in zip(columns, (i, n, removed, sha, kept, key, whole if kept is None else kept)):
                    column.append(value)
            yield columns
    def whole_texts(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in pieces(batches):
            yield [*batch.columns[:-1], [None if t is None else unpack(t).decode() for t in batch.column(batch.num_columns - 1).to_pylist()]]
    changed = (repeats.join(single_starts, "row", "left").select("id", "key", "n_words", "sha", "text", "known_start", "known_length", "single")
               .mapInArrow(arrow_rows(cut, out), out))
    same = own.where("not open").select("id", "n_words", F.lit(0).cast("long").alias("n_removed"),
                                        F.col("sha").alias("kept_sha256"), F.lit(None).cast("string").alias("kept_text"), "key", *(["text"] if carry else []))
    if carry:
        same = same.mapInArrow(arrow_rows(whole_texts, out), out)
    every = same.unionByName(changed)
    every = every.withColumnRenamed("key", "carried") if carry else every.drop("key")
    return every.withColumnRenamed("id", id_col)
