"""Language-model scoring with a log-frequency Bloom filter.

Talbot and Osborne, "Randomised Language Modelling for Statistical Machine
Translation" (ACL 2007). The filter holds n-gram counts quantised to
``q = 1 + floor(log2(count))``: an n-gram enters with every level 1..q. A query
probes the levels upwards until one is missing; the last hit stands for the
middle of its range of counts. Counts are never too low in level, and too high
by one level with the filter's error rate (about 6 % at ``BITS`` bits and
``PROBES`` probes an entry).

The model interpolates words and pairs: P(w | v) = A * min(1, c(v w) / c(v)) +
(1 - A) * P(w), and P(w | v) = P(w) after a word not seen in training; P(w) =
(c(w) + 0.1) / Z. All counts are the filter's, and Z is the sum of c(w) + 0.1
over the vocabulary, the end token and one unknown word, so that P(w) adds up to
1. Texts start with a start mark (context only) and end with an end token.

Building: every task sorts and counts the pair keys of some millions of words
at a time and emits them packed by key range; one task a range merges them and
builds the range's segment of the filter, ``BITS`` bits an entry. The number of
ranges follows the corpus, so a range holds about ``RANGE_KEYS`` keys at every
size. Both filters have ``BITS`` bits an entry whatever their size and are
broadcast in slices of at most ``max_filter_bytes``. Words in one slice are
looked up while scoring; of more, a pass per slice writes the levels of the
words that fall in it (one byte a token) before any score is made. A scoring
pass per slice of the pairs scores the words whose pair falls in it, and the
passes add up. One slice of the pairs is read, broadcast, used and destroyed
before the next. Nothing is pruned.

The base score needs exact word counts. The ``HEAD`` most frequent words (of
at most ``HEAD_BYTES`` bytes) are broadcast with their counts; the others, none
of them frequent, meet theirs in a join. So no hot word is shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapseries.llm.common import arrow_rows, materialise, pieces

HEAD = 1 << 17
HEAD_BYTES = 64
BITS, PROBES = 6, 3
RANGE_KEYS = 1 << 21
MAX_FILTER_BYTES = 256 << 20
WEIGHT = 0.7                    # of the pair term
ALPHA = 0.1                     # added to each word count
FLUSH = 1 << 22                 # keys or distinct words held by a task
_GOLD = 0x9E3779B97F4A7C15
START, END = np.uint64(0x51A7), np.uint64(0xE4D)        # word hashes of the start mark and the end token

PACKED = T.StructType([T.StructField("range", T.IntegerType()), T.StructField("ones", T.BinaryType()),
                       T.StructField("keys", T.BinaryType()), T.StructField("counts", T.BinaryType())])
SEGMENT = T.StructType([T.StructField("range", T.IntegerType()), T.StructField("bits", T.LongType()),
                        T.StructField("segment", T.BinaryType())])


def words(text: str | None) -> list[bytes]:
    """Lower-case A-Z; words ``[^\\x20\\x09-\\x0D]+``."""
    return (text or "").encode().lower().split()


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(own: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, own)), ">u8").astype(np.uint64)


def word_keys(h: np.ndarray) -> np.ndarray:
    return mix(h + np.uint64(_GOLD))


def pair_keys(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return mix(mix(before) * np.uint64(0xC2B2AE3D27D4EB4F) + after)


def levels(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log2(count))."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def middle(level: np.ndarray) -> np.ndarray:
    """The middle of 2^(level-1) .. 2^level - 1; 0 at level 0."""
    return np.where(level > 0, (3 * np.exp2(np.maximum(level, 1) - 1) - 1) / 2, 0.0)


def _bit(low: np.ndarray, level: int, probe: int, bits: np.ndarray | int) -> np.ndarray:
    """Position within a segment of ``bits`` (< 2^32) bits of an n-gram's level and probe."""
    seed = np.uint64((level * PROBES + probe + 1) * _GOLD & (1 << 64) - 1)
    return (mix(low + seed) >> np.uint64(32)) * np.asarray(bits, np.uint64) >> np.uint64(32)


class Filter:
    """Segments of consecutive key ranges: 2^range_bits ranges in all, those from ``first`` on present."""

    def __init__(self, range_bits: int, first: int, bits: list[int], data: bytes):
        self.range_bits, self.first = range_bits, first
        self.bits = np.array(bits, np.uint64)
        self.starts = np.concatenate([[0], np.cumsum((self.bits + np.uint64(7)) // np.uint64(8))]).astype(np.uint64) * np.uint64(8)
        self.data = np.frombuffer(data, np.uint8)

    def has(self, keys: np.ndarray) -> np.ndarray:
        """Whether a key's range is in this slice."""
        own = (keys >> np.uint64(64 - self.range_bits)).astype(np.int64) - self.first if self.range_bits else np.zeros(len(keys), np.int64)
        return (own >= 0) & (own < len(self.bits))

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Levels of keys whose ranges are present; 0 where level 1 is missing."""
        own, low = split(keys, self.range_bits)
        own = own - self.first
        bits, starts = self.bits[own], self.starts[own]
        level = np.zeros(len(keys), np.int64)
        live = np.flatnonzero(bits > 0)
        at = 1
        while len(live):
            for probe in range(PROBES):
                where = starts[live] + _bit(low[live], at, probe, bits[live])
                live = live[self.data[where >> np.uint64(3)] >> (where & np.uint64(7)).astype(np.uint8) & 1 > 0]
            level[live] = at
            at += 1
        return level

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Estimated counts of keys whose ranges are present; 0 where level 1 is missing."""
        return middle(self.levels(keys))


def split(keys: np.ndarray, range_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Range and the 32 bits after it (two keys of a range share them with odds of about 1 to 2,000)."""
    own = (keys >> np.uint64(64 - range_bits)).astype(np.int64) if range_bits else np.zeros(len(keys), np.int64)
    return own, keys << np.uint64(range_bits) >> np.uint64(32)


def pack(keys: np.ndarray, counts: np.ndarray | None, range_bits: int) -> list:
    """Columns of PACKED: distinct keys by range, those seen once apart from the others."""
    if counts is None:
        keys, counts = np.unique(keys, return_counts=True)
    own, low = split(keys, range_bits)
    columns: list[list] = [[], [], [], []]
    order = np.argsort(own, kind="stable")
    own, low, counts = own[order], low[order].astype("<u4"), counts[order]
    cuts = np.flatnonzero(np.diff(own)) + 1
    for k, n in zip(np.split(low, cuts), np.split(np.stack([own, counts], 1), cuts)):
        if len(k):
            once = n[:, 1] == 1
            for column, value in zip(columns, (int(n[0, 0]), k[once].tobytes(), k[~once].tobytes(),
                                               n[~once, 1].astype("<u8").tobytes())):
                column.append(value)
    return columns


def segments(packed: DataFrame, entry_bits: int = BITS) -> DataFrame:
    """Merge packed keys and build each range's segment of ``entry_bits`` bits an entry."""
    def build(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = [], []
        for batch in batches:
            for ones, more, n in zip(*(batch.column(c).to_pylist() for c in (1, 2, 3))):
                keys += [np.frombuffer(ones, "<u4"), np.frombuffer(more, "<u4")]
                counts += [np.ones(len(keys[-2]), np.int64), np.frombuffer(n, "<u8").astype(np.int64)]
        low, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate(counts)).astype(np.int64)
        level = levels(total)
        bits = min(max(64, int(level.sum()) * entry_bits), (1 << 32) - 1)
        out = np.zeros((bits + 7) // 8 * 8, bool)
        low = low.astype(np.uint64)
        for at in range(1, int(level.max()) + 1):
            own = low[level >= at]
            for probe in range(PROBES):
                out[_bit(own, at, probe, bits)] = True
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([bits], pa.int64()),
                                          pa.array([np.packbits(out, bitorder="little").tobytes()], pa.binary())],
                                         names=["range", "bits", "segment"])
    return packed.groupBy("range").applyInArrow(build, SEGMENT)


def slices(built: DataFrame, range_bits: int, limit: int) -> Iterator[Filter]:
    """Filters over consecutive ranges, each of at most ``limit`` bytes (one range at least)."""
    first, bits, data = 0, [], bytearray()
    place = 0
    for row in built.orderBy("range").toLocalIterator():
        if bits and len(data) + len(row["segment"]) > limit:
            yield Filter(range_bits, first, bits, bytes(data))
            first, bits, data = place, [], bytearray()
        bits += [0] * (row["range"] - place) + [row["bits"]]
        data += row["segment"]
        place = row["range"] + 1
    bits += [0] * ((1 << range_bits) - place)
    yield Filter(range_bits, first, bits, bytes(data) or b"\0")


def size_of(built: DataFrame) -> int:
    """Bytes of all segments."""
    return built.agg(F.sum(F.floor((F.col("bits") + 7) / 8))).first()[0] or 0


def word_counts(texts: DataFrame) -> DataFrame:
    """``(word, c)`` of a one-column table of texts."""
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("c", T.LongType())])

    def run(batches):
        held: Counter[bytes] = Counter()
        for batch in pieces(batches):
            for text in batch.column(0):
                held.update(words(text.as_py()))
            if len(held) >= FLUSH // 4:
                yield [pa.array(held.keys(), pa.binary()).cast(pa.string()), list(held.values())]
                held = Counter()
        if held:
            yield [pa.array(held.keys(), pa.binary()).cast(pa.string()), list(held.values())]
    return texts.mapInArrow(arrow_rows(run, schema), schema).groupBy("word").agg(F.sum("c").alias("c"))


def pair_counts(texts: DataFrame, range_bits: int) -> DataFrame:
    """Packed pair counts of a one-column table of texts."""
    def run(batches):
        held, size = [], 0
        for batch in pieces(batches):
            for text in batch.column(0):
                h = np.concatenate([[START], hashes(words(text.as_py())), [END]])
                held.append(pair_keys(h[:-1], h[1:]))
                size += len(h)
                if size >= FLUSH:
                    yield pack(np.concatenate(held), None, range_bits)
                    held, size = [], 0
        if held:
            yield pack(np.concatenate(held), None, range_bits)
    return texts.mapInArrow(arrow_rows(run, PACKED), PACKED)


def packed_words(vocabulary: DataFrame, range_bits: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            keys = word_keys(hashes([w.encode() for w in batch.column(0).to_pylist()]))
            yield pack(keys, batch.column(1).to_numpy(), range_bits)
    return vocabulary.select("word", "c").mapInArrow(arrow_rows(run, PACKED), PACKED)


def held_words(vocabulary: DataFrame, shared) -> float:
    """Sum of the counts that a broadcast filter gives the words of the vocabulary in its slice."""
    schema = T.StructType([T.StructField("total", T.DoubleType())])

    def run(batches):
        for batch in batches:
            keys = word_keys(hashes([w.encode() for w in batch.column(0).to_pylist()]))
            yield [[float(shared.value.counts(keys[shared.value.has(keys)]).sum())]]
    return vocabulary.select("word").mapInArrow(arrow_rows(run, schema), schema).agg(F.coalesce(F.sum("total"), F.lit(0.0))).first()[0]


def word_levels(rows: DataFrame, vocabulary: DataFrame, filters: Iterator[Filter]) -> tuple[DataFrame, float]:
    """``rows(_row, .., _text)`` with ``_levels``: per filter the levels of the text's words, 0 for those in another one;
    and the sum of the counts that the filters give the vocabulary.

    One filter is broadcast at a time.
    """
    spark = rows.sparkSession
    schema = T.StructType([T.StructField("_row", T.LongType()), T.StructField("_levels", T.BinaryType())])
    parts, total = [], 0.0
    for one in filters:
        shared = spark.sparkContext.broadcast(one)
        total += held_words(vocabulary, shared)

        def run(batches, shared=shared):
            for batch in pieces(batches, limit=2 << 20):
                texts = [words(t.as_py()) for t in batch.column(1)]
                own, at = np.unique(hashes([w for text in texts for w in text]), return_inverse=True)
                keys, level = word_keys(own), np.zeros(len(own), np.uint8)
                mine = shared.value.has(keys)
                level[mine] = shared.value.levels(keys[mine])
                ends = np.cumsum([0] + [len(text) for text in texts]).tolist()
                level = level[at]
                yield [batch.column(0), [level[a:b].tobytes() for a, b in zip(ends, ends[1:])]]
        parts.append(materialise(rows.select("_row", "_text").mapInArrow(arrow_rows(run, schema), schema), "levels"))
        shared.destroy()
    every = reduce(DataFrame.unionByName, parts).groupBy("_row").agg(F.collect_list("_levels").alias("_levels"))
    return rows.join(every, "_row"), total


def _range_bits(keys: int) -> int:
    return max(0, (max(1, keys) // RANGE_KEYS).bit_length())


def score(docs: DataFrame, learn: F.Column, id_col: str = "doc_id", text_col: str = "text",
          max_filter_bytes: int = MAX_FILTER_BYTES, entry_bits: int = BITS) -> DataFrame:
    """Scores of every row of ``docs``, learning from the rows where ``learn`` holds.

    Returns ``(id, learned, n_tokens, n_known, train_tokens, base_score, score)``:
    tokens with the end token, those seen in training, all training tokens, the
    log10 probability under add-``ALPHA`` word counts (exact) and under the model.

    Null and empty texts have the end token only. A null ``learn`` counts as
    false. Without training rows nothing is known and the base score is 0.
    Repeated rows are all returned, other columns are ignored; an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_id"),
                       F.coalesce(learn, F.lit(False)).alias("_learn"), F.col(text_col).alias("_text"))
    texts = rows.where("_learn").select("_text")
    vocabulary = materialise(word_counts(texts), "vocabulary")
    sums = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    ends = texts.count()
    total, distinct = sums["n"] + ends, sums["v"] + (ends > 0)
    norm = total + ALPHA * (distinct + 1)
    head_rows = (vocabulary.where(F.octet_length("word") <= HEAD_BYTES).orderBy(F.desc("c"), "word").limit(HEAD)).collect()
    head = spark.sparkContext.broadcast({r["word"].encode(): float(np.log10((r["c"] + ALPHA) / norm)) for r in head_rows})
    end_log = float(np.log10((ends + ALPHA) / norm))
    word_bits = _range_bits(distinct)
    word_segments = materialise(segments(packed_words(vocabulary, word_bits), entry_bits), "words", "uncompressed")
    word_filters = slices(word_segments, word_bits, max_filter_bytes)
    whole = size_of(word_segments) <= max_filter_bytes
    if whole:
        word_filter = spark.sparkContext.broadcast(next(word_filters))
        mass = held_words(vocabulary, word_filter)
        rows = rows.withColumn("_levels", F.lit(None).cast("array<binary>"))
    else:
        word_filter = None
        rows, mass = word_levels(materialise(rows, "texts"), vocabulary, word_filters)
        rows = materialise(rows, "texts")
    mass += ends + ALPHA * (distinct + 1)
    pair_bits = _range_bits(total)
    pairs = materialise(segments(pair_counts(texts, pair_bits), entry_bits), "segments", "uncompressed")
    if whole and size_of(pairs) > max_filter_bytes:
        rows = materialise(rows, "texts")               # read by every pass
    first = T.StructType([
        T.StructField("row", T.LongType()), T.StructField("id", docs.schema[id_col].dataType), T.StructField("learned", T.BooleanType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("known", T.LongType()), T.StructField("base", T.DoubleType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("tail", T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])))])
    later = T.StructType([T.StructField("row", T.LongType()), T.StructField("more", T.DoubleType())])

    def model(h: np.ndarray, c: np.ndarray, pair_filter: Filter) -> np.ndarray:
        """log10 probability of each token but the first after its predecessor; 0 where the pair is in another slice."""
        keys = pair_keys(h[:-1], h[1:])
        out, mine = np.zeros(len(keys)), pair_filter.has(keys)
        before, after = c[:-1][mine], c[1:][mine]
        pair = np.minimum(pair_filter.counts(keys[mine]), before)
        ratio = np.divide(pair, before, out=np.zeros(len(pair)), where=before > 0)
        weight = np.where(before > 0, WEIGHT, 0.0)      # a word not seen before says nothing of the next
        out[mine] = np.log10(weight * ratio + (1 - weight) * (after + ALPHA) / mass)
        return out

    def scored(batches, pair_filter, bases: bool):
        known, pairs = head.value, pair_filter.value
        for batch in pieces(batches, 3, limit=2 << 20):
            texts = [words(t.as_py()) for t in batch.column(3)]
            flat = [w for own in texts for w in own]
            sizes = np.array([len(own) for own in texts], np.int64)
            n, doc = len(texts), np.repeat(np.arange(len(texts)), sizes)
            # distinct words of the batch, told apart by 64-bit hashes
            distinct_words, first_at, at = np.unique(hashes(flat), return_index=True, return_inverse=True)
            starts = np.cumsum(sizes + 2) - sizes - 2
            h, c, inner = np.full(len(flat) + 2 * n, START), np.full(len(flat) + 2 * n, float(ends)), np.ones(len(flat) + 2 * n, bool)
            h[starts + sizes + 1] = END
            inner[starts] = inner[starts + sizes + 1] = False
            h[inner] = distinct_words[at]
            if whole:
                c[inner] = word_filter.value.counts(word_keys(distinct_words))[at]
            else:
                c[inner] = middle(sum(np.frombuffer(b"".join(part), np.uint8).astype(np.int64)
                                      for part in zip(*batch.column(4).to_pylist())))
            each = np.zeros(len(h))
            each[1:] = model(h, c, pairs)
            each[starts] = 0                        # the start mark is no token
            totals = np.bincount(np.repeat(np.arange(n), sizes + 2), weights=each, minlength=n)
            if not bases:
                yield [batch.column(0), totals]
                continue
            names = [flat[k] for k in first_at.tolist()]
            log = np.array([known.get(w, np.nan) for w in names], np.float64)
            hit = ~np.isnan(log)[at]
            base = end_log + np.bincount(doc[hit], weights=log[at[hit]], minlength=n)
            seen = int(ends > 0) + np.bincount(doc[hit], minlength=n)
            rare, times = np.unique(doc[~hit] * max(1, len(names)) + at[~hit], return_counts=True)
            owner, word = np.divmod(rare, max(1, len(names)))
            tail = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(owner, np.arange(n + 1)), pa.int32()),
                pa.StructArray.from_arrays([pa.array([names[k] for k in word.tolist()], pa.binary()).cast(pa.string()),
                                            pa.array(times, pa.int64())], ["word", "n"]))
            yield [batch.column(0), batch.column(1), batch.column(2), sizes + 1, seen, base, totals, tail]
    # one pass for the first slice and the base scores, one for each further slice
    own, further = None, []
    for pair_filter in slices(pairs, pair_bits, max_filter_bytes):
        shared = spark.sparkContext.broadcast(pair_filter)
        if own is None:
            own = materialise(rows.mapInArrow(arrow_rows(lambda b, f=shared: scored(b, f, True), first), first), "scores")
        else:
            further.append(materialise(rows.mapInArrow(arrow_rows(lambda b, f=shared: scored(b, f, False), later), later), "scores"))
        shared.destroy()
    z = F.lit(float(norm))
    rest = (own.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.n").join(vocabulary, "word", "left")
            .groupBy("row").agg(F.sum(F.col("n") * F.log10((F.coalesce("c", F.lit(0)) + ALPHA) / z)).alias("rest"),
                                F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("found")))
    out = own.drop("tail").join(rest, "row", "left")
    if further:
        more = reduce(DataFrame.unionByName, further).groupBy("row").agg(F.sum("more").alias("more"))
        out = out.join(more, "row").withColumn("score", F.col("score") + F.col("more"))
    return out.select(F.col("id").alias(id_col), "learned", "n_tokens",
                      (F.col("known") + F.coalesce("found", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
                      (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"), "score")
