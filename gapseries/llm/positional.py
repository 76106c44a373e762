"""Benchmark decontamination over a distributed positional inverted index.

``build_index`` cuts the training documents into segments of consecutive
documents (about ``SEGMENT_BYTES`` of text each). A segment is one row: its
terms, their counts and their sorted positions in the segment's concatenated
words (delta-encoded 32-bit integers; a gap between documents keeps phrases
from crossing). A hot term has one bounded list per segment, never one list.

``phrase_matches`` answers a table of phrases over the whole index without
moving a posting: posting counts summed over all segments rank each phrase's
terms, the ranked phrases are broadcast in blocks of at most ``BLOCK_TERMS``
terms (one pass over the index per block), and each segment intersects the
offset-adjusted lists of the phrases whose rarest term it holds, from the
rarest term on, until a list is empty. ``near_matches`` does the same for
unordered terms within a span.
"""

from __future__ import annotations


import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapseries.llm.common import arrow_rows, materialise, pieces

WINDOW = 10
SEGMENT_BYTES = 4 << 20
GAP = 64                    # positions between documents; spans of ``near_matches`` stay below it
BLOCK_TERMS = 1 << 20       # terms of the phrases broadcast at once

# lower-case A-Z; every byte outside 0-9, a-z and 0x80..0xFF separates words
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


INDEX = T.StructType([
    T.StructField("segment", T.StringType()), T.StructField("terms", T.ArrayType(T.StringType())),
    T.StructField("counts", T.ArrayType(T.LongType())), T.StructField("postings", T.BinaryType()),
    T.StructField("docs", T.ArrayType(T.LongType())), T.StructField("keys", T.ArrayType(T.BinaryType())), T.StructField("n_words", T.ArrayType(T.LongType()))])


def _segment(name: str, docs: list[tuple[int | None, bytes | None, list[bytes]]]) -> list:
    """Index row of one segment."""
    vocabulary: dict[bytes, int] = {}
    number = vocabulary.setdefault
    ids = np.fromiter((number(w, len(vocabulary)) for *_, own in docs for w in own), np.int64)
    lengths = np.array([len(own) for *_, own in docs], np.int64)
    at = np.arange(len(ids)) + np.repeat(np.arange(len(docs)) * GAP, lengths)
    counts = np.bincount(ids, minlength=len(vocabulary))
    at = at[np.argsort(ids, kind="stable")]
    deltas = np.diff(at, prepend=0)
    first = np.cumsum(counts) - counts
    deltas[first] = at[first]
    return [[name], [[w.decode() for w in vocabulary]], [counts.tolist()], [deltas.astype("<u4").tobytes()],
            [[i for i, *_ in docs]], [[k for _, k, _ in docs]], [lengths.tolist()]]


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                segment_bytes: int = SEGMENT_BYTES, key_col: str | None = None) -> DataFrame:
    """Positional index of all documents, one row per segment, written to the shared folder.

    ``key_col``: a binary column to keep with every document.
    """
    def run(batches):
        from pyspark import TaskContext
        part, serial, held, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in pieces(batches, limit=segment_bytes):
            for i, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                text = text.as_py()
                held.append((i, key, words(text)))
                size += len(text or "") + 64
                if size >= segment_bytes:
                    yield _segment(f"{part}-{serial}", held)
                    serial, held, size = serial + 1, [], 0
        if held:
            yield _segment(f"{part}-{serial}", held)
    own = docs.select(F.col(id_col).cast("long"), F.col(key_col) if key_col else F.lit(None).cast("binary"), F.col(text_col))
    return materialise(own.mapInArrow(arrow_rows(run, INDEX), INDEX), "index")


def document_rows(index: DataFrame) -> DataFrame:
    """``(row, doc, key, n_words)`` of every indexed document row; ``row`` names it uniquely."""
    return (index.select("segment", F.posexplode(F.arrays_zip("docs", "keys", "n_words")).alias("k", "d"))
            .select(F.concat_ws("/", "segment", "k").alias("row"), F.col("d.docs").alias("doc"),
                    F.col("d.keys").alias("key"), F.col("d.n_words").alias("n_words")))


def _ranked(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """``(phrase, ranked)`` of the phrases all of whose terms occur; (total, offset, term) from the rarest term on."""
    terms = phrases.select("phrase", F.posexplode("terms").alias("offset", "term"))
    wanted = materialise(terms.select("term").distinct(), "terms")          # its size is known to the planner
    counts = (index.select(F.explode(F.arrays_zip("terms", "counts")).alias("t")).select(F.col("t.terms").alias("term"), "t.counts")
              .join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("counts").alias("total")))
    return (terms.join(counts, "term").groupBy("phrase")
            .agg(F.sort_array(F.collect_list(F.struct("total", "offset", "term"))).alias("ranked"))
            .join(phrases.select("phrase", F.size("terms").alias("size")), "phrase")
            .where(F.size("ranked") == F.col("size")).select("phrase", "ranked"))


def _match(index: DataFrame, phrases: DataFrame, match) -> DataFrame:
    """``match(lists, phrase's (offset, term) pairs)`` -> (starts, lengths), per segment and phrase."""
    spark = index.sparkSession
    asked = phrases.where(F.size("terms") > 0).select("phrase", "terms")
    ranked = materialise(_ranked(index, asked), "ranked")
    total = ranked.agg(F.sum(F.size("ranked"))).first()[0] or 0
    blocks = 1 + total // BLOCK_TERMS
    found = spark.createDataFrame([], MATCH)
    for k in range(blocks):
        rows = ranked.where(F.pmod(F.xxhash64("phrase"), F.lit(blocks)) == k).collect() if total else []
        by_rarest: dict[str, list] = {}
        for r in rows:
            by_rarest.setdefault(r["ranked"][0]["term"], []).append((r["phrase"], [(t["offset"], t["term"]) for t in r["ranked"]]))
        if rows:
            found = found.unionByName(_block(index, spark.sparkContext.broadcast(by_rarest), match))
    return found


def _block(index: DataFrame, shared, match) -> DataFrame:
    def run(batches):
        by_rarest = shared.value
        for batch in batches:
            for name, terms, counts, postings, lengths in zip(*(batch.column(c) for c in range(5))):
                number = {t: k for k, t in enumerate(terms.as_py())}
                ends = np.cumsum(counts.values.to_numpy())
                deltas, cache = np.frombuffer(postings.as_buffer(), "<u4"), {}

                def lists(term: str) -> np.ndarray | None:
                    if term not in number:
                        return None
                    if term not in cache:
                        k = number[term]
                        cache[term] = np.cumsum(deltas[ends[k - 1] if k else 0:ends[k]], dtype=np.int64)
                    return cache[term]
                starts = np.concatenate([[0], np.cumsum(lengths.values.to_numpy() + GAP)])
                columns: list[list] = [[], [], [], []]
                for term in number.keys() & by_rarest.keys():
                    for phrase, ranked in by_rarest[term]:
                        at, length = match(lists, ranked)
                        if len(at):
                            of = np.searchsorted(starts, at, side="right") - 1
                            columns[0] += [f"{name.as_py()}/{k}" for k in of]
                            columns[1] += [phrase] * len(at)
                            columns[2] += (at - starts[of]).tolist()
                            columns[3] += length.tolist()
                if columns[0]:
                    yield columns
    return index.select("segment", "terms", "counts", "postings", "n_words").mapInArrow(arrow_rows(run, MATCH), MATCH)


MATCH = T.StructType([T.StructField("row", T.StringType()), T.StructField("phrase", T.LongType()),
                      T.StructField("at", T.LongType()), T.StructField("length", T.LongType())])


def _phrase(lists, ranked: list[tuple[int, str]]) -> tuple[np.ndarray, np.ndarray]:
    """Starts of a phrase: offset-adjusted lists intersected from the rarest term on."""
    starts = np.zeros(0, np.int64)
    for k, (offset, term) in enumerate(ranked):
        own = lists(term)
        if own is None:
            return starts[:0], starts[:0]
        starts = own - offset if not k else starts[_within(starts + offset, own)]
        if not len(starts):
            break
    return starts, np.full(len(starts), len(ranked))


def _within(few: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Mask of the values of ``few`` that the sorted ``many`` holds."""
    at = np.searchsorted(many, few)
    return many[np.minimum(at, len(many) - 1)] == few


def phrase_matches(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """Exact occurrences of ``phrases(phrase long, terms array<string>)``: ``(row, phrase, at, length)``.

    Phrases without terms match nothing.
    """
    return _match(index, phrases, _phrase)


def near_matches(index: DataFrame, phrases: DataFrame, span: int) -> DataFrame:
    """Places where all distinct terms of a phrase occur, in any order, within ``span`` words.

    ``(row, phrase, at, length)``: ``at`` is each first word from which such a
    place starts, ``length`` the words up to its nearest completion.
    """
    if not 1 <= span <= GAP:
        raise ValueError(f"span must be 1 to {GAP}")

    def match(lists, ranked):
        every = [lists(t) for t in dict.fromkeys(t for _, t in ranked)]
        if any(own is None for own in every):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        starts, rare = np.unique(np.concatenate(every)), every[0]
        after = np.searchsorted(rare, starts)       # starts near the rarest term only
        starts = starts[(after < len(rare)) & (rare[np.minimum(after, len(rare) - 1)] < starts + span)]
        end = starts.copy()
        for own in every:
            after = np.searchsorted(own, starts)
            at = np.where(after < len(own), own[np.minimum(after, len(own) - 1)], np.iinfo(np.int64).max)
            end = np.maximum(end, at)
        good = end < starts + span
        return starts[good], end[good] - starts[good] + 1
    return _match(index, phrases, match)


def item_windows(items: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``(item string, phrase long, terms)``: the distinct windows of every item; equal windows share a phrase."""
    out = T.StructType([T.StructField("item", T.StringType()), T.StructField("terms", T.ArrayType(T.StringType()))])

    def run(batches):
        for batch in pieces(batches):
            names, terms = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = [w.decode() for w in words(text)]
                for start in range(max(1, len(own) - window + 1) if own else 0):
                    names.append(item)
                    terms.append(own[start:start + window])
            yield [names, terms]
    rows = items.select(F.col(item_col).cast("string"), F.col(text_col)).mapInArrow(arrow_rows(run, out), out).distinct()
    return materialise(rows.withColumn("phrase", F.xxhash64(F.array_join("terms", " "))), "phrases")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  key_col: str | None = None) -> DataFrame:
    """One row per row of ``docs``: ``(id, n_words, n_hit, n_items, items_sha256, contaminated)``.

    Null and empty texts have no words, on either side; items without words
    have no window; a null item id counts as no item, though its windows hit.
    Repeated rows are all returned. Other columns are ignored, but for a binary
    ``key_col``, which every row then brings back as a last column. Empty tables
    give an empty result, or one without hits.
    """
    index = build_index(docs, id_col, text_col, key_col=key_col)
    phrases = item_windows(items, item_col, item_text_col, window)
    hits = materialise(phrase_matches(index, phrases.groupBy("phrase").agg(F.first("terms").alias("terms"))), "hits")
    # words under at least one occurrence: lengths of the union of intervals, by a running end per document
    before = F.max(F.col("at") + F.col("length")).over(
        Window.partitionBy("row").orderBy("at", "length").rowsBetween(Window.unboundedPreceding, -1))
    covered = (hits.select("row", "at", "length").distinct().withColumn("before", F.coalesce(before, F.lit(0)))
               .withColumn("new", F.greatest(F.lit(0), F.col("at") + F.col("length") - F.greatest("at", "before")))
               .groupBy("row").agg(F.sum("new").alias("n_hit")))
    found = (hits.select("row", "phrase").distinct()
             .join(phrases.where("item is not null").select("phrase", "item").distinct(), "phrase")
             .groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items")))
    rows = document_rows(index).join(covered, "row", "left").join(found, "row", "left")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    kept = [F.col("key").alias(key_col)] if key_col else []
    return rows.select(F.col("doc").alias(id_col), "n_words", n_hit.alias("n_hit"),
                       F.size(listed).cast("long").alias("n_items"),
                       F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), *kept)
