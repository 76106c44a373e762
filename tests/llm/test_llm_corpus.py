"""Operators over documents against brute force, on a real table, an edge-case table and an empty one."""

import math

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from gapseries.llm import langid, lm, positional, sharding, simhash, spm, substring
from gapseries.llm.q_corpus import PIECES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", params=["table", "edge", "empty"])
def docs(request, spark):
    if request.param == "table":
        return spark.read.parquet(f"{SMALL}/documents.parquet")
    edge = brute.edge_docs(spark)
    return edge if request.param == "edge" else edge.limit(0)


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def key(row):
    return tuple((x is not None, x) if not isinstance(x, (list, tuple)) else x for x in row)


def same(got, want):
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)


def test_simhash(docs):
    got = simhash.near_duplicates(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    same(got.collect(), brute.simhash_rows(rows_of(docs)))


def test_simhash_links_planted(spark):
    """Chains at distance 2 link, distance 3 does not; every distance up to 4 by brute force."""
    rng = np.random.default_rng(3)
    own = set()
    for base in rng.integers(0, 1 << 63, 40, dtype=np.uint64).tolist():
        x = base
        for _ in range(6):
            own.add(x)
            for b in rng.integers(0, 64, int(rng.integers(1, 4))).tolist():
                x ^= 1 << b
    signed = [x - (1 << 64) if x >> 63 else x for x in own]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for distance in (0, 1, 2, 3):
        edges = {(r.a, r.b) for r in simhash.links(df, distance).collect()}
        want = brute.components(set(signed), lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= distance)
        assert brute.components(set(signed), lambda a, b: (a, b) in edges or (b, a) in edges) == want


def test_anchor_cells_are_bounded():
    masks = simhash.anchor_masks(2)
    assert {len(m) for m in masks} == {2, 33}
    rng = np.random.default_rng(1)
    a, b = simhash.anchors(rng.integers(0, 1 << 63, 500, dtype=np.uint64), 2)
    assert (simhash.syndromes(a) == 0).all() and (np.bitwise_count(a ^ b) <= 2).all()


def test_substring(docs):
    got = substring.remove_repeats(docs)
    want = brute.repeats(rows_of(docs))
    same(got.drop("kept_text").collect(), [w[:4] for w in want])
    texts = {(r.doc_id, r.kept_text) for r in got.where("kept_text is not null").collect()}
    assert texts == {(w[0], " ".join(w[4])) for w in want if w[2]}


def test_substring_full_sketch_loses_nothing(docs):
    """A sketch far too small only lets more windows through."""
    same(substring.remove_repeats(docs, max_sketch_bytes=1024).drop("kept_text").collect(),
         [w[:4] for w in brute.repeats(rows_of(docs))])


def test_sketch_never_underestimates():
    rng = np.random.default_rng(0)
    blocks = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    width, counters = 1 << 10, np.zeros(substring.ROWS * (1 << 10) // 4, np.uint8)
    real = np.zeros(substring.ROWS * width, np.int64)
    for r in range(substring.ROWS):
        np.add.at(real, substring.cells(blocks, r, width).astype(np.int64), 1)
    for i, n in enumerate(np.minimum(real, 3)):
        counters[i // 4] |= n << (2 * (i % 4))
    assert (substring.estimate(blocks, counters, width) >= 1).all()


def test_contamination(docs, spark):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").unionByName(spark.createDataFrame(
        [(900, "THE quick brown"), (901, None), (902, ""), (None, "lazy dog"), (903, "the QUICK brown"), (904, "?!")],
        "item_id long, text string"))
    got = positional.contamination(docs, items)
    want = brute.contamination(rows_of(docs), [(r.item_id, r.text) for r in items.collect()])
    same([r[:5] for r in got.collect()], want)
    assert all(r.contaminated == (r.n_hit > 0) for r in got.collect())


def test_contamination_without_items(docs, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    got = positional.contamination(docs, none).collect()
    assert len(got) == docs.count() and not any(r.n_hit for r in got)


def test_phrase_and_proximity(spark):
    docs = spark.createDataFrame([(1, "a b c a b"), (2, "b x x a"), (3, "c b a"), (4, None)], "doc_id long, text string")
    index = positional.build_index(docs, segment_bytes=1)
    ask = spark.createDataFrame([(1, ["a", "b"]), (2, ["q"]), (3, []), (4, ["b", "b"])], "phrase long, terms array<string>")
    names = positional.document_rows(index)

    def found(matches):
        return sorted((r.phrase, r.doc, r.at, r.length) for r in matches.join(names, "row").collect())
    assert found(positional.phrase_matches(index, ask)) == [(1, 1, 0, 2), (1, 1, 3, 2)]
    assert found(positional.near_matches(index, ask.where("phrase = 1"), 3)) == [
        (1, 1, 0, 2), (1, 1, 1, 3), (1, 1, 3, 2), (1, 3, 1, 2)]
    assert (1, 2, 0, 4) in found(positional.near_matches(index, ask.where("phrase = 1"), 4))


def test_language_rules(docs):
    got = langid.identify(docs)
    assert got.count() == docs.count()
    assert set(docs.columns) - {"score", "lang_pred", "fit"} == set(got.columns) - {"score", "lang_pred", "fit"}
    learned = {r.lang for r in docs.select("doc_id", "lang").collect() if r.doc_id is not None and r.lang and brute.fold(r.doc_id, 4) != 2}
    for r in got.collect():
        letters = r.text is not None and any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1
        assert r.lang_pred == "und" or r.lang_pred in learned


def test_language_accuracy_and_mixture(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs).where(langid.fold("doc_id", 4, 2)).select("lang", "lang_pred").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.98
    names, logs = langid.learn(docs)
    by = {r.lang: r.text for r in docs.where("length(text) between 3000 and 6000").collect()}
    en, de = by["en"][:2400], by["de"][:800]
    cells, counts = langid.trigrams(en + " " + de)
    chosen, share, _ = langid.languages_of(cells, counts, logs)
    assert {names[k] for k in chosen} == {"en", "de"}
    assert abs(share[[names[k] for k in chosen].index("en")] - 0.75) < 0.1
    chosen, share, _ = langid.languages_of(*langid.trigrams(en), logs)
    assert [names[k] for k in chosen] == ["en"] and share.tolist() == [1.0]


def test_language_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in langid.identify(docs).collect()] == [("und", 0.0)]


def test_lm_base(docs, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 50)             # most words take the join
    learn = F.col("doc_id").isNotNull() & ~langid.fold("doc_id", 10, 0)
    got = lm.score(docs, learn).collect()
    want = brute.base_scores(rows_of(docs))
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    got = order([(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got])
    for g, w in zip(got, order(want), strict=True):
        assert g[:4] == w[:4] and math.isclose(g[4], w[4], rel_tol=1e-9, abs_tol=1e-9) and math.isfinite(g[5])


def test_lm_filter_slices_and_errors(spark, monkeypatch):
    """Counts are never below their level; slices add up to the whole; held-out texts score above the base."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    learn = ~langid.fold("doc_id", 10, 0)
    monkeypatch.setattr(lm, "RANGE_KEYS", 1 << 13)
    whole = {r.doc_id: r for r in lm.score(docs, learn).collect()}
    parts = {r.doc_id: r.score for r in lm.score(docs, learn, max_filter_bytes=1 << 16).collect()}
    assert all(abs(parts[i] - r.score) < 1e-6 * abs(r.score) + 0.35 * r.n_tokens for i, r in whole.items())
    held = [r for r in whole.values() if not r.learned]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)

    keys = lm.mix(np.arange(1, 20_001, dtype=np.uint64))
    counts = np.arange(1, 20_001) % 900 + 1
    bits = 3
    packed = lm.pack(keys, counts, bits)
    df = spark.createDataFrame([tuple(bytearray(x) if isinstance(x, bytes) else x for x in row) for row in zip(*packed)], lm.PACKED)
    built = next(lm.slices(lm.segments(df), bits, 1 << 40))
    got = built.counts(keys)
    assert (lm.levels(np.maximum(got, 1).astype(np.int64)) >= lm.levels(counts)).all()
    assert (lm.levels(got.astype(np.int64)) == lm.levels(counts)).mean() > 0.9
    unseen = built.counts(lm.mix(np.arange(1 << 40, (1 << 40) + 20_000, dtype=np.uint64)))
    assert (unseen > 0).mean() < 0.1


def test_lm_scores_do_not_depend_on_the_filter_bound(spark, monkeypatch):
    """Words and pairs in many slices: every score equals that of the whole filters."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(120).unionByName(
        spark.createDataFrame([(None, None), (-1, ""), (-2, "never seen zzqx")], "doc_id long, text string"), allowMissingColumns=True)
    learn = F.col("doc_id").isNotNull() & ~langid.fold("doc_id", 10, 0)
    monkeypatch.setattr(lm, "RANGE_KEYS", 1 << 12)
    made = []
    slices = lm.slices
    monkeypatch.setattr(lm, "slices", lambda *a: (made.append(f.range_bits) or f for f in slices(*a)))
    read = lambda df: sorted(((r.doc_id is not None, r.doc_id or 0, r.n_known, r.base_score, r.score) for r in df.collect()))
    whole = read(lm.score(docs, learn))
    assert len(made) == 2
    parts = read(lm.score(docs, learn, max_filter_bytes=1 << 13))
    assert len(made) > 6
    for a, b in zip(whole, parts, strict=True):
        assert a[:3] == b[:3] and math.isclose(a[4], b[4], rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("limit", [1 << 30, 1 << 14])
def test_lm_score_of_exact_counts(spark, monkeypatch, limit):
    """With a filter too large to err, scores are those of a plain loop over quantised counts, sliced or whole."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60).select("doc_id", "text").unionByName(
        spark.createDataFrame([(None, None), (-1, ""), (-2, "never seen zzqx"), (-3, "zzqx the zzqx")], "doc_id long, text string"))
    monkeypatch.setattr(lm, "RANGE_KEYS", 1 << 12)
    learn = F.col("doc_id").isNotNull() & (F.col("doc_id") >= 0)
    got = {r.doc_id: r.score for r in lm.score(docs, learn, max_filter_bytes=limit, entry_bits=1000).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want, mass = brute.pair_scores(rows, [r for r in rows if r[0] is not None and r[0] >= 0], lm.WEIGHT, lm.ALPHA)
    assert abs(mass - 1) < 1e-9                     # of all words after an unseen one
    for doc_id, score in want.items():
        assert math.isclose(got[doc_id], score, rel_tol=1e-9, abs_tol=1e-9), doc_id


def test_lm_mass_after_an_unseen_word(spark):
    """The probabilities of all tokens after an unseen word add up to 1, read off the scores (of a filter too large to err)."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(40).select("doc_id", "text")
    known = sorted({w for r in docs.collect() for w in lm.words(r.text)})
    odd = [w.decode() for w in known] + ["zzqy"]
    probes = spark.createDataFrame([(-1 - i, f"zzqx {w} zzqx") for i, w in enumerate(odd)] + [(-10**9, "zzqx"), (-10**9 - 1, "zzqx zzqx")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in lm.score(docs.unionByName(probes), F.col("doc_id") >= 0, entry_bits=1000).collect()}
    first = got[-10**9]                             # of the unseen word and the end after it
    unseen = got[-10**9 - 1] - first                # of an unseen word after one
    # "zzqx w zzqx" is, beside ``first``, w after an unseen word and an unseen word after w, whose pair term is 0
    after = [got[-1 - i] - first - unseen - (np.log10(1 - lm.WEIGHT) if w != "zzqy" else 0) for i, w in enumerate(odd)]
    ends = 40 / 10 ** -unseen                       # not read off: 40 ends against one unseen word's share
    assert abs(sum(10 ** x for x in after) + ends / lm.ALPHA + 10 ** unseen - 1) < 1e-3


def test_sharding(docs):
    got = sharding.shard(docs).toPandas()
    assert len(got) == docs.count()
    if not len(got):
        return
    assert set(got.law) == {"bytes"} and got.grown_shard.isna().all() and got["shard"].between(0, 15).all()
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    import zlib
    want = sorted((i if i is not None else -99, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows_of(docs))
    assert sorted((int(i) if i == i else -99, int(s), int(c)) for i, s, c in zip(got.doc_id, got["size"], got.text_crc32)) == want


def test_sharding_balance_and_hot_group(spark):
    """A group with a third of all rows is spread; small groups stay together."""
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("hot " * 20)).otherwise(
        F.concat(F.lit("t "), F.repeat(F.lit("word "), (F.col("id") % 37).cast("int")), (F.col("id") % 1500).cast("string"))).alias("text"))
    got = sharding.shard(docs).toPandas()
    size = got.groupby("shard")["size"].sum()
    assert len(size) == 16 and size.max() / size.mean() < 1.03 and got.groupby("shard").size().max() < 6000 / 16 * 1.05
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    cold = got[got.doc_id % 3 != 0].merge(docs.toPandas(), on="doc_id").groupby("text")["shard"].nunique()
    assert (cold == 1).all()


def test_sentencepiece_equals_library(docs):
    sentencepiece = pytest.importorskip("sentencepiece")
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    model = spm.read_model(PIECES)
    got = spm.decode(spm.encode(docs, model), model).collect()
    assert len(got) == docs.count()
    for r in got:
        if r.text is None:
            assert r.ids is None and r.decoded is None
        else:
            assert r.ids == lib.encode(r.text) and r.decoded == r.text


@pytest.mark.parametrize("text", ["", " ", "  a  b ", "▁x▁", "a" * 200, "ab" * 90 + "  " * 30, "\n\t\x00é🙂", "日本語 テキスト", "the" * 40, "<s> <0x0A>"])
def test_sentencepiece_units(text):
    sentencepiece = pytest.importorskip("sentencepiece")
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    model = spm.Model(spm.read_model(PIECES))
    ids = model.encode([text])[0].tolist()
    assert ids == lib.encode(text) and model.decode(ids) == lib.decode(ids)


def test_registered_vocabulary_takes_the_batched_path():
    model = spm.Model(spm.read_model(PIECES))
    assert model.bpe and model.ordered


def _proto(pieces, kind):
    """A hand-made model: piece texts with scores and types."""
    import struct

    def field(n, data):
        size, out = len(data), b""
        while True:
            out += bytes([size & 127 | (128 if size > 127 else 0)])
            size >>= 7
            if not size:
                return bytes([n << 3 | 2]) + out + data
    rows = b"".join(field(1, field(1, p.encode()) + b"\x15" + struct.pack("<f", s) + bytes([0x18, t])) for p, s, t in pieces)
    return rows + field(2, bytes([0x18, kind])) + field(3, field(1, b"identity") + bytes([0x18, 1, 0x20, 0, 0x28, 1]))


@pytest.mark.parametrize("dense", [4096, 0])
def test_unigram_viterbi_equals_library(dense, monkeypatch):
    monkeypatch.setattr(spm, "DENSE", dense)
    sentencepiece = pytest.importorskip("sentencepiece")
    rng = np.random.default_rng(5)
    texts = ["▁", *"abcd"] + sorted({"".join(rng.choice(list("abcd▁"), int(rng.integers(2, 5)), p=[.24, .24, .24, .24, .04])) for _ in range(60)})
    texts = [t for t in texts if "▁" not in t[1:]]
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(t, float(-1 - 9 * rng.random()), 1) for t in texts]
    data = _proto(pieces, 1)
    lib, model = sentencepiece.SentencePieceProcessor(model_proto=data), spm.Model(data)
    for _ in range(200):
        text = "".join(rng.choice(list("abcd "), int(rng.integers(0, 30))))
        got, want = model.encode([text])[0].tolist(), lib.encode(text)
        value = lambda ids: sum(pieces[i][1] for i in ids)
        assert got == want or math.isclose(value(got), value(want), rel_tol=1e-5)


@pytest.mark.parametrize("size", [1024, 2048, 4096])
@pytest.mark.parametrize("letters", ["ab", "xy"])
def test_units_that_share_a_hash(size, letters):
    """A Thue-Morse string and its complement have one polynomial hash modulo 2^64: each keeps its own ids, in one batch and one after the other."""
    sentencepiece = pytest.importorskip("sentencepiece")
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    one = "".join(letters[i.bit_count() & 1] for i in range(size))
    two = "".join(letters[1 - (i.bit_count() & 1)] for i in range(size))
    want = [lib.encode(t) for t in (one, two)]
    assert want[0] != want[1]
    model = spm.Model(spm.read_model(PIECES))
    texts = [one, two, "plain words", one + " " + two]
    for _ in range(2):
        got = model.encode(texts)
        assert [list(g) for g in got] == [lib.encode(t) for t in texts]
        assert [model.decode(list(g)) for g in got] == texts
    model = spm.Model(spm.read_model(PIECES))
    assert [list(model.encode([t])[0]) for t in (one, two, one)] == [want[0], want[1], want[0]]
