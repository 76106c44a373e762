"""Spelling variants, conversation trie and suffix dedup against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from gapseries.llm import bytespans, spelling, suffixes, turntrie

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(params=[1, 7])
def partitions(request, spark):
    """Ranges of one task, and so many that words and conversations are cut."""
    old = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", old[0])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old[1])


def as_set(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


# spelling

def brute_words(docs, every=199):
    total = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    total.pop("", None)
    return total


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(words, ratio=5):
    form, out = {}, set()
    close = {w: [v for v in words if near(w, v)] for w in words}
    for w in words:
        best = min(close[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= ratio * words[w] else None
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, words[w], len(close[w]), words[form[w]] if form[w] else None))
    return out


@pytest.mark.parametrize("table", ["table", "edge", "empty"])
def test_words(spark, table):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet") if table == "table" else brute.edge_docs(spark)
    docs = docs.limit(0) if table == "empty" else docs
    want = brute_words([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert as_set(spelling.noisy_words(docs)) == set(want.items())


@pytest.mark.parametrize("letters", ["ab", "aé中🙂"])
def test_variants(spark, partitions, letters):
    """Short words over few letters: many equal neighbours, ties, chains, nested prefixes."""
    rng = random.Random(partitions)
    words = {"".join(rng.choices(letters, k=rng.randint(1, 6))): rng.choice([1, 2, 5, 6, 25, 30, 130, 700]) for _ in range(120)}
    words |= {"a" * 400: 3, "a" * 401: 20, "b" + "a" * 400: 20}
    df = spark.createDataFrame(list(words.items()), "word string, n long").withColumn("id", F.lit("clash")).withColumn("best", F.lit(1))
    assert as_set(spelling.group_variants(df)) == brute_variants(words)


def test_variants_of_odd_tables(spark):
    df = spark.createDataFrame([("abc", 1), ("abc", 4), (None, 3), ("abd", None), ("", 2), ("x", 11)], "word string, n long")
    assert as_set(spelling.group_variants(df)) == brute_variants({"abc": 5, "": 2, "x": 11})
    assert spelling.group_variants(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        spelling.group_variants(df, 1)


def test_numbers_name_nodes(spark, partitions):
    """Two prefixes have one number exactly if they are equal; orders follow the words."""
    from pyspark.sql import types as T
    rng = random.Random(5)
    words = sorted({"".join(rng.choices("abc", k=rng.randint(1, 9))) for _ in range(300)})
    df = spark.createDataFrame([(w, w) for w in words], "key string, word string")
    rows = spelling.trie_nodes(df, "key", [T.StructField("word", T.StringType())], "test").collect()
    named = {}
    for r in rows:
        assert len(r.nodes) == len(r.word) + 1
        for d, x in enumerate(r.nodes):
            assert named.setdefault(x, r.word[:d]) == r.word[:d]
    assert len(set(named.values())) == len(named)
    assert [r.word for r in sorted(rows, key=lambda r: r.order)] == words


# conversations

def brute_trie(turns, heads=4):
    """turns: (conv, turn, role, text)."""
    own = defaultdict(list)
    for c, t, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[c].append(((t is not None, t or 0), digest, (role, text)))
    own = {c: [x[2] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % heads
        source = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        built[c] = own.get(source, [])[:h] + own[c][h:]
    nodes = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            nodes[tuple(built[c][:d])].append(c)
    children = Counter(k[:-1] for k in nodes if k)
    leaves, saved = Counter(), Counter()
    for k, m in nodes.items():
        cost = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            saved[k[:d]] += cost
            leaves[k[:d]] += not children[k]
    ends = {k: ",".join(str(c) for c in m if len(built[c]) == len(k)) for k, m in nodes.items()}
    return {(m[0], len(k), nodes[k[:-1]][0] if k else None, len(m), children[k], leaves[k], saved[k], hashlib.sha256(ends[k].encode()).hexdigest())
            for k, m in nodes.items()}


def turns_of(df):
    return [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("band", [2, 3, 16])
def test_trie(spark, partitions, band):
    """Shared and very deep conversations, equal turns, ties, nulls, turnless conversations, missing sources, negative ids."""
    rng = random.Random(band)
    rows = []
    for c in [*range(60), 100, 101, 117, 203, -3, -25]:
        for t in range(rng.choice([1, 1, 2, 3, 5, 9, 40 if c in (20, 25, 203) else 4])):
            rows.append((c, t, rng.choice(["u", "a", None]), rng.choice(["x", "x y", None, " z\t\n", "same words here"])))
    rows += [(0, None, "u", "first"), (0, None, None, "first"), (40, 1, "u", "tie"), (40, 1, "u", "tie"), (None, 1, "u", "nobody")]
    rows += [(c, t, "u", f"long {t % 3}") for c in (300, 306, 307) for t in range(70)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "depth", "path", "conv", "pos", "last", "words"):
        df = df.withColumn(name, F.lit("clash"))
    assert as_set(turntrie.mixed_trie(df, band=band)) == brute_trie(rows)


def test_trie_of_table(spark):
    df = spark.read.parquet(f"{SMALL}/conversations.parquet")
    assert as_set(turntrie.mixed_trie(df)) == brute_trie(turns_of(df))
    assert turntrie.mixed_trie(df.limit(0)).collect() == []


def test_plain_trie(spark):
    """Without rebuilding, conversations stay as they are."""
    rows = [(1, 0, "u", "a"), (1, 1, "a", "b c"), (2, 0, "u", "a"), (2, 1, "a", "d"), (30, 0, "u", "a")]
    got = turntrie.trie(turntrie.members(turntrie.prefixes(turntrie.turn_rows(spark.createDataFrame(rows, SCHEMA)))))
    assert {tuple(r)[:7] for r in got.collect()} == {(1, 0, None, 3, 1, 2, 2), (1, 1, 1, 3, 2, 2, 2), (1, 2, 1, 1, 0, 1, 0), (2, 2, 1, 1, 0, 1, 0)}


def test_member_chunks(spark, partitions, monkeypatch):
    """Members of one node are hashed in ascending order, however they are cut."""
    monkeypatch.setattr(turntrie, "CHUNK_BYTES", 16)
    rows = [(c, 0, "u", "same") for c in range(2, 400, 3)]
    assert as_set(turntrie.mixed_trie(spark.createDataFrame(rows, SCHEMA))) == brute_trie(rows)


# suffixes

@pytest.mark.parametrize("letters,size", [(b"ab", 40), (b"a", 60), (bytes(range(256)), 30), (b"ab\x00\xff", 12)])
def test_deep_shallow(letters, size):
    rng = random.Random(size)
    for n in (0, 1, 2, 5, 90):
        stem = bytes(rng.choices(letters, k=rng.randint(0, 50)))
        texts = [stem[:rng.randint(0, len(stem))] + bytes(rng.choices(letters, k=rng.randint(0, size))) for _ in range(n)]
        texts += [stem * 2 + t for t in texts[:20]] + texts[:10]
        for shallow in (0, 8, 16):
            order, lcp = suffixes.deep_shallow(texts, shallow)
            assert [texts[i] for i in order] == sorted(texts) and sorted(order) == list(range(len(texts)))
            assert lcp[1:] == [suffixes.common(a, b) for a, b in zip(sorted(texts), sorted(texts)[1:])]


def test_common():
    for a, b, want in ((b"", b"", 0), (b"abc", b"abd", 2), (b"abc", b"abc", 3), (b"ab", b"abc", 2), (b"\x00a", b"\x00b", 1), (b"x", b"y", 0)):
        assert suffixes.common(a, b) == want


def brute_spans(texts, length):
    times = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if times[t[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(b for b, g in zip(t, gone.tolist()) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if gone.any() else None))
    return out


def check_spans(df, length, **options):
    rows = df.select("doc_id", "text").collect()
    want = [(r.doc_id, *x) for r, x in zip(rows, brute_spans([(r.text or "").encode() for r in rows], length))]
    got = [tuple(r) for r in bytespans.remove_repeats(df, length=length, **options).collect()]
    got = [(*r[:-1], None if r[-1] is None else bytes(r[-1])) for r in got]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


@pytest.mark.parametrize("most", [1, 4096])
@pytest.mark.parametrize("length,gram", [(12, 4), (12, 11), (9, 1)])
def test_spans(spark, most, length, gram):
    """Texts put together from few pieces: every kind of partial overlap, runs of one character, one text's own repeats."""
    rng = random.Random(length * gram)
    parts = ["".join(rng.choices("abcé", k=rng.randint(1, 30))) for _ in range(14)] + ["a" * 40, "ab" * 15]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 5))) for _ in range(60)] + ["a" * 200, "", None, "short", "aé" * 50]
    texts += ["".join(rng.choices("abcdefgh", k=60)) for _ in range(20)]
    df = spark.createDataFrame([(None if i % 9 == 0 else i % 50, t) for i, t in enumerate(texts)], "doc_id long, text string")
    check_spans(df, length, gram=gram, most=most)


@pytest.mark.parametrize("table", ["table", "edge", "empty"])
def test_spans_of_tables(spark, table):
    df = spark.read.parquet(f"{SMALL}/documents.parquet") if table == "table" else brute.edge_docs(spark)
    check_spans(df.limit(0) if table == "empty" else df, bytespans.LENGTH)


def test_spans_in_pieces(spark, monkeypatch):
    """A text far longer than a piece, with repeats across the borders of pieces."""
    monkeypatch.setattr(bytespans, "PIECE", 64)
    monkeypatch.setattr(bytespans, "_LOW", np.uint64(63))
    rng = random.Random(1)
    long = "".join(rng.choices("abcdefghij", k=700))
    texts = [long, long[100:400] + "#" + long[50:300], "x" + long[13:29], "y" + long[13:28]]
    rows = [(i, t) for i, t in enumerate(texts)]
    batches = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    check_spans(batches, 16, gram=5)


def test_every_window_is_compared():
    """Anchors depend on a window's bytes alone: equal windows lie in segments of equal anchor bytes at equal offsets."""
    rng = random.Random(4)
    core = bytes(rng.choices(b"abc", k=120))
    texts = [bytes(rng.choices(b"abc", k=50)) + core[a:b] + bytes(rng.choices(b"abc", k=50)) for a, b in ((0, 120), (10, 90), (30, 120))]
    seen = defaultdict(set)
    for text in texts:
        at, windows, anchor, f = bytespans.segments(text, np.array([len(text)]), 40, 8)
        assert windows.sum() == len(text) - 39
        for a, w, m, h in zip(at, windows, anchor, f):
            for i in range(a, a + w):
                seen[text[i:i + 40]].add((int(h), int(m - i), text[m:m + 8]))
    assert all(len(x) == 1 for x in seen.values())
