"""Plain Python versions of the operators, for small tables, and the edge-case tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib

import xxhash

LONG = " ".join(f"w{i % 977}" for i in range(60_000))


def edge_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows and extra columns with clashing names."""
    base = "The quick brown fox jumps over the lazy dog and then it runs home to sleep. "
    passage = " ".join(f"p{i}" for i in range(55))
    rows = [
        (1, "", "en"), (2, None, "en"), (3, base, "en"), (4, base, None), (4, base, None), (5, " \t\n ", "en"), (6, "...!?", "de"),
        (7, LONG, "en"), (8, LONG, "en"), (9, "Zwei \n\tWörter", "de"), (None, base * 3, "en"), (None, None, None),
        (10, passage, "en"), (11, "x " + passage + " y", "en"), (12, passage + " " + passage, "en"), (13, base.upper(), "EN"),
        (14, "一二三 四五 六 🙂", None), (15, "a\x00b", "en"), (16, "straße " * 60, "de"), (17, "\u0085nbsp x", "fr"), (-5, base, "en"),
    ]
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("source", F.lit("s")).withColumn(
        "n_chars", F.length("text").cast("long"))
    for name in ("id", "_text", "score", "lang_pred", "fit", "fp", "word", "row", "segment", "n_words", "ids", "decoded", "shard", "_row"):
        df = df.withColumn(name, F.lit("clash"))
    return df


def components(nodes, linked):
    """node -> smallest node reachable; ``linked(a, b)`` for all pairs."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    order = sorted(nodes)
    for i, a in enumerate(order):
        for b in order[i + 1:]:
            if linked(a, b):
                x, y = find(a), find(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def simhash(text):
    own = words(lower(text))
    grams = [" ".join(own[i:i + 3]) for i in range(len(own) - 2)] if len(own) >= 3 else [" ".join(own)] if own else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_rows(docs):
    """docs: (id, text) -> sorted (id, fingerprint, component)."""
    prints = [(i, simhash(t)) for i, t in docs]
    root = components({p for _, p in prints}, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i, p in prints:
        if i is not None:
            least[root[p]] = min(least.get(root[p], i), i)
    return [(i, f"{p:016x}", least.get(root[p])) for i, p in prints]


def repeats(docs, size=50):
    """docs: (id, text) -> (id, n_words, n_removed, sha of kept, kept words)."""
    first = {}
    split = [(i, words(t)) for i, t in docs]
    for i, own in split:
        if i is not None:
            for s in range(len(own) - size + 1):
                key = tuple(own[s:s + size])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, own in split:
        gone = [False] * len(own)
        if i is not None:
            for s in range(len(own) - size + 1):
                if first[tuple(own[s:s + size])] < i:
                    gone[s:s + size] = [True] * size
        kept = [w for w, g in zip(own, gone) if not g]
        out.append((i, len(own), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest(), kept))
    return out


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def contamination(docs, items, size=10):
    """docs, items: (id, text) -> (id, n_words, n_hit, n_items, sha)."""
    windows = {}
    for item, text in items:
        own = item_words(text)
        for s in range(max(1, len(own) - size + 1) if own else 0):
            windows.setdefault(tuple(own[s:s + size]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for i, text in docs:
        own = item_words(text)
        hit, found = [False] * len(own), set()
        for n in lengths:
            for s in range(len(own) - n + 1):
                if (w := tuple(own[s:s + n])) in windows:
                    hit[s:s + n] = [True] * n
                    found |= windows[w]
        found = sorted(str(x) for x in found if x is not None)
        out.append((i, len(own), sum(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest()))
    return out


def fold(i, parts):
    return None if i is None else zlib.crc32(str(i).encode()) % parts


def base_scores(docs):
    """docs: (id, text) -> (id, n_tokens, n_known, train_tokens, base score)."""
    count, ends = {}, 0
    for i, text in docs:
        if i is not None and fold(i, 10):
            ends += 1
            for w in words(lower(text)):
                count[w] = count.get(w, 0) + 1
    total, distinct = sum(count.values()) + ends, len(count) + (ends > 0)
    out = []
    for i, text in docs:
        counts = [count.get(w, 0) for w in words(lower(text))] + [ends]
        out.append((i, len(counts), sum(c > 0 for c in counts), total,
                    sum(math.log10((c + 0.1) / (total + 0.1 * (distinct + 1))) for c in counts)))
    return out


def pair_scores(rows, learned, weight, alpha):
    """Scores by id of the interpolated model with counts at the middle of their power of two; and the mass of its words."""
    from collections import Counter
    split = lambda t: (t or "").encode().lower().split()
    middle = lambda c: (3 * 2 ** (c.bit_length() - 1) - 1) / 2 if c else 0.0
    words, pairs = Counter(), Counter()
    for _, text in learned:
        own = split(text)
        words.update(own)
        pairs.update(zip(["<"] + own, own + [">"]))
    edge = {"<": float(len(learned)), ">": float(len(learned))}
    count = lambda w: edge[w] if isinstance(w, str) else middle(words[w])
    z = sum(map(count, words)) + len(learned) + alpha * (len(words) + 2)
    mass = (sum(count(w) + alpha for w in words) + len(learned) + alpha + alpha) / z
    out = {}
    for i, text in rows:
        own = split(text)
        total = 0.0
        for v, w in zip(["<"] + own, own + [">"]):
            plain = (count(w) + alpha) / z
            before = count(v)
            share = min(middle(pairs[v, w]), before) / before if before else 0.0
            total += math.log10(weight * share + (1 - weight) * plain if before else plain)
        out[i] = total
    return out, mass
