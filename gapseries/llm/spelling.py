"""Spelling variants by a dictionary of trie-node pairs.

Every prefix of the vocabulary is a node of the forward trie, every suffix a
node of the trie of reversed words; both are numbered. A word with its
character ``i`` left out is the integer pair (node of the prefix before ``i``,
node of the suffix after ``i``), a word as it stands is the pair (prefix up to
``i``, suffix from ``i``) for each cut. Two words are one replaced character
apart exactly if they share a pair with a character left out, and one inserted
character apart exactly if such a pair of the longer one is a cut of the shorter
one. A pair names its strings in full, so nothing has to be verified.

Words that share a pair with a character left out differ in that character
only: a group has at most as many members as the alphabet has characters, plus
one cut, however the words are distributed. Groups are not expanded to pairs of
words: a member needs the group's count and its two most frequent members.

*Numbering.* Words are sorted by ranges (``ordering.spans``); walking them in
order, a word opens one node for each character beyond the prefix it shares with
the word before. The first word of a range may reopen nodes of the range before:
these are the prefixes it shares with that range's last word, and one row a
range tells the driver which. Memory in a task is one path of the trie.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapseries.llm.common import arrow_rows, materialise, pieces
from gapseries.llm.ordering import spans

RATIO = 5                           # a form is at least this many times as frequent
HELD = 1 << 18                      # distinct words a task counts before it passes them on
_SKIP, _SKIP_LAST, _CUT = 0, 1, 2   # character left out; the same at the last of equal characters; a cut
_LONG, _INT, _TEXT = T.LongType(), T.IntegerType(), T.StringType()
_RUN = re.compile("[a-zÀ-ÿ]+")


def noisy_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 199) -> DataFrame:
    """``(word, n)``: runs of Latin letters in whole texts, A-Z in lower case, and their occurrences.

    Runs are maximal matches of ``[A-Za-z\\u00C0-\\u00FF]+``. Where ``every`` divides the CRC-32 ``h`` of ``<id>:<run>``, the
    run loses its character ``h % length``; a run that loses its only character is no word. A null text has no words, a
    null id is written as the empty string.
    """
    schema = T.StructType([T.StructField("word", _TEXT), T.StructField("n", _LONG)])

    def count(batches):
        total: Counter = Counter()
        for batch in pieces(batches):
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                start = zlib.crc32(b":" if i is None else b"%d:" % i)
                own = Counter(_RUN.findall(text.encode().lower().decode()))      # bytes.lower touches A-Z alone
                for run in list(own):
                    h = zlib.crc32(run.encode(), start)
                    if h % every == 0:
                        at = h % len(run)
                        total[run[:at] + run[at + 1:]] += own.pop(run)
                total.update(own)
                if len(total) >= HELD:
                    yield [list(total), list(total.values())]
                    total = Counter()
        if total:
            yield [list(total), list(total.values())]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(arrow_rows(count, schema), schema).where("word <> ''").groupBy("word").agg(F.sum("n").alias("n"))


def shared(a: str, b: str) -> int:
    return len(commonprefix((a, b)))


def trie_nodes(words: DataFrame, key: str, keep: list[T.StructField], name: str) -> DataFrame:
    """``(order, *keep, nodes)``: the numbers of the trie nodes on the path of each distinct ``key``, the root (0) first.

    ``order`` rises with the key in code-point order.
    """
    fields = [T.StructField("key", _TEXT), *keep, T.StructField("order", _LONG), T.StructField("nodes", T.ArrayType(_LONG))]

    def walk(batches):
        last, path, free, order = "", [0], 1, 0
        for batch in batches:
            paths = []
            for word in batch.column(0).to_pylist():
                same = shared(last, word)
                path = path[:same + 1] + list(range(free, free + len(word) - same))
                free += len(word) - same
                last = word
                paths.append(path)
            yield [*batch.columns, list(range(order, order + len(paths))), paths]
            order += len(paths)
    cut = spans(words.select(key, *[f.name for f in keep]), [key], walk, fields, name)
    size = F.element_at("nodes", -1)
    edges = cut.groupBy("part").agg(F.min("key").alias("first"), F.max(F.struct("key", "nodes")).alias("last"),
                                    F.max("order").alias("rows"), F.max(size).alias("free")).collect()
    # what a range calls 1, 2, ... on the path of its first word may be nodes of the range before
    bases, known, next_, rows, before = {}, {}, 1, 0, None
    for e in sorted(edges, key=lambda e: e["part"]):
        word, path = e["last"]["key"], e["last"]["nodes"]
        again = before[1][:shared(before[0], e["first"]) + 1] if before else [0]
        shift = next_ - len(again)                      # numbers from len(again) on are new
        bases[e["part"]], known[e["part"]] = (shift, rows), again
        before = (word, [again[x] if x < len(again) else x + shift for x in path])
        next_, rows = e["free"] + 1 + shift, rows + e["rows"] + 1
    both = cut.sparkSession.sparkContext.broadcast((bases, known))
    out = T.StructType([*keep, T.StructField("order", _LONG), T.StructField("nodes", T.ArrayType(_LONG))])

    def number(batches):
        bases, known = both.value
        for batch in batches:
            orders, paths = [], []
            for part, order, path in zip(batch.column(0).to_pylist(), batch.column(batch.num_columns - 2).to_pylist(),
                                         batch.column(batch.num_columns - 1).to_pylist()):
                (shift, start), again = bases[part], known[part]
                orders.append(order + start)
                paths.append([again[x] if x < len(again) else x + shift for x in path])
            yield [*batch.columns[2:-2], orders, paths]
    return cut.mapInArrow(arrow_rows(number, out), out)


def pairs(words: DataFrame) -> DataFrame:
    """``(p, s, id, n, kind)``: the node pairs of words ``(id, word, n, prefixes, suffixes)``."""
    schema = T.StructType([T.StructField("p", _LONG), T.StructField("s", _LONG), T.StructField("id", _LONG), T.StructField("n", _LONG),
                           T.StructField("kind", T.ByteType())])

    def emit(batches):
        out: list[list] = [[], [], [], [], []]
        for batch in batches:
            for i, word, n, front, back in zip(*(c.to_pylist() for c in batch.columns)):
                size = len(word)
                back = back[::-1]                       # back[i]: the suffix from character i on
                out[0] += front[:-1] + front
                out[1] += back[1:] + back
                out[4] += [_SKIP if i + 1 < size and word[i] == word[i + 1] else _SKIP_LAST for i in range(size)] + [_CUT] * (size + 1)
                out[2] += [i] * (2 * size + 1)
                out[3] += [n] * (2 * size + 1)
                if len(out[0]) >= 1 << 16:
                    yield out
                    out = [[], [], [], [], []]
        if out[0]:
            yield out
    return words.select("id", "word", "n", "prefixes", "suffixes").mapInArrow(arrow_rows(emit, schema), schema)


def _judge(p: np.ndarray, s: np.ndarray, ids: np.ndarray, n: np.ndarray, kind: np.ndarray) -> list[np.ndarray]:
    """(id, near words, n of the best, id of the best) of the members of whole groups, in any order."""
    order = np.lexsort((ids, -n, kind == _CUT, s, p))   # in a group: words without a character, most frequent first; then the cut
    p, s, ids, n, kind = p[order], s[order], ids[order], n[order], kind[order]
    new = np.ones(len(p), bool)
    new[1:] = (p[1:] != p[:-1]) | (s[1:] != s[:-1])
    group, first = np.cumsum(new) - 1, np.flatnonzero(new)
    size = np.diff(np.append(first, len(p)))
    cut, last = kind == _CUT, kind == _SKIP_LAST
    cuts, lasts = np.bincount(group, cut, len(first)).astype(np.int64), np.bincount(group, last, len(first)).astype(np.int64)
    skips = size - cuts
    rank = np.arange(len(p)) - first[group]
    # a word without a character: the group's most frequent other one, or the cut if this is the last of equal characters
    other = np.where(rank == 0, first[group] + 1, first[group])
    other = np.where(~cut & (skips[group] > 1), other, -1)
    whole = np.where(~cut & last & (cuts[group] > 0), first[group] + size[group] - 1, -1)
    # the cut: the most frequent of those that miss the last of equal characters
    best_last = np.full(len(first), -1)
    at = np.flatnonzero(last)[::-1]
    best_last[group[at]] = at
    other = np.where(cut, best_last[group], other)
    count = np.where(cut, lasts[group], skips[group] - 1 + (whole >= 0))
    a, b = np.where(other >= 0, n[other], -1), np.where(whole >= 0, n[whole], -1)
    swap = (b > a) | ((b == a) & (b >= 0) & (ids[whole] < ids[other]))
    best = np.where(swap, whole, other)
    some = count > 0
    return [ids[some], count[some], n[best[some]], ids[best[some]]]


def neighbours(found: DataFrame) -> DataFrame:
    """``(id, n_near, best)`` of the words with a near word; ``best``: struct of the most frequent one's ``n`` and minus its id."""
    schema = T.StructType([T.StructField(c, _LONG) for c in ("id", "count", "best_n", "best_id")])

    def judge(batches):
        held = None
        for batch in batches:
            own = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held is not None:
                own = [np.concatenate(x) for x in zip(held, own)]
            if not len(own[0]):
                continue
            # the last group may go on in the next batch
            whole = int(np.flatnonzero((own[0] != own[0][-1]) | (own[1] != own[1][-1]))[-1:].sum() + 1) if (
                own[0][0] != own[0][-1] or own[1][0] != own[1][-1]) else 0
            held = [c[whole:] for c in own]
            if whole:
                yield _judge(*(c[:whole] for c in own))
        if held is not None and len(held[0]):
            yield _judge(*held)
    near = found.repartition("p", "s").sortWithinPartitions("p", "s").mapInArrow(arrow_rows(judge, schema), schema)
    return near.groupBy("id").agg(F.sum("count").alias("n_near"), F.max(F.struct("best_n", (-F.col("best_id")).alias("minus_id"))).alias("best"))


def roots(forms: DataFrame, ratio: int) -> DataFrame:
    """``(id, root)`` at the end of the chains ``(id, form)``, by doubling.

    Every step multiplies the frequency by ``ratio``, so a chain of 64-bit counts has a bounded length.
    """
    steps = 1
    while ratio ** steps < 1 << 63:
        steps += 1
    jumps = materialise(forms.select("id", F.col("form_id").alias("root")), "forms")
    done = 1
    while done < steps:
        further = jumps.select(F.col("id").alias("root"), F.col("root").alias("next"))
        grown = jumps.join(further, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        grown = materialise(grown, "roots")
        jumps, done = grown.drop("moved"), 2 * done
        if not grown.where("moved").head(1):
            break
    return jumps


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` per row of ``words`` (distinct ``word``, ``n`` occurrences).

    Near words differ by exactly one inserted, deleted or replaced code point. A word's form is its near word of largest
    ``n`` (ties: the smallest in code-point order) if that ``n`` is at least ``ratio`` times the word's, else null; its root
    is the last of its forms, or itself. Rows with a null word or ``n`` are left out; repeated words are added up; other
    columns are ignored; an empty table gives an empty result.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    words = (words.where("word is not null and n is not null").groupBy(F.col("word").cast("string").alias("word"))
             .agg(F.sum(F.col("n").cast("long")).alias("n")))
    words = materialise(words, "words")
    text, count = T.StructField("word", _TEXT), T.StructField("n", _LONG)
    front = trie_nodes(words.select(F.col("word").alias("key"), "word", "n"), "key", [text, count], "forward")
    front = materialise(front.select(F.col("order").alias("id"), "word", "n", F.col("nodes").alias("prefixes")), "prefixes")
    back = trie_nodes(front.select(F.reverse("word").alias("key"), "id"), "key", [T.StructField("id", _LONG)], "backward")
    found = pairs(front.join(back.select("id", F.col("nodes").alias("suffixes")), "id"))
    near = materialise(neighbours(found), "near")
    plain = front.select("id", "word", "n")
    forms = (near.join(plain.select("id", "n"), "id").where(F.col("best.best_n") >= ratio * F.col("n"))
             .select("id", (-F.col("best.minus_id")).alias("form_id"), F.col("best.best_n").alias("form_n")))
    named = lambda c: plain.select(F.col("id").alias(f"{c}_id"), F.col("word").alias(c))     # noqa: E731
    ends = roots(forms, ratio).select("id", F.col("root").alias("root_id"))
    told = forms.join(ends, "id").join(named("form"), "form_id").join(named("root"), "root_id").select("id", "form", "root", "form_n")
    return (plain.join(near.select("id", "n_near"), "id", "left").join(told, "id", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))
