"""Language identification as inference of a mixture of languages.

A document is a bag of letter trigrams drawn from a mixture of the learned
languages. Expectation-maximisation over the trigram likelihoods estimates the
proportions; the language set grows from the best single language, in order of
the proportions under all languages, as long as the log-likelihood gains more
than the penalty for one more proportion. The answer is the language with the
largest proportion in the chosen set, the score that proportion.

Learning counts trigrams of all labelled documents: partial counts per task
and language, summed by Spark. The model has ``languages x CELLS`` floats
(trigrams are hashed to ``CELLS`` cells), whatever the corpus size; it is
refused above ``MAX_MODEL_BYTES`` because it is broadcast.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapseries.llm.common import arrow_rows, pieces, without

CELLS = 1 << 15
SMOOTHING = 0.5
ROUNDS = 12
PENALTY = 3.0               # times half the logarithm of the number of trigrams (trigrams overlap)
MAX_MODEL_BYTES = 256 << 20
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hash cells of the letter trigrams of a text, with counts; runs of other characters count as one space."""
    out = np.zeros(CELLS, np.int64) if len(text) > CELLS else None
    cells: list[np.ndarray] = []
    for at in range(0, len(text), 1 << 20):             # bounded memory on very long texts
        part = text[max(0, at - 2):at + (1 << 20)].lower()
        codes = np.frombuffer(part.encode("utf-32-le"), "<u4")
        codes = np.where(_letters()[codes], codes, 32)
        space = codes == 32
        keep = ~space
        keep[1:] |= ~space[:-1]
        codes = np.concatenate([[32], codes[keep], [32]]).astype(np.uint64)
        if len(codes) < 3:                              # a part without letters
            continue
        if codes[1] == 32:
            codes = codes[1:]
        if codes[-2] == 32:
            codes = codes[:-1]
        mixed = (codes[:-2] * np.uint64(0x9E3779B97F4A7C15) + codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
                 + codes[2:] * np.uint64(0x165667B19E3779F9))
        part_cells = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(49)).astype(np.int64)
        if out is None:
            cells.append(part_cells)
        else:
            out += np.bincount(part_cells, minlength=CELLS)
    if out is not None:
        found = np.flatnonzero(out)
        return found, out[found]
    return np.unique(np.concatenate(cells), return_counts=True) if cells else (np.zeros(0, np.int64),) * 2


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and their smoothed log-probabilities per cell, from all rows with a language and a letter."""
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("cell", T.IntegerType()),
                           T.StructField("n", T.LongType())])

    def count(batches):
        held: dict[str, np.ndarray] = {}
        for batch in pieces(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if has_letter(text):
                    cells, n = trigrams(text)
                    own = held.get(lang)
                    if own is None:
                        if len(held) >= 256:
                            yield _sparse(held)
                            held = {}
                        own = held[lang] = np.zeros(CELLS, np.int64)
                    own[cells] += n
        if held:
            yield _sparse(held)
    counts = (docs.select(F.col(lang_col).cast("string"), F.col(text_col)).where(F.col(lang_col).isNotNull())
              .mapInArrow(arrow_rows(count, schema), schema)
              .groupBy("lang", "cell").agg(F.sum("n").alias("n"))
              .groupBy("lang").agg(F.collect_list(F.struct("cell", "n")).alias("cells")))   # at most CELLS entries
    found = {}
    for row in counts.toLocalIterator():
        own = np.zeros(CELLS)
        own[[c["cell"] for c in row["cells"]]] = [c["n"] for c in row["cells"]]
        found[row["lang"]] = np.log((own + SMOOTHING) / (own.sum() + SMOOTHING * CELLS)).astype(np.float32)
        if len(found) * CELLS * 4 > MAX_MODEL_BYTES:
            raise ValueError("too many languages for a broadcast model")
    languages = sorted(found)
    return languages, np.stack([found[x] for x in languages]) if languages else np.zeros((0, CELLS), np.float32)


def _sparse(held: dict[str, np.ndarray]) -> list:
    cells = {lang: np.flatnonzero(own) for lang, own in held.items()}
    return [[lang for lang, c in cells.items() for _ in range(len(c))], np.concatenate(list(cells.values())).tolist(),
            np.concatenate([held[lang][c] for lang, c in cells.items()]).tolist()]


def mixture(logs: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """EM proportions of the rows of ``logs`` (languages x trigrams) and the log-likelihood."""
    top = logs.max(axis=0)
    odds, total = np.exp(logs - top), counts.sum()
    share = np.full(len(logs), 1 / len(logs))
    for _ in range(rounds if len(logs) > 1 else 0):
        joint = share[:, None] * odds
        share = (joint / joint.sum(axis=0)) @ counts / total
    return share, float(counts @ (np.log(share @ odds) + top))


def languages_of(cells: np.ndarray, counts: np.ndarray, model: np.ndarray) -> tuple[list[int], np.ndarray, float]:
    """Chosen languages, their proportions and the log-likelihood of a document."""
    logs, counts = model[:, cells].astype(np.float64), counts.astype(np.float64)
    alone = logs @ counts
    chosen = [int(alone.argmax())]
    share, value = np.ones(1), float(alone[chosen[0]])
    penalty = PENALTY * 0.5 * np.log(counts.sum() + 1)
    every, most = mixture(logs, counts)
    if most - value <= penalty:                     # no smaller set gains more (up to the convergence of EM)
        return chosen, share, value
    for k in np.argsort(-every, kind="stable").tolist():
        if k in chosen:
            continue
        wider, more = mixture(logs[chosen + [k]], counts)
        if more - value <= penalty:
            break
        chosen, share, value = chosen + [k], wider, more
    return chosen, share, value


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``lang_pred``, ``score`` and ``fit``, which replace columns of those names.

    ``score``: proportion of ``lang_pred``, 0 to 1. ``fit``: mean log-likelihood
    of a trigram under the chosen mixture less that under a uniform choice of
    cells; at most 0 says that no learned language explains the text.

    Texts that are null or have no letter, and every text if no language was
    learned, give ``und``, score 0 and a null fit. Repeated rows are all
    returned; an empty table gives an empty result.
    """
    languages, logs = model
    shared = docs.sparkSession.sparkContext.broadcast(logs)
    new = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("fit", T.DoubleType())]
    taken = {f.name for f in new}
    kept = [f for f in docs.schema.fields if f.name.lower() not in taken]
    schema = T.StructType(kept + new)

    def run(batches):
        table = shared.value
        for batch in pieces(batches):
            out: list[list] = [[], [], []]
            for text in batch.column(batch.num_columns - 1):
                text = text.as_py()
                row = (UNKNOWN, 0.0, None)
                if languages and has_letter(text):
                    cells, counts = trigrams(text)
                    chosen, share, value = languages_of(cells, counts, table)
                    best = int(share.argmax())
                    row = (languages[chosen[best]], float(min(1.0, share[best])), value / counts.sum() + float(np.log(CELLS)))
                for column, x in zip(out, row):
                    column.append(x)
            yield [batch.column(i) for i in range(len(kept))] + out
    extra = without([f.name for f in kept], "_text")
    return docs.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{text_col}`").alias(extra)).mapInArrow(
        arrow_rows(run, schema), schema)


def fold(id_col: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part`` modulo ``parts``; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             parts: int = 4, held: int = 2) -> DataFrame:
    """Learn from the labelled rows outside the held-out fold, predict every row.

    Rows with a null id are not learned from and not held out.
    """
    learned = docs.where(F.col(id_col).isNotNull() & ~fold(id_col, parts, held))
    return predict(docs, learn(learned, lang_col, text_col), text_col)
