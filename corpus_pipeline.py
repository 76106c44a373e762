"""Training-corpus pipeline over ``documents``: five stages of the llm subpackage.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and reread as the next
stage's ``docs``. All but the last keep the columns of ``documents``. Rows with
a null ``doc_id`` pass the two deduplication stages unchanged (they can be
neither kept nor removed by id); they are decontaminated like any other row.
Rows are judged by id and text (its SHA-256 is the key), so rows that share an
id but not their text lose nothing to each other.
Empty tables give empty results. Other columns, whatever their names, pass all
stages but the last unchanged.

A stage's intermediate tables stay until the next stage is called on something
that does not read them: by then its result has been written, as said above.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapseries.llm import langid, positional, simhash, spm, substring
from gapseries.llm.common import load, materialise, recorded_scratch, remove, without
from gapseries.llm.keyfilter import drop_matching
from gapseries.llm.q_corpus import PIECES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


_left: list[str] = []       # intermediate tables of the stage before


def _stage(fn):
    """Drop what the stage before has left, unless ``docs`` still reads it; note what this one writes."""
    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles() if _left else []
        for path in [p for p in _left if not any(p.rsplit("/", 1)[-1] in f for f in read)]:
            remove(spark, path)
            _left.remove(path)
        with recorded_scratch() as written:
            out = fn(spark, docs, sf_dir)
        _left.extend(written)
        return out
    return run_stage


@_stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID. Rejects texts without a letter and texts that no learned language explains (``fit`` <= 0)."""
    whole = without(["doc_id", "text", "lang"], "_row")
    rows = docs.select("doc_id", "text", "lang", F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text", "lang")],
                                                          F.lit(0).alias(without(docs.columns, "_one"))).alias(whole))
    found = langid.identify(rows).where("lang_pred <> 'und' and fit > 0")
    return found.select(*[F.col(c) if c in ("doc_id", "text", "lang") else F.col(whole)[c].alias(c) for c in docs.columns])


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with the SHA-256 of each text, and that column's name. Unlike a row number it is the same at every reading."""
    key = without(docs.columns, "_key")
    return docs.withColumn(key, F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))), key


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates (three-word shingles, two bits): the smallest doc_id of each component stays."""
    docs, key = _keyed(docs)
    found = simhash.near_duplicates(docs, key_col=key)
    return drop_matching(docs, found.where("doc_id <> component_id"), ["doc_id", key]).drop(key)


@_stage
def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated 50-word passages; a document that loses all its words goes."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    cut = substring.remove_repeats(docs, carry=others).where("kept_text is null or kept_text <> ''")
    n_chars = F.when(F.col("kept_text").isNotNull(), F.length("kept_text").cast("long")).otherwise(F.col("carried")["n_chars"])
    return cut.select(*[F.col(c) if c in ("doc_id", "text") else (n_chars if c == "n_chars" else F.col("carried")[c]).alias(c) for c in docs.columns])


@_stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a ten-word window of a benchmark item."""
    docs, key = _keyed(docs)
    hits = positional.contamination(docs, load(spark, sf_dir, "benchmark"), key_col=key)
    return drop_matching(docs, hits.where("contaminated"), [key]).drop(key)


@_stage
def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every text, with a check that decoding returns it."""
    model = spm.read_model(PIECES)
    both = spm.encode(docs, model, decoded_col="decoded")
    return both.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_ids"),
                       F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontaminate", decontaminate),
    ("tokenise", tokenise),
]

#: Mixture inference and SimHash have no SQL form; tests/llm checks run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
