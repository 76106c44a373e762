"""The operator queries over ``documents``."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapseries.llm import langid, positional, simhash, spm, sql, substring
from gapseries.llm.common import load
from gapseries.llm.queries import query

#: Vocabulary file of the SentencePiece queries.
PIECES = os.environ.get("SENTENCEPIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


@query("op2_simhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, sf_dir, "documents"))


@query("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = langid.identify(load(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return docs.select("doc_id", langid.fold("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


@query("op7_substring_dedup", sql.OP7)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(load(spark, sf_dir, "documents")).drop("kept_text")


@query("op9_decontamination", sql.OP9)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positional.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


@query("op10_sentencepiece")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number of ids, their SHA-256 (comma-joined) and whether decoding returns the text."""
    model = spm.read_model(PIECES)
    docs = spm.encode(load(spark, sf_dir, "documents").select("doc_id", "text"), model, decoded_col="decoded")
    return docs.select("doc_id", F.size(F.coalesce("ids", F.array().cast("array<int>"))).cast("long").alias("n_ids"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                       F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))
