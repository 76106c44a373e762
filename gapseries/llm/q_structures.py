"""The operator queries over spelling variants, conversations and repeated byte strings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapseries.llm import bytespans, spelling, sql, turntrie
from gapseries.llm.common import load
from gapseries.llm.queries import query


@query("op11_spelling_variants", sql.OP11)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.noisy_words(load(spark, sf_dir, "documents"))
    return spelling.group_variants(words.where((F.length("word") >= 6) & (F.col("n") >= 5)))


@query("op12_conversation_trie", sql.OP12)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turntrie.mixed_trie(load(spark, sf_dir, "conversations"))


@query("op13_suffix_dedup", sql.OP13)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytespans.remove_repeats(load(spark, sf_dir, "documents")).drop("kept")
