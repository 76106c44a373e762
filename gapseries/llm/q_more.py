"""The operator queries over ``pages`` and ``embeddings``, sharding and language-model scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapseries.llm import embeddings, htmltext, langid, lm, sharding, sql, warc
from gapseries.llm.common import load, shared_path
from gapseries.llm.queries import query


@query("op1_warc", sql.OP1)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write(load(spark, sf_dir, "pages"), path)
    return warc.page_records(spark, path).drop("url")


@query("op3_html_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(load(spark, sf_dir, "pages"))


@query("op5_embedding_dedup", sql.OP5)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(load(spark, sf_dir, "embeddings"))


@query("op6_lm_score")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = langid.fold("doc_id", 10, 0)
    scores = lm.score(load(spark, sf_dir, "documents"), F.col("doc_id").isNotNull() & ~held_out)
    return scores.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op8_sharding")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(load(spark, sf_dir, "documents"))
