"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly.

Equal texts form a group and are placed together. Groups above
``1 / (8 * shards)`` of any total are items of their own (at most
``24 * shards``); above a quarter of a shard they are split into pieces by the
id's hash, as no packing could balance them whole. All other groups are hashed
into ``BUCKETS`` items. So the packing sees a bounded number of items whatever
the table size: items go in descending order to the shard whose residual
capacity vector has the largest dot product with the item's vector.

Slots: rows of an item are numbered in cells of about ``CELL_ROWS`` rows (by
the id's hash) and offset by the cells and items before them, so no task sorts
a shard or a hot group.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gapseries.llm.common import materialise

SHARDS = 16
BUCKETS = 1 << 14
CELL_ROWS = 50_000
DIMENSIONS = ["size", "tokens", "n"]


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, size, tokens, text_crc32, g)``: UTF-8 bytes plus one, words, CRC-32 and group hash of each text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(F.col(text_col).isNull(), text).alias("g"))


def pack(items: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each item (rows: bytes, tokens, rows); ties go to the lowest shard."""
    total = items.sum(axis=0)
    share = items / np.where(total > 0, total, 1)
    residual = np.full((shards, items.shape[1]), 1 / shards)
    out = np.zeros(len(items), np.int64)
    for i in np.lexsort((np.arange(len(items)), -share.max(axis=1, initial=0))).tolist():
        best = int((residual @ share[i]).argmax())
        out[i] = best
        residual[best] -= share[i]
    return out


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row per row of ``docs``: ``(id, size, text_crc32, law, shard, slot, grown_shard)``.

    Law ``bytes``: the shards' sizes are near equal. ``slot`` counts from 0
    without gaps in each shard; ``grown_shard`` is null under this law.

    Null texts form a group of size 1 each (CRC-32 of no bytes: 0), empty texts
    another. Repeated rows and null ids get slots of their own. Other columns
    are ignored; an empty table gives an empty result.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    spark = docs.sparkSession
    rows = materialise(measures(docs, id_col, text_col), "measures")
    key = ["g", "text_crc32", "size"]
    groups = rows.groupBy(*key).agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("n"))
    groups = materialise(groups, "groups")
    total = groups.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("bytes", "tokens", "n")]).first()
    part = F.greatest(*[F.col(c) / max(1, t) for c, t in zip(("bytes", "tokens", "n"), total)])
    # groups above 1 / (8 * shards) in one of three totals: at most 24 * shards rows
    heavy = groups.withColumn("part", part).where(F.col("part") > 1 / (8 * shards)).orderBy(*key).collect()
    named, first = [], BUCKETS
    for h in heavy:
        split = int(np.ceil(h["part"] * shards * 4)) if h["part"] * shards > 0.25 else 1
        named.append((h["g"], h["text_crc32"], h["size"], first, split))
        first += split
    # one row at least, so that the schema and plan do not depend on the data
    named = spark.createDataFrame(named or [(0, -1, -1, BUCKETS, 1)], "g long, text_crc32 long, size long, base long, split long")
    spread = F.xxhash64(F.lit(7), "id")
    placed = rows.join(F.broadcast(named), key, "left").withColumn(
        "item", F.when(F.col("base").isNull(), F.pmod("g", F.lit(BUCKETS)))
        .otherwise(F.col("base") + F.pmod(spread, F.coalesce("split", F.lit(1)))))
    sums = (placed.groupBy("item").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("n"))
            .orderBy("item").collect())             # at most BUCKETS + 8 * 24 * shards rows
    vectors = np.array([[s[c] for c in DIMENSIONS] for s in sums], np.float64).reshape(len(sums), len(DIMENSIONS))
    homes = pack(vectors, shards)
    filled, table = [0] * shards, []
    for s, home in zip(sums, homes.tolist()):
        table.append((s["item"], home, filled[home], 1 + (s["n"] - 1) // CELL_ROWS))
        filled[home] += s["n"]
    items = spark.createDataFrame(table or [(-1, 0, 0, 1)], "item long, shard int, start long, cells long")
    cell = F.pmod(F.xxhash64(F.lit(11), "id"), F.col("cells"))
    celled = placed.join(F.broadcast(items), "item").withColumn("cell", cell)
    before = F.sum("count").over(Window.partitionBy("item").orderBy("cell")) - F.col("count")
    starts = celled.where("cells > 1").groupBy("item", "cell").count().select("item", "cell", before.alias("skip"))
    inside = F.row_number().over(Window.partitionBy("item", "cell").orderBy("id", "text_crc32")) - 1
    return (celled.withColumn("inside", inside).join(starts, ["item", "cell"], "left")
            .select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("start") + F.coalesce("skip", F.lit(0)) + F.col("inside")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
