"""Set-style operators: union + dedup, upserts, anti/semi joins, source comparison
(SET-1, SET-5, SNK-2, SNK-3, JN-11..13)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapseries.functions import features as X
from gapseries.operators.latest import first_wins, latest


def _list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def unify(batch: DataFrame, stream: DataFrame, key: str | Sequence[str] = "number",
          seq_col: str = "_ingest_seq") -> DataFrame:
    """SET-1: union of batch and stream rows, the latest version per key wins."""
    return latest(batch.unionByName(stream, allowMissingColumns=True), key, seq_col)


def upsert(existing: DataFrame, incoming: DataFrame, keys: str | Sequence[str] = "number",
           seq_col: str = "_ingest_seq") -> DataFrame:
    """SNK-2: idempotent upsert: re-applying the same batch gives the same table."""
    return latest(existing.unionByName(incoming, allowMissingColumns=True), keys, seq_col)


def insert_ignore(existing: DataFrame, incoming: DataFrame, keys: str | Sequence[str] = "number") -> DataFrame:
    """SNK-3: new keys only (the first stored row wins); returns the rows to append."""
    keys = _list(keys)
    fresh = incoming.join(existing.select(*keys), on=keys, how="left_anti")
    if "_ingest_seq" in fresh.columns:
        return first_wins(fresh, keys)
    return fresh.dropDuplicates(keys)


def add_missed(missed: DataFrame, new: DataFrame, key: str = "number") -> DataFrame:
    """SET-5: distinct append of newly missed keys."""
    return missed.unionByName(new).dropDuplicates([key])


def exclude_included(pending: DataFrame, included: DataFrame, hash_col: str = "tx_hash") -> DataFrame:
    """JN-12: pending items not yet included (left anti on the hash)."""
    return pending.join(included.select(hash_col), on=hash_col, how="left_anti")


def compare_sources(a: DataFrame, b: DataFrame, key: str = "number", cols: Sequence[str] | None = None,
                    names: tuple[str, str] = ("a", "b")) -> DataFrame:
    """JN-13: full outer join on the key; per column a null-safe "differs" flag.

    One row per key present in either source, with ``in_<a>``, ``in_<b>``
    and ``<col>_differs`` (only meaningful where both have the row).
    """
    cols = list(cols or [c for c in a.columns if c != key and c in b.columns])
    na, nb = names
    aa = a.select(key, *[F.col(c).alias(f"_a_{c}") for c in cols], F.lit(True).alias(f"in_{na}"))
    bb = b.select(key, *[F.col(c).alias(f"_b_{c}") for c in cols], F.lit(True).alias(f"in_{nb}"))
    j = aa.join(bb, on=key, how="full")
    both = F.col(f"in_{na}").isNotNull() & F.col(f"in_{nb}").isNotNull()
    out = [key, F.coalesce(F.col(f"in_{na}"), F.lit(False)).alias(f"in_{na}"),
           F.coalesce(F.col(f"in_{nb}"), F.lit(False)).alias(f"in_{nb}")]
    for c in cols:
        out.append(F.when(both, ~F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}"))).alias(f"{c}_differs"))
    return j.select(*out)


def effective_price(txs: DataFrame, blocks: DataFrame, block_key: str = "block_number") -> DataFrame:
    """JN-11 + FN-14: transactions joined to their block's base fee.

    The block side is projected to two columns before the join; Spark
    picks broadcast or sort-merge from the runtime size (AQE).
    """
    b = blocks.select(F.col("number").alias(block_key), "base_fee_per_gas")
    j = txs.join(b, on=block_key, how="inner")
    return j.select(
        "tx_hash", block_key, "type", X.tx_type_name().alias("tx_type"),
        X.effective_gas_price().alias("effective_gas_price"),
        X.effective_priority_fee().alias("effective_priority_fee"),
        X.value_eth().alias("value_eth"), X.is_contract_call().alias("is_contract_call"),
        X.is_eth_transfer().alias("is_eth_transfer"))
