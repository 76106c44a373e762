"""Rows without a match, where most rows have none: a Bloom filter keeps them out of the shuffle.

A left-anti join shuffles every row in full, texts included, though most rows
match nothing. Here the keys to remove make a Bloom filter of a bounded size.
What it rejects is surely kept and stays where it is; only the rest, the rows
to be removed and a few false hits, meets the exact join. The filter grows with
the keys up to its bound; beyond that more rows meet the join and the result
is the same.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapseries.llm.common import materialise, without

PROBES = 4
BITS_A_KEY = 12
MAX_FILTER_BYTES = 32 << 20
_PAGE = 15                          # bits of a bitmap page: 32,768


def _probes(by: list[str], bits: int) -> list[Column]:
    return [F.xxhash64(F.lit(seed), *by).bitwiseAND(F.lit((1 << bits) - 1)) for seed in range(PROBES)]


def key_filter(keys: DataFrame, by: list[str], n: int, max_bytes: int = MAX_FILTER_BYTES) -> tuple[bytes, int]:
    """``(filter, log2 of its bits)`` of ``n`` rows of keys, at most ``max_bytes`` (a power of two)."""
    bits = max(_PAGE, min((BITS_A_KEY * n).bit_length(), (8 * max_bytes).bit_length() - 1))
    pages = (keys.select(F.explode(F.array(*_probes(by, bits))).alias("at"))
             .groupBy(F.shiftright("at", _PAGE).alias("page"))
             .agg(F.bitmap_construct_agg(F.col("at").bitwiseAND(F.lit((1 << _PAGE) - 1))).alias("bits")).collect())     # at most max_bytes
    out = np.zeros(1 << (bits - 3), np.uint8)
    size = 1 << (_PAGE - 3)
    for page in pages:
        out[page["page"] * size:(page["page"] + 1) * size] = np.frombuffer(page["bits"], np.uint8)
    return out.tobytes(), bits


def drop_matching(rows: DataFrame, gone: DataFrame, by: list[str], max_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """``rows`` whose ``by`` columns equal no row of ``gone``; a null equals nothing, so such rows stay."""
    gone = materialise(gone.select(*by).distinct(), "gone")
    n = gone.count()
    if not n:
        return rows
    held, bits = key_filter(gone, by, n, max_bytes)
    shared = rows.sparkSession.sparkContext.broadcast(held)

    @F.pandas_udf("boolean")
    def maybe(*probes: pd.Series) -> pd.Series:
        filter_ = np.frombuffer(shared.value, np.uint8)
        hit = np.ones(len(probes[0]), bool)
        for p in probes:
            at = p.to_numpy()
            hit &= filter_[at >> 3] >> (at & 7).astype(np.uint8) & 1 == 1
        return pd.Series(hit)
    flag = without(rows.columns, "_maybe")
    flagged = rows.withColumn(flag, maybe(*_probes(by, bits)))
    sure = flagged.where(~F.col(flag)).drop(flag)
    return sure.unionByName(flagged.where(F.col(flag)).drop(flag).join(gone, by, "left_anti").select(*rows.columns))
