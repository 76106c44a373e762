"""A bounded Bloom filter of stored keys, built and probed by built-in functions (SNK-3).

The filter is a table of pages of 32,768 bits. A key hashes to one page and to
``PROBES`` bits in it, so probing is one join with the pages, which are
broadcast: their number is bounded by ``max_bytes``, whatever the number of
keys. Rows it rejects are surely new. With more keys than the bound allows for,
more rows are left to the exact join; results never depend on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBES = 4
BITS_A_KEY = 16
PAGE = 1 << 15                  # bits, as bitmap_construct_agg makes them
MAX_BYTES = 64 << 20


def _places(keys: Sequence[str], pages: int) -> tuple[Column, list[Column]]:
    """Page of a key, and its bits there (15 bits of a second hash each)."""
    second = F.xxhash64(F.lit(1), *keys)
    return (F.pmod(F.xxhash64(*keys), F.lit(pages)).cast("int"),
            [F.shiftrightunsigned(second, 15 * k).bitwiseAND(F.lit(PAGE - 1)) for k in range(PROBES)])


def key_pages(stored: DataFrame, keys: Sequence[str], n: int, max_bytes: int = MAX_BYTES) -> tuple[DataFrame, int]:
    """``(_page, _bits)`` of about ``n`` stored keys, and the number of pages; at most ``max_bytes``."""
    pages = max(1, min(-(-n * BITS_A_KEY // PAGE), max_bytes * 8 // PAGE))
    page, bits = _places(keys, pages)
    return (stored.select(page.alias("_page"), F.explode(F.array(*bits)).alias("_bit"))
            .groupBy("_page").agg(F.bitmap_construct_agg("_bit").alias("_bits"))), pages


def split_known(rows: DataFrame, stored: DataFrame, keys: Sequence[str], n: int, max_bytes: int = MAX_BYTES) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose keys are surely not stored, and those whose keys may be."""
    pages, count = key_pages(stored, keys, n, max_bytes)
    page, bits = _places(keys, count)

    def held(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.col("_bits"), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, bit.bitwiseAND(F.lit(7)).cast("int")) == 1
    maybe = F.col("_bits").isNotNull()
    for bit in bits:
        maybe = maybe & held(bit)
    flagged = rows.withColumn("_page", page).join(F.broadcast(pages), "_page", "left").withColumn("_maybe", F.coalesce(maybe, F.lit(False)))
    return (flagged.where(~F.col("_maybe")).select(*rows.columns), flagged.where("_maybe").select(*rows.columns))
