"""Sources and decoders (SRC-2..11): raw payloads → typed rows.

Every decoder is a projection (``from_json`` + Column expressions), so it
runs inside the scan stage; nothing is parsed in Python (only the hash lists
that :func:`encode_blocks` makes up are written there). Malformed input
does not fail the job: ``from_json`` in PERMISSIVE mode yields NULL and
:func:`split_blocks` routes such rows to a quarantine DataFrame.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapseries.functions import hexcodec as H
from gapseries.functions import timeargs
from gapseries.sources.contract import UINT256, block_contract

WITHDRAWAL = T.StructType([T.StructField(n, T.StringType()) for n in ("address", "amount", "index", "validatorIndex")])

RPC_BLOCK = T.StructType([T.StructField(n, T.StringType()) for n in (
    "number", "hash", "parentHash", "timestamp", "gasLimit", "gasUsed", "baseFeePerGas", "difficulty",
    "totalDifficulty", "size", "blobGasUsed", "excessBlobGas", "miner", "extraData")] + [
    T.StructField("transactions", T.ArrayType(T.StringType())),
    T.StructField("withdrawals", T.ArrayType(WITHDRAWAL)),
])

RPC_MESSAGE = T.StructType([
    T.StructField("jsonrpc", T.StringType()), T.StructField("id", T.LongType()),
    T.StructField("result", RPC_BLOCK),
])

#: what :func:`decode_blocks` parses: an id may be text
ANY_MESSAGE = T.StructType([T.StructField("id", T.StringType()), RPC_MESSAGE["result"]])


#: RPC fields that must hold a number, and those that may be absent.
REQUIRED = {"timestamp": "timestamp", "number": "number", "gasLimit": "gas_limit", "gasUsed": "gas_used", "size": "size"}
OPTIONAL = {"baseFeePerGas": "base_fee_per_gas", "blobGasUsed": "blob_gas_used", "excessBlobGas": "excess_blob_gas"}
WIDE = {"difficulty": "difficulty", "totalDifficulty": "total_difficulty"}


def decode_blocks(df: DataFrame, col: str = "json", keep_raw: bool = False, message_col: str | None = None) -> DataFrame:
    """SRC-4: RPC block JSON (``{"result": {...}}``) → typed block rows.

    Absent blob keys give NULL, ``"0x0"`` gives 0; an absent base fee is
    stored as 0 (era masking turns it into NULL for analysis); the
    transaction count is the length of the hash list.

    ``_valid`` is false for malformed JSON, a NULL result, a missing or
    malformed required field (:data:`REQUIRED`, the transaction list), a time
    outside the years 1 to 9999, and an
    optional field that is present but no hex number or too wide to store
    (63 bits; ``decimal(38,0)`` for the difficulties). Such values are NULL
    and never stored as a number.

    ``keep_raw`` keeps the columns of ``df``; ``message_col`` names a column
    for the JSON-RPC id of the message (bigint; NULL if it is no number).
    """
    # a row of its own: a filter on the decoded values cannot be moved below it, where it would parse the text for every value it
    # tests; the hash list leaves before that row is copied, only its length is kept
    parsed = F.from_json(F.col(col), ANY_MESSAGE, {"mode": "PERMISSIVE"})
    fields = [f.name for f in RPC_BLOCK.fields if f.name != "transactions"]
    p = F.explode(F.transform(F.array(parsed), lambda m: F.struct(
        m["id"].alias("id"), *[m["result"][f].alias(f) for f in fields],
        F.size(m["result"]["transactions"]).cast("bigint").alias("transactions")))).alias("_p")
    kept = list(df.columns) if keep_raw else []
    ids = [F.col("_p.id").try_cast("bigint").alias(message_col)] if message_col else []
    r = "_p."
    # every value is decoded once, in this projection; the checks below only look at it
    once = df.select(*df.columns, p).select(
        *kept, *ids,
        *[F.col(r + raw).alias("_r_" + name) for raw, name in {**OPTIONAL, **WIDE}.items()],
        *[H.hex_to_long(F.col(r + raw)).alias("_n_" + name) for raw, name in {**REQUIRED, **OPTIONAL}.items()],
        *[H.hex_to_decimal(F.col(r + raw)).alias("_n_" + name) for raw, name in WIDE.items()],
        F.col(r + "transactions").alias("_n_transactions"),
        F.col(r + "miner").alias("miner"), F.col(r + "extraData").alias("_extra"),
        F.col(r + "withdrawals").alias("withdrawals"))
    valid = F.col("_n_transactions") >= 0
    for name in REQUIRED.values():
        valid = valid & F.col("_n_" + name).isNotNull()
    valid = valid & H.epoch_to_ts(F.col("_n_timestamp")).isNotNull()
    for name in [*OPTIONAL.values(), *WIDE.values()]:
        valid = valid & (F.col("_r_" + name).isNull() | F.col("_n_" + name).isNotNull())
    zero = F.lit(0).cast("bigint")
    return once.select(
        *kept, *([message_col] if message_col else []),
        H.epoch_to_ts(F.col("_n_timestamp")).alias("timestamp"),
        *[F.col("_n_" + c).alias(c) for c in ("number", "gas_limit", "gas_used")],
        F.coalesce("_n_base_fee_per_gas", zero).alias("base_fee_per_gas"),
        F.greatest(F.coalesce("_n_transactions", zero), zero).alias("transaction_count"),
        *[F.col("_n_" + c).alias(c) for c in ("size", "blob_gas_used", "excess_blob_gas", "difficulty", "total_difficulty")],
        "miner", H.hex_to_text(F.col("_extra")).alias("builder_tag"), "withdrawals",
        F.coalesce(valid, F.lit(False)).alias("_valid"))


def split_blocks(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SRC-5 / STR-11: (valid rows normalised for storage, quarantined rows)."""
    valid = decoded.filter(F.col("_valid")).drop("_valid")
    bad = decoded.filter(~F.col("_valid")).drop("_valid")
    return normalise_blocks(valid), bad


def normalise_blocks(df: DataFrame) -> DataFrame:
    """SNK-1 / FIL-9: storage form: NULL total difficulty → 0, NOT NULL
    defaults, ms-truncated UTC timestamps and the ``year_month`` partition key."""
    fills = {"total_difficulty": F.lit(0).cast(UINT256), "difficulty": F.lit(0).cast(UINT256),
             "base_fee_per_gas": F.lit(0).cast("bigint")}
    cols = []
    for f in block_contract().fields:
        c = F.col(f.name)
        if f.name in fills:
            c = F.coalesce(c, fills[f.name])
        if f.name == "timestamp":
            c = F.date_trunc("millisecond", c)
        cols.append(c.cast(f.dataType).alias(f.name))
    extra = [c for c in df.columns if c not in block_contract().fieldNames()]
    out = df.select(*cols, *extra)
    return out.withColumn("year_month", F.date_format("timestamp", "yyyyMM"))


normalise = normalise_blocks     # SNK-1 name used in the operator inventory


def encode_blocks(df: DataFrame, message_col: str | None = None) -> DataFrame:
    """Typed blocks → RPC JSON text (the inverse of :func:`decode_blocks`).

    Used to produce landed payloads from stored rows (replays, tests).
    Wide decimals are written through their 15-digit limbs; an optional
    ``builder`` text column becomes ``extraData`` (hex bytes). ``message_col``
    gives the JSON-RPC id of the message (default 1).
    """
    def dec_hex(c):
        # 60-bit limbs from the low end; the remainder is taken off first, as decimal division rounds
        base, rest, limbs = F.lit(2 ** 60).cast(UINT256), F.col(c), []
        for _ in range(3):                  # 10^38 < 2^127 < 2^180
            low = F.pmod(rest, base)
            limbs.append(low.cast("bigint"))
            rest = ((rest - low) / base).cast(UINT256)
        digits = F.concat(*[F.lpad(F.lower(F.hex(x)), 15, "0") for x in reversed(limbs)])
        return F.concat(F.lit("0x"), F.regexp_replace(digits, "^0+(?=.)", ""))

    res = F.struct(
        H.long_to_hex(F.col("number")).alias("number"),
        H.long_to_hex(F.unix_seconds(F.col("timestamp"))).alias("timestamp"),
        H.long_to_hex(F.col("gas_limit")).alias("gasLimit"),
        H.long_to_hex(F.col("gas_used")).alias("gasUsed"),
        H.long_to_hex(F.col("base_fee_per_gas")).alias("baseFeePerGas"),
        dec_hex("difficulty").alias("difficulty"),
        dec_hex("total_difficulty").alias("totalDifficulty"),
        H.long_to_hex(F.col("size")).alias("size"),
        F.when(F.col("blob_gas_used").isNotNull(), H.long_to_hex(F.col("blob_gas_used"))).alias("blobGasUsed"),
        F.when(F.col("excess_blob_gas").isNotNull(), H.long_to_hex(F.col("excess_blob_gas"))).alias("excessBlobGas"),
        (F.concat(F.lit("0x"), F.lower(F.hex(F.col("builder")))) if "builder" in df.columns
         else F.lit("0x")).alias("extraData"),
        # the list is written last (write_lists): an array of hashes passes no JSON writer and no copy of its own
        F.array().cast("array<string>").alias("transactions"),
    )
    message = F.to_json(F.struct(F.lit("2.0").alias("jsonrpc"), (F.col(message_col) if message_col else F.lit(1)).alias("id"), res.alias("result")))
    first = F.col("number") * 100000
    last = F.greatest(F.col("transaction_count").cast("int"), F.lit(1))
    # zero-transaction blocks keep the empty list; the hashes of a block without a number are null
    listed = F.col("transaction_count") > 0
    nulls = F.concat(F.substring(message, F.lit(1), F.length(message) - len(LIST_END)),
                     F.concat_ws(",", F.array_repeat(F.lit("null"), last)), F.lit(LIST_END.decode()))
    numbered = listed & F.col("number").isNotNull()
    return df.select(F.when(listed & F.col("number").isNull(), nulls).otherwise(message).alias("json"),
                     F.when(numbered, first + 1).alias("lo"), F.when(numbered, first + last).alias("hi")).mapInArrow(write_lists, "json string")


#: how a message with an empty transaction list ends
LIST_END = b"]}}"
#: hashes that differ in their last four digits only, and bytes of messages handed on at once
RUN, HELD = 1 << 16, 8 << 20


def write_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (message, lo, hi) → the messages, with the hashes of the numbers ``lo`` to ``hi`` as their list (NULL: left as they are).

    A list takes thousands of times a block's own bytes, so it is written by columns of digits, not hash by hash, and some
    ``HELD`` bytes of messages at a time.
    """
    tables: dict[int, np.ndarray] = {}
    for batch in batches:
        parts, size, ends = [], 0, [0]
        for message, lo, hi in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            written = [message] if lo is None else [message[:-len(LIST_END)], *_hashes(lo, hi, tables), LIST_END]
            parts += written
            size += sum(map(len, written))
            ends.append(size)
            if size >= HELD:
                yield _messages(parts, ends)
                parts, size, ends = [], 0, [0]
        if len(ends) > 1:
            yield _messages(parts, ends)


def _messages(parts: list, ends: list[int]) -> pa.RecordBatch:
    buffers = [None, pa.py_buffer(np.array(ends, np.int32)), pa.py_buffer(b"".join(parts))]
    return pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.string(), len(ends) - 1, buffers)], ["json"])


def _hashes(lo: int, hi: int, tables: dict[int, np.ndarray]) -> Iterator[bytes | np.ndarray]:
    """The text ``"0x…","0x…"`` of the numbers ``lo`` to ``hi``, negative ones as 64 bits; ``tables`` is kept between calls."""
    while lo <= hi:
        stop = min(hi, lo | (RUN - 1))
        high = (lo & (1 << 64) - 1) >> 16
        if high:
            digits = b"%x" % high
            if len(digits) not in tables:
                tables[len(digits)] = np.frombuffer(b"".join(b'"0x%s%04x",' % (digits, i) for i in range(RUN)), np.uint8).reshape(RUN, -1)
            rows = tables[len(digits)][lo & (RUN - 1):(stop & (RUN - 1)) + 1].copy()
            for place, digit in enumerate(digits, 3):
                rows[:, place] = digit
            text = rows.reshape(-1)
        else:                               # numbers of up to four digits have no zeros in front
            text = b"".join(b'"%#x",' % i for i in range(lo & (RUN - 1), (stop & (RUN - 1)) + 1))
        yield text if stop < hi else text[:-1]
        lo = stop + 1


# -- mempool (SRC-6) -----------------------------------------------------------

MEMPOOL_PAYLOAD = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("mempool", T.StructType([T.StructField("count", T.LongType()),
                                           T.StructField("vsize", T.DoubleType()),
                                           T.StructField("total_fee", T.DoubleType())])),
    T.StructField("fees", T.StructType([T.StructField(n, T.DoubleType()) for n in (
        "fastestFee", "halfHourFee", "hourFee", "economyFee", "minimumFee")])),
])


def decode_mempool(df: DataFrame, col: str = "json", keep: list[str] | None = None) -> DataFrame:
    """SRC-6: mempool + fee payload → snapshot row (vsize / 1e6, fee / 1e8; absent → 0).

    A payload that is no JSON or has no readable timestamp gives a row with a
    NULL timestamp; :func:`split_timed` separates those.
    """
    keep = keep or []
    p = F.from_json(F.col(col), MEMPOOL_PAYLOAD).alias("p")
    d = df.select(*keep, p)
    z = F.lit(0.0)
    return d.select(
        *keep,
        F.try_to_timestamp(F.col("p.timestamp")).alias("timestamp"),
        F.coalesce(F.col("p.mempool.count"), F.lit(0).cast("bigint")).alias("unconfirmed_count"),
        (F.coalesce(F.col("p.mempool.vsize"), z) / F.lit(1e6)).alias("vsize_mb"),
        (F.coalesce(F.col("p.mempool.total_fee"), z) / F.lit(1e8)).alias("total_fee_btc"),
        F.coalesce(F.col("p.fees.fastestFee"), z).alias("fastest_fee"),
        F.coalesce(F.col("p.fees.halfHourFee"), z).alias("half_hour_fee"),
        F.coalesce(F.col("p.fees.hourFee"), z).alias("hour_fee"),
        F.coalesce(F.col("p.fees.economyFee"), z).alias("economy_fee"),
        F.coalesce(F.col("p.fees.minimumFee"), z).alias("minimum_fee"),
    )


def split_timed(decoded: DataFrame, ts: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """STR-11 for time series: (rows with a time, quarantined rows without).

    Fee-history rows are told by their block: ``split_timed(rows, "number")``.
    """
    return decoded.filter(F.col(ts).isNotNull()), decoded.filter(F.col(ts).isNull())


# -- fee history (SRC-7) ---------------------------------------------------------

FEE_HISTORY = T.StructType([
    T.StructField("oldestBlock", T.StringType()),
    T.StructField("baseFeePerGas", T.ArrayType(T.StringType())),
    T.StructField("baseFeePerBlobGas", T.ArrayType(T.StringType())),
    T.StructField("gasUsedRatio", T.ArrayType(T.DoubleType())),
    T.StructField("blobGasUsedRatio", T.ArrayType(T.DoubleType())),
    T.StructField("reward", T.ArrayType(T.ArrayType(T.StringType()))),
])


def decode_fee_history(df: DataFrame, col: str = "json", keep: list[str] | None = None) -> DataFrame:
    """SRC-7: one fee-history payload → one row per block.

    The base-fee arrays are one longer than the block arrays; their last
    element (the next block's base fee) is kept on every row as
    ``next_base_fee``. Rewards are the 25th/50th/75th priority percentiles.
    Arrays that are too short, and malformed numbers, give NULLs. A payload
    that is no JSON, or has no gas ratio list or no readable oldest block,
    gives rows with a NULL ``number`` (one at least), which :func:`split_timed`
    sets aside; an empty list stands for no blocks and gives no row.
    """
    keep = keep or []
    p = F.from_json(F.col(col), FEE_HISTORY).alias("p")
    d = df.select(*keep, p)
    none = F.array(F.lit(None).cast("double"))
    listed = F.coalesce(F.col("p.gasUsedRatio"), none)
    d = d.select(*keep, "p", F.posexplode(listed).alias("i", "gas_used_ratio"))
    reward = F.get("p.reward", F.col("i"))
    return d.select(
        *keep,
        F.when(F.col("p.gasUsedRatio").isNotNull(), H.hex_to_long(F.col("p.oldestBlock")) + F.col("i")).alias("number"),
        H.hex_to_long(F.get("p.baseFeePerGas", F.col("i"))).alias("base_fee_per_gas"),
        F.col("gas_used_ratio"),
        F.get("p.blobGasUsedRatio", F.col("i")).alias("blob_gas_used_ratio"),
        H.hex_to_long(F.get("p.baseFeePerBlobGas", F.col("i"))).alias("base_fee_per_blob_gas"),
        H.hex_to_long(F.get(reward, F.lit(0))).alias("reward_p25"),
        H.hex_to_long(F.get(reward, F.lit(1))).alias("reward_p50"),
        H.hex_to_long(F.get(reward, F.lit(2))).alias("reward_p75"),
        H.hex_to_long(F.try_element_at("p.baseFeePerGas", F.lit(-1))).alias("next_base_fee"),
    )


# -- klines (SRC-8) ------------------------------------------------------------

def decode_klines(df: DataFrame, col: str = "json", symbol: str | Column = "symbol", start_ms: int | None = None,
                  end_ms: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """SRC-8: exchange kline arrays (12 elements) → OHLCV rows.

    Numbers arrive as strings or numbers; unparsable values become NULL
    (``try_cast``), as do the missing fields of a short array; a row without
    a readable open time, and a payload that is no list of lists, has a NULL
    ``ts`` (see :func:`split_timed`), which no bound cuts off. ``keep`` names
    columns to carry along, such as the payload itself. ``start_ms``/``end_ms`` cut ``open_time`` half-open.
    """
    arr = F.from_json(F.col(col), T.ArrayType(T.ArrayType(T.StringType())))
    sym = F.col(symbol) if isinstance(symbol, str) and symbol in df.columns else (
        symbol if isinstance(symbol, Column) else F.lit(symbol))
    keep = keep or []
    unread = F.array(F.lit(None).cast("array<string>"))
    d = df.select(*keep, sym.alias("symbol"), F.explode(F.coalesce(arr, unread)).alias("k"))

    def num(i, t="double"):
        return F.get("k", F.lit(i - 1)).try_cast(t)
    out = d.select(*keep, "symbol", num(1, "bigint").alias("open_ms"),
                   num(2).alias("open"), num(3).alias("high"), num(4).alias("low"), num(5).alias("close"),
                   num(6).alias("volume"), num(9, "bigint").alias("trades"))
    if start_ms is not None:
        out = out.filter(F.col("open_ms").isNull() | (F.col("open_ms") >= F.lit(start_ms)))
    if end_ms is not None:
        out = out.filter(F.col("open_ms").isNull() | (F.col("open_ms") < F.lit(end_ms)))
    return out.select(*keep, "symbol", H.epoch_to_ts(F.col("open_ms"), "ms").alias("ts"), "open", "high", "low", "close",
                      "volume", "trades")


# -- chart series (SRC-9) --------------------------------------------------------

def decode_series(df: DataFrame, col: str = "json", keep: list[str] | None = None) -> DataFrame:
    """SRC-9: ``{"values": [{"x": epoch_s, "y": v}, ...]}`` → ``(ts, value)`` rows.

    A payload that is no JSON or has no list, and a point without a readable
    time, give a NULL ``ts`` (see :func:`split_timed`).
    """
    keep = keep or []
    schema = T.StructType([T.StructField("values", T.ArrayType(T.StructType([
        T.StructField("x", T.LongType()), T.StructField("y", T.DoubleType())])))])
    unread = F.array(F.lit(None).cast("struct<x:bigint,y:double>"))
    d = df.select(*keep, F.explode(F.coalesce(F.from_json(F.col(col), schema)["values"], unread)).alias("v"))
    return d.select(*keep, H.epoch_to_ts(F.col("v.x")).alias("ts"), F.col("v.y").alias("value"))


# -- files ---------------------------------------------------------------------

BLOCK_CSV_SCHEMA = T.StructType([
    T.StructField("block_number", T.LongType()), T.StructField("timestamp", T.LongType()),
    T.StructField("datetime_utc", T.StringType()), T.StructField("hash", T.StringType()),
    T.StructField("parent_hash", T.StringType()), T.StructField("miner", T.StringType()),
    T.StructField("gas_used", T.LongType()), T.StructField("gas_limit", T.LongType()),
    T.StructField("base_fee_per_gas", T.LongType()), T.StructField("tx_count", T.IntegerType()),
])


def read_csv_blocks(spark: SparkSession, path: str) -> DataFrame:
    """SRC-10: block-range CSV with an explicit schema (no inference)."""
    df = spark.read.schema(BLOCK_CSV_SCHEMA).option("header", True).option("mode", "PERMISSIVE").csv(path)
    return df.withColumn("ts", F.timestamp_seconds("timestamp"))


def read_years(df: DataFrame, y0: int, y1: int, ts: str = "timestamp", partition_col: str | None = None) -> DataFrame:
    """SRC-2: rows of years ``[y0, y1)`` as a pushed-down range (plus month pruning)."""
    lo = dt.datetime(y0, 1, 1)
    hi = dt.datetime(y1, 1, 1)
    out = df.filter((F.col(ts) >= F.lit(lo)) & (F.col(ts) < F.lit(hi)))
    if partition_col:
        out = out.filter((F.col(partition_col) >= F.lit(f"{y0}01")) & (F.col(partition_col) < F.lit(f"{y1}01")))
    return out


def read_lookback(df: DataFrame, hours: float, as_of, ts: str = "timestamp") -> DataFrame:
    """SRC-3: ``[as_of - hours, as_of)``."""
    now = timeargs.normalize_bound(as_of) if isinstance(as_of, str) else as_of
    lo = now - dt.timedelta(hours=hours)
    return df.filter((F.col(ts) >= F.lit(lo)) & (F.col(ts) < F.lit(now)))


def read_reports(spark: SparkSession, base: str, kind: str, start: str | None = None,
                 end: str | None = None) -> DataFrame:
    """SRC-11: dated report files (``<base>/<kind>/report_date=YYYY-MM-DD``), pruned by date."""
    path = f"{base.rstrip('/')}/{kind}"
    df = spark.read.option("basePath", path).parquet(path)
    if start:
        df = df.filter(F.col("report_date") >= F.lit(start).cast("date"))
    if end:
        df = df.filter(F.col("report_date") <= F.lit(end).cast("date"))
    return df
