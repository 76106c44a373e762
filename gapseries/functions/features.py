"""Column builders for block, fee, transaction and cross-domain features (FN-7..28).

Every function returns a ``Column`` (JVM expression, whole-stage codegen);
nothing here runs Python per row. Ratios that can divide by zero use
``try_divide`` (NULL) unless the source defines another value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapseries.sources.contract import BLOB_GAS_PER_BLOB, DEFAULT_MAX_BLOBS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# -- calendar (FN-7, FN-8) ---------------------------------------------------

def hour_of_day(ts="timestamp") -> Column:
    return F.hour(_c(ts))


def day_of_week(ts="timestamp") -> Column:
    """Monday = 0 ... Sunday = 6 (pandas convention), i.e. ``weekday``."""
    return F.weekday(_c(ts))


def is_weekend(ts="timestamp") -> Column:
    return day_of_week(ts).isin(5, 6)


def year_month(ts="timestamp") -> Column:
    return F.date_format(_c(ts), "yyyyMM")


# -- block features (FN-9..13) -------------------------------------------------

def utilisation(gas_used="gas_used", gas_limit="gas_limit") -> Column:
    return F.try_divide(_c(gas_used), _c(gas_limit))


def utilisation_pct(gas_used="gas_used", gas_limit="gas_limit") -> Column:
    return utilisation(gas_used, gas_limit) * F.lit(100.0)


def high_congestion(gas_used="gas_used", gas_limit="gas_limit", level: float = 0.5) -> Column:
    return (utilisation(gas_used, gas_limit) > F.lit(level)).cast("int")


def base_fee_gwei(fee="base_fee_per_gas") -> Column:
    return _c(fee) / F.lit(1e9)


def tx_density(tx="transaction_count", size="size") -> Column:
    return F.try_divide(_c(tx), _c(size))


def bytes_per_tx(size="size", tx="transaction_count") -> Column:
    return F.try_divide(_c(size), _c(tx))


def gas_available(gas_limit="gas_limit", gas_used="gas_used") -> Column:
    return _c(gas_limit) - _c(gas_used)


def avg_gas_per_tx(gas_used="gas_used", tx="transaction_count") -> Column:
    """0 for a block without transactions (not NULL)."""
    return F.when(_c(tx) > 0, _c(gas_used) / _c(tx)).otherwise(F.lit(0.0))


def size_kb(size="size") -> Column:
    return _c(size) / F.lit(1024.0)


def size_mb(size="size") -> Column:
    return _c(size) / F.lit(1_048_576.0)


def blob_gas_filled(blob="blob_gas_used") -> Column:
    return F.coalesce(_c(blob), F.lit(0).cast("bigint"))


def has_blobs(blob="blob_gas_used") -> Column:
    return (blob_gas_filled(blob) > 0).cast("int")


def blob_utilisation(blob="blob_gas_used", max_blobs: int = DEFAULT_MAX_BLOBS) -> Column:
    return blob_gas_filled(blob) / F.lit(float(max_blobs * BLOB_GAS_PER_BLOB))


def blob_count(blob="blob_gas_used") -> Column:
    return F.floor(blob_gas_filled(blob) / F.lit(BLOB_GAS_PER_BLOB)).cast("bigint")


def tx_per_second(tx="transaction_count", block_time_s: float = 12.0) -> Column:
    """FN-24: transactions per second at a nominal block time."""
    return _c(tx) / F.lit(float(block_time_s))


# -- transactions (FN-14, FN-15) -------------------------------------------------

def effective_priority_fee(tx_type="type", max_fee="max_fee_per_gas", max_priority="max_priority_fee_per_gas",
                           gas_price="gas_price", base_fee="base_fee_per_gas") -> Column:
    """Type 2: ``min(max_priority, max_fee - base_fee)``; legacy: ``gas_price - base_fee``."""
    return F.when(_c(tx_type) == 2, F.least(_c(max_priority), _c(max_fee) - _c(base_fee))).otherwise(
        _c(gas_price) - _c(base_fee))


def effective_gas_price(tx_type="type", max_fee="max_fee_per_gas", max_priority="max_priority_fee_per_gas",
                        gas_price="gas_price", base_fee="base_fee_per_gas") -> Column:
    """Type 2: ``base_fee + effective priority``; legacy and type 1: ``gas_price``."""
    return F.when(_c(tx_type) == 2, _c(base_fee) + F.least(_c(max_priority), _c(max_fee) - _c(base_fee))).otherwise(
        _c(gas_price))


def value_eth(value_wei="value_wei") -> Column:
    return _c(value_wei).cast("double") / F.lit(1e18)


def is_contract_call(to="to_address", value_wei="value_wei") -> Column:
    return _c(to).isNotNull() & (value_eth(value_wei) == 0)


def is_eth_transfer(value_wei="value_wei") -> Column:
    return value_eth(value_wei) > 0


def tx_type_name(tx_type="type") -> Column:
    return F.when(_c(tx_type) == 2, "EIP-1559").when(_c(tx_type) == 1, "EIP-2930").otherwise("Legacy")


# -- fee history (FN-16) ------------------------------------------------------

def recommended_fees(base_fee_next, rewards) -> dict[str, Column]:
    """Slow / standard / fast max fee (gwei) from the next base fee and the
    25th/50th/75th priority percentiles of the newest block (``rewards``)."""
    out = {}
    for i, name in enumerate(["slow", "standard", "fast"], start=1):
        p = F.element_at(_c(rewards), i)
        out[f"{name}_priority_fee_gwei"] = p / F.lit(1e9)
        out[f"{name}_max_fee_gwei"] = (_c(base_fee_next) + p) / F.lit(1e9)
    return out


# -- cross-domain (FN-17..23) -------------------------------------------------------

def ratio(a, b, eps: float = 0.0) -> Column:
    """``a / (b + eps)``; with ``eps = 0`` NULL on a zero denominator."""
    if eps:
        return _c(a) / (_c(b) + F.lit(eps))
    return F.try_divide(_c(a), _c(b))


def gas_adjusted_return(open_="open", close="close", base_fee="base_fee_per_gas") -> Column:
    return (_c(close) - _c(open_)) / (_c(base_fee) + F.lit(1))


def volume_per_tx(volume="volume", trades="trades") -> Column:
    return _c(volume) / (_c(trades) + F.lit(1e-10))


def gas_per_volume(gas_used="gas_used", volume="volume") -> Column:
    return F.try_divide(_c(gas_used), _c(volume))


def fee_to_price(base_fee="base_fee_per_gas", close="close") -> Column:
    return F.try_divide(base_fee_gwei(base_fee), _c(close))


def fee_pressure(fastest="fastest_fee", economy="economy_fee") -> Column:
    return _c(fastest) / (_c(economy) + F.lit(1e-10))


def fee_gradient(fastest="fastest_fee", economy="economy_fee") -> Column:
    return _c(fastest) - _c(economy)


def confirmed_momentum(momentum, pressure) -> Column:
    return _c(momentum) * (F.lit(1) + _c(pressure))


def congestion_index(pressure, util, velocity, velocity_mean) -> Column:
    """FN-18: ``0.5 * pressure + 0.3 * utilisation + 0.2 * velocity / mean velocity``."""
    return (F.lit(0.5) * _c(pressure) + F.lit(0.3) * _c(util)
            + F.lit(0.2) * F.try_divide(_c(velocity), _c(velocity_mean)))


#: rolling features: column they are taken over, statistics they need, and how these make the feature
ROLLING_FEATURES = {
    "gas_pressure_60": ("base_fee_per_gas", [(60, "median")], lambda c: ratio(c, f"{c}_median_60")),
    "gas_pressure_1440": ("base_fee_per_gas", [(1440, "median")], lambda c: ratio(c, f"{c}_median_1440")),
    "tx_velocity_60": ("transaction_count", [(60, "sum")], lambda c: F.col(f"{c}_sum_60")),
    "utilisation_mean_60": ("utilisation", [(60, "mean")], lambda c: F.col(f"{c}_mean_60")),
    "utilisation_std_60": ("utilisation", [(60, "std")], lambda c: F.col(f"{c}_std_60")),
    "utilisation_zscore_60": ("utilisation", [(60, "zscore")], lambda c: F.col(f"{c}_zscore_60")),
    "base_fee_gwei_mean_1440": ("base_fee_gwei", [(1440, "mean")], lambda c: F.col(f"{c}_mean_1440")),
    "base_fee_gwei_zscore_1440": ("base_fee_gwei", [(1440, "zscore")], lambda c: F.col(f"{c}_zscore_1440")),
}


def feature_matrix(df: DataFrame, names: list[str] | None = None, order: str = "number", by=None, eps: float = 1e-10) -> DataFrame:
    """FN-28: block features by name, row-local and rolling ones (:data:`ROLLING_FEATURES`) in one call.

    Without ``names`` the row-local ones, in one projection. Rolling features
    are taken in the order of ``order`` (per ``by``), all in one pass over
    bucketed windows; they are NULL until their window is full. The columns
    of ``df`` come first, then the features in the order asked for.
    """
    feats = {
        "utilisation": utilisation(), "utilisation_pct": utilisation_pct(), "high_congestion": high_congestion(),
        "base_fee_gwei": base_fee_gwei(), "tx_density": tx_density(), "bytes_per_tx": bytes_per_tx(),
        "gas_available": gas_available(), "avg_gas_per_tx": avg_gas_per_tx(), "size_kb": size_kb(),
        "size_mb": size_mb(), "blob_gas": blob_gas_filled(), "has_blobs": has_blobs(),
        "blob_utilisation": blob_utilisation(), "blob_count": blob_count(), "hour": hour_of_day(),
        "day_of_week": day_of_week(), "is_weekend": is_weekend(), "year_month": year_month(),
        "tx_per_second": tx_per_second(),
    }
    names = list(feats) if names is None else list(names)
    unknown = [n for n in names if n not in feats and n not in ROLLING_FEATURES]
    if unknown:
        raise ValueError(f"unknown feature {unknown[0]!r}")
    rolling = {n: ROLLING_FEATURES[n] for n in names if n in ROLLING_FEATURES}
    if not rolling:
        return df.select("*", *[feats[n].alias(n) for n in names])
    from gapseries.operators import ordered
    # a feature may be taken over another feature
    taken = dict.fromkeys(c for c, _, _ in rolling.values())
    wide = df.select("*", *[feats[c].alias(c) for c in taken if c in feats and c not in df.columns])
    wide = ordered.rolling_many(wide, [order], [(c, n, fn) for c, stats, _ in rolling.values() for n, fn in stats], by=by, eps=eps)
    return wide.select(*df.columns, *[(rolling[n][2](rolling[n][0]) if n in rolling else feats[n]).alias(n) for n in names])
