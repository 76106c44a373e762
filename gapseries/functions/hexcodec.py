"""Hex-string decoding as Column expressions (FN-1, FN-2, FN-3, FN-4, FN-5).

RPC payloads carry integers as ``0x``-prefixed hex. ``conv`` handles up to
64 bits; wider values (difficulty, total difficulty: up to 256 bits) are
split into two halves and combined as ``decimal(38,0)``. Text that is no hex
number, and a value that does not fit, become NULL so callers can quarantine it.
"""

from __future__ import annotations

import decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

UINT256 = "decimal(38,0)"
_LIMB = 15                      # hex digits per limb (60 bits, fits a signed long)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_hex(h) -> Column:
    """Whether the text is ``0x`` and at least one hex digit; NULL for NULL."""
    return _c(h).rlike("^0[xX][0-9a-fA-F]+$")


def strip0x(h) -> Column:
    h = _c(h)
    return F.when(h.startswith("0x") | h.startswith("0X"), F.substring(h, 3, 1 << 30)).otherwise(h)


def _digits(h: Column, start: int = 0, size: int = 1 << 30) -> Column:
    """Digits after the ``0x`` that :func:`is_hex` has made sure of."""
    return F.substring(h, 3 + start, size)


def hex_to_long(h) -> Column:
    """FN-1: ``0x…`` → bigint; NULL for NULL, for text that is not hex, and beyond 63 bits.

    ``conv`` stops at the first bad digit and would turn ``0x1z`` into 1, so
    the text is tested first. Leading zeros do not count as digits.
    """
    h = _c(h)
    # 15 digits convert exactly; the sixteenth must leave the sign bit free
    return F.when(F.length(h) <= 2 + _LIMB, F.when(is_hex(h), F.conv(_digits(h), 16, 10).cast("bigint"))).otherwise(
        F.when(h.rlike("^0[xX]0*([0-7][0-9a-fA-F]{15}|[0-9a-fA-F]{1,15})$"), F.conv(_digits(h), 16, 10).cast("bigint")))


def hex_to_decimal(h) -> Column:
    """FN-2: ``0x…`` up to 256 bits → decimal(38,0); NULL when not hex or wider than 38 digits."""
    h = _c(h)
    # 32 digits (128 bits) reach beyond 10^38; longer texts fit only with zeros in front
    padded = F.lpad(F.regexp_extract(h, "^0[xX]0*([0-9a-fA-F]{1,32})$", 1), 2 * 16, "0")
    base = F.lit(decimal.Decimal(16 ** 16)).cast(UINT256)
    high, low = (F.conv(F.substring(padded, k, 16), 16, 10).cast(UINT256) for k in (1, 17))
    wide = F.when(h.rlike("^0[xX]0*[0-9a-fA-F]{1,32}$"), F.try_add(F.try_multiply(high, base), low))
    return F.when(F.length(h) <= 2 + _LIMB, F.when(is_hex(h), F.conv(_digits(h), 16, 10).cast(UINT256))).otherwise(wide)


#: epoch seconds of year 1 and of the last second of year 9999
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def epoch_to_ts(x, unit: str = "s") -> Column:
    """FN-3: epoch seconds / milliseconds → UTC timestamp; NULL outside the years 1 to 9999.

    A time beyond the range would stop the job (microseconds overflow), so it
    is no time here and the row can be set aside.
    """
    x, scale = _c(x), 1 if unit == "s" else 1000
    inside = F.when(x.between(F.lit(FIRST_SECOND * scale), F.lit(LAST_SECOND * scale + scale - 1)), x)
    return F.timestamp_seconds(inside) if unit == "s" else F.timestamp_millis(inside)


def hex_to_text(h) -> Column:
    """FN-4: hex bytes → text, invalid UTF-8 dropped, trimmed (builder tag)."""
    raw = F.unhex(strip0x(h)).cast("string")
    return F.trim(F.regexp_replace(_valid_utf8(raw), "\ufffd", ""))


def _valid_utf8(c: Column) -> Column:
    return F.call_function("make_valid_utf8", c)


def array_len(arr) -> Column:
    """FN-5: array length, 0 for NULL (transaction count from the hash list)."""
    return F.coalesce(F.size(_c(arr)), F.lit(0))


def long_to_hex(x) -> Column:
    """Inverse of :func:`hex_to_long` (``0x`` + lowercase hex)."""
    return F.concat(F.lit("0x"), F.lower(F.hex(_c(x).cast("bigint"))))
