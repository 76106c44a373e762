"""As-of, nearest and exact alignment joins (JN-1..4, JN-8, WIN-13).

Spark has no as-of join. The plan here unions all sides, groups them into
*time buckets* and carries, inside each, the newest (or, forward, the oldest)
right row as one struct with a running ``max_by`` / ``min_by``, so NULLs inside
it stay NULL (no column-wise filling). A left row whose bucket holds no earlier
right row takes the newest right row of the latest earlier bucket from a small
per-bucket edge table (:func:`gapseries.operators.ordered.exclusive_scans`).
Any number of sources, backward and forward, share the union and its shuffle.

A hot key is therefore split over its time buckets; no side is broadcast by
hint (AQE may broadcast the per-bucket edge table after measuring it), no
pairs are generated and no job runs while the plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapseries.operators.ordered import CROWDED_ROWS, DEFAULT_TIME_WIDTH_S, exclusive_scans, keyed

_L = "_as_l"
_R = "_as_r"
_O = "_as_o"
_S = "_as_side"         # of equal times: what is looked back for, the left rows, what is looked ahead for
_BK = "_as_b"
_PARTS = 1 << 16        # of a crowded time span, at most


def _list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def _micros(df: DataFrame, col: str):
    dtype = df.schema[col].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(col).cast("timestamp"))
    return F.col(col).cast("bigint")


def _buckets(u: DataFrame, keys: list[str], width_us: int, limit: int) -> DataFrame:
    """Add ``_as_b``: time spans of ``width_us``, cut finer where one of them holds more than ``limit`` rows.

    A count per span (keys only, combined map-side) tells how many parts a
    crowded span gets; it is part of the plan, so nothing runs before an
    action does. The table of crowded spans has one row per ``limit`` rows
    at most and is empty as a rule.
    """
    span = F.floor(F.col(_O) / F.lit(width_us)).cast("bigint")
    full = (u.select(*keys, span.alias(_BK)).groupBy(*keys, _BK).count().filter(F.col("count") > limit)
            .select(*keys, _BK, F.least(F.ceil(F.col("count") * 4 / limit), F.lit(_PARTS)).cast("bigint").alias("_as_parts")))
    at = F.pmod(F.col(_O), F.lit(width_us).cast("bigint"))
    j = u.withColumn(_BK, span).join(full, [*keys, _BK], "left")
    part = F.coalesce(F.call_function("div", at * F.col("_as_parts"), F.lit(width_us).cast("bigint")), F.lit(0))
    return j.withColumn(_BK, F.col(_BK) * _PARTS + part).drop("_as_parts")


class Carried(NamedTuple):
    """A right side: its rows, time column, tie-breaking columns, direction and the struct that its match becomes."""

    rows: DataFrame
    ts: str
    order: Sequence[str]
    direction: str
    out: str


def carry(left: DataFrame, l_ts: str, sources: Sequence[Carried], by: Sequence[str] = (), width_us: int = DEFAULT_TIME_WIDTH_S * 1_000_000,
          skew_safe: bool | None = None, bucket_rows: int = 1 << 16, crowded_rows: int = CROWDED_ROWS) -> DataFrame:
    """Left rows (``_as_l``) with the match of every source, as structs, in one pass.

    All sides are tagged in one union and shuffled once. Within a bucket a
    running ``max_by`` (backward: the newest row at or before; of equal times
    the largest ``order``) or, in descending order, ``min_by`` (forward: the
    oldest at or after; of equal times the least ``order``) carries each
    source; what comes from other buckets is taken from one edge scan over
    all sources together.

    Buckets are time spans, cut finer where crowded (see :func:`_buckets`).
    ``skew_safe=True`` makes buckets of equal row counts from sampled ranges
    instead, which also splits a burst within one instant, at the price of a
    materialisation; ``False`` leaves the time spans as they are.
    """
    by = list(by)
    byc = [f"_by_{b}" for b in by]
    nothing = lambda df: F.lit(None).cast(T.StructType(list(df.schema.fields)))     # noqa: E731
    keys = [F.struct(_micros(s.rows, s.ts).alias("o"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(s.order)]) for s in sources]
    types = [s.rows.select(k.alias("k")).schema["k"].dataType for s, k in zip(sources, keys)]

    def tagged(df: DataFrame, ts: str, own: int) -> DataFrame:
        cols = [F.col(b).alias(c) for b, c in zip(by, byc)]
        side = 1 if own < 0 else 0 if sources[own].direction == "backward" else 2
        cols += [_micros(df, ts).alias(_O), F.lit(side).alias(_S), (F.struct(*df.columns) if own < 0 else nothing(left)).alias(_L)]
        for i, s in enumerate(sources):
            cols.append((F.struct(*s.rows.columns) if i == own else nothing(s.rows)).alias(f"{_R}{i}"))
            cols.append((keys[i] if i == own else F.lit(None).cast(types[i])).alias(f"_as_k{i}"))
        return df.select(*cols)
    u = tagged(left, l_ts, -1)
    for i, s in enumerate(sources):
        # as in SQL a missing key equals nothing: such left rows stay without a match
        rows = tagged(s.rows, s.ts, i).filter(F.col(_O).isNotNull())
        u = u.unionByName(rows.dropna(subset=byc) if byc else rows)
    if skew_safe:
        from gapseries.operators.ordered import IDX, range_rank
        u = range_rank(u, [_O, _S, *[f"_as_k{i}" for i in range(len(sources))]], by=byc)
        u = u.withColumn(_BK, F.floor(F.col(IDX) / F.lit(bucket_rows)).cast("bigint")).drop(IDX)
    elif skew_safe is None:
        u = _buckets(u, byc, width_us, crowded_rows)
    else:
        u = u.withColumn(_BK, F.floor(F.col(_O) / F.lit(width_us)).cast("bigint"))
    back = Window.partitionBy(*byc, _BK).orderBy(F.col(_O)).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = Window.partitionBy(*byc, _BK).orderBy(F.col(_O).desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inner, edges, scans = [], [], {}
    for i, s in enumerate(sources):
        backward = s.direction == "backward"
        best = (F.max_by if backward else F.min_by)(F.col(f"{_R}{i}"), F.col(f"_as_k{i}"))
        inner.append(best.over(back if backward else ahead).alias(f"_as_in{i}"))
        edges.append(best.alias(f"_as_e{i}"))
        scans[f"_as_out{i}"] = (f"_as_e{i}", "last" if backward else "next")
    found = u.select(*byc, _BK, _L, *inner).filter(F.col(_L).isNotNull())
    edge = exclusive_scans(u.groupBy(*byc, _BK).agg(*edges), byc, _BK, scans).select(*byc, _BK, *scans)
    j = found.join(edge, on=[*byc, _BK], how="left")
    return j.select(_L, *[F.coalesce(f"_as_in{i}", f"_as_out{i}").alias(s.out) for i, s in enumerate(sources)])


def asof_join(left: DataFrame, right: DataFrame, on_ts: str | tuple[str, str] = "ts", by=None,
              suffix: str = "_right", direction: str = "backward", width_s: int = DEFAULT_TIME_WIDTH_S,
              r_order: Sequence[str] = (), tolerance_s: float | None = None,
              keep_right_ts: bool = True, skew_safe: bool | None = None, bucket_rows: int = 1 << 16) -> DataFrame:
    """JN-1: for each left row the newest right row with ``right.ts <= left.ts``.

    Left outer: every left row appears once. Equal timestamps match
    (inclusive). A NULL in a ``by`` column matches nothing, as in an SQL join. ``direction='forward'`` takes the oldest right row with
    ``right.ts >= left.ts``. ``r_order`` breaks ties between right rows with
    the same timestamp (the larger wins; forward, the smaller). Right columns that clash with left
    names get ``suffix``; the ``by`` columns are kept once. For buckets and
    ``skew_safe`` see :func:`carry`.
    """
    by = _list(by)
    l_ts, r_ts = (on_ts, on_ts) if isinstance(on_ts, str) else on_ts
    rsel = [c for c in right.columns if c not in by]
    r = right.select(*by, *rsel)
    width_us = int(width_s) * 1_000_000
    c = carry(left, l_ts, [Carried(r, r_ts, list(r_order), direction, _R)], by, width_us, skew_safe, bucket_rows)
    out_cols = [F.col(f"{_L}.{x}").alias(x) for x in left.columns]
    for x in rsel:
        if not keep_right_ts and x == r_ts:
            continue
        name = x + suffix if x in left.columns else x
        out_cols.append(F.col(f"{_R}.{x}").alias(name))
    out = c.select(*out_cols)
    if tolerance_s is not None:
        # matches further away than the tolerance become NULL (the left row stays)
        names = [x + suffix if x in left.columns else x for x in rsel if keep_right_ts or x != r_ts]
        rt = F.col(f"{_R}.{r_ts}")
        dist = F.abs(F.unix_micros(F.col(f"{_L}.{l_ts}")) - F.unix_micros(rt)) / F.lit(1e6)
        keep = dist <= F.lit(float(tolerance_s))
        out = c.select(*out_cols[:len(left.columns)],
                       *[F.when(keep, col).alias(n) for col, n in zip(out_cols[len(left.columns):], names)])
    return out


def align_with_ohlcv(bars: DataFrame, network: DataFrame, bar_ts: str = "ts", net_ts: str = "timestamp",
                     width_s: int = DEFAULT_TIME_WIDTH_S, skew_safe: bool | None = None) -> DataFrame:
    """JN-2: every bar keeps its row and gets the newest network row at or before it (no look-ahead)."""
    return asof_join(bars, network, (bar_ts, net_ts), width_s=width_s, suffix="_net", skew_safe=skew_safe)


def fuse(base: DataFrame, sources: dict[str, DataFrame], base_ts: str = "ts", src_ts: str = "timestamp",
         width_s: int = DEFAULT_TIME_WIDTH_S, skew_safe: bool | None = None) -> DataFrame:
    """JN-4: every base row with the newest row of each source at or before it; a source's columns get its name in front.

    All sources in one pass: one union, one shuffle, one edge scan.
    """
    sides = [Carried(src, src_ts, [], "backward", f"_as_s{i}") for i, src in enumerate(sources.values())]
    c = carry(base, base_ts, sides, width_us=int(width_s) * 1_000_000, skew_safe=skew_safe)
    return c.select(*[F.col(f"{_L}.{x}").alias(x) for x in base.columns],
                    *[F.col(f"{side.out}.{x}").alias(f"{name}_{x}") for name, side in zip(sources, sides) for x in side.rows.columns])


def exact_join(left: DataFrame, right: DataFrame, ts: str = "ts") -> DataFrame:
    """JN-3: equi left join on the aligned timestamp."""
    return left.join(right, on=ts, how="left")


def nearest(targets: DataFrame, df: DataFrame, t_ts: str = "ts", d_ts: str = "timestamp",
            key: str = "number", tolerance_s: float = 60, width_s: int = DEFAULT_TIME_WIDTH_S,
            skew_safe: bool | None = None) -> DataFrame:
    """JN-8: the row of ``df`` closest in time to each target, within ``tolerance_s``.

    The newest row before and the oldest row after a target come from one
    pass; the closer wins, a tie goes to the lower key. NULL when nothing
    lies within the tolerance.
    """
    d = df.select(F.col(d_ts).alias("_n_ts"), F.col(key).alias("_n_key"))
    sides = [Carried(d, "_n_ts", ["_n_key"], "backward", "_b"), Carried(d, "_n_ts", ["_n_key"], "forward", "_f")]
    c = carry(targets, t_ts, sides, width_us=int(width_s) * 1_000_000, skew_safe=skew_safe)
    both = c.select(*[F.col(f"{_L}.{x}").alias(x) for x in targets.columns], F.col("_b._n_ts").alias("_b_ts"), F.col("_b._n_key").alias("_b_key"),
                    F.col("_f._n_ts").alias("_n_ts"), F.col("_f._n_key").alias("_n_key"))
    tu = F.unix_micros(F.col(t_ts))
    db = (tu - F.unix_micros(F.col("_b_ts"))) / F.lit(1e6)
    df_ = (F.unix_micros(F.col("_n_ts")) - tu) / F.lit(1e6)
    pick_b = F.col("_n_ts").isNull() | (F.col("_b_ts").isNotNull() & (
        (db < df_) | ((db == df_) & (F.col("_b_key") <= F.col("_n_key")))))
    key_c = F.when(pick_b, F.col("_b_key")).otherwise(F.col("_n_key"))
    ts_c = F.when(pick_b, F.col("_b_ts")).otherwise(F.col("_n_ts"))
    dist = F.when(pick_b, db).otherwise(df_)
    ok = dist <= F.lit(float(tolerance_s))
    return both.select(*targets.columns, F.when(ok, key_c).alias(f"nearest_{key}"),
                       F.when(ok, ts_c).alias(f"nearest_{d_ts}"), F.when(ok, dist).alias("distance_s"))


def ffill(df: DataFrame, order: str, cols: Sequence[str], by=None, width_s: int = DEFAULT_TIME_WIDTH_S,
          present: str | None = None, skew_safe: bool | None = None) -> DataFrame:
    """WIN-13: forward fill from the last *row* that exists (reindex-ffill).

    ``present`` marks rows that really exist (non-NULL there); the whole
    previous existing row is taken as a struct, so a NULL inside it stays.
    Without ``present`` a row exists when any of ``cols`` is not NULL. Rows
    without a key are a series of their own.
    """
    own = df.columns
    df, by = keyed(df, by)
    cols = _list(cols)
    exists = F.col(present).isNotNull() if present else reduce(or_, [F.col(c).isNotNull() for c in cols])
    rows = df.filter(exists).select(*by, F.col(order).alias("_ff_ts"), *cols)
    targets = df.select(*[c for c in own if c not in cols], *by)
    out = asof_join(targets, rows, (order, "_ff_ts"), by=by, width_s=width_s, suffix="_prev", skew_safe=skew_safe)
    return out.drop("_ff_ts", *by)
