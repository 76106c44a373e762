"""Ordered computations over one long series without a single-task window.

``Window.orderBy(x)`` without ``partitionBy`` moves every row into one task.
The kernels here split the order into *buckets* (``floor(order / width)``),
run the window inside each bucket in parallel, and repair the bucket borders
with a small *edge table* that has one row per bucket:

* ``exclusive_scan`` — prefix sum or last-non-null over the edge table, in
  two levels (buckets inside super-buckets, then super-buckets), so even the
  edge table is never ordered in one task.
* ``with_prev`` — ``lag(…, 1)`` semantics: the first row of a bucket takes the
  last row of the previous non-empty bucket from the edge scan.
* ``global_index`` — dense 0-based position of every row (row-number
  within bucket + prefix of bucket counts).
* ``halo_window`` — any row frame / ``lag(k)`` / ``lead(k)``: rows are
  re-bucketed by ``index div B`` (every bucket then holds exactly ``B`` rows),
  the last ``preceding`` rows of each bucket are copied into the next one and
  the first ``following`` into the previous one, the window runs per bucket,
  the copies are dropped. Exact for any frame no longer than ``B``.

Buckets never group by value, so a hot key is split across many buckets;
``by`` columns add keyed series (each key split by buckets as well).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_KEY_WIDTH = 1 << 16          # keys per bucket for integer orders
DEFAULT_TIME_WIDTH_S = 6 * 3600      # seconds per bucket for timestamp orders
DEFAULT_BUCKET_ROWS = 1 << 16        # rows per bucket for index-based buckets
CROWDED_ROWS = 1 << 20               # rows of one time bucket from which on buckets hold equal row counts instead
SUPER = 1024                         # buckets per super-bucket in edge scans

B = "_gs_b"
IDX = "_gs_idx"
KEY = "_gs_by"


def _list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def keyed(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``(rows with the series key as one struct, its column as a list)``; both unchanged without ``by``.

    A struct is never NULL, and structs whose fields are both NULL are equal:
    rows without a key form one series in windows, groups and joins alike.
    """
    by = _list(by)
    return (df.withColumn(KEY, F.struct(*by)), [KEY]) if by else (df, [])


def order_value(df: DataFrame, col: str) -> Column:
    """A numeric ordering value: micros for timestamps, the value for numbers."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(col).cast("timestamp"))
    if isinstance(dtype, T.DateType):
        return F.unix_date(F.col(col)).cast("bigint")
    return F.col(col)


def default_width(df: DataFrame, col: str) -> int:
    dtype = df.schema[col].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return DEFAULT_TIME_WIDTH_S * 1_000_000
    if isinstance(dtype, T.DateType):
        return 7
    return DEFAULT_KEY_WIDTH


def bucket_expr(df: DataFrame, col: str, width: int | None = None) -> Column:
    w = int(width or default_width(df, col))
    return F.floor(order_value(df, col) / F.lit(w)).cast("bigint")


def crowded(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> bool:
    """Whether one bucket holds more than ``limit`` rows: a count per bucket, combined before the shuffle.

    Reads the key columns only. Decides between time buckets (one shuffle) and
    buckets of equal row counts (a sampling pass and a materialisation, but no
    task larger than another however the rows crowd in time).
    """
    most = df.groupBy(*keys).count().agg(F.max("count")).first()[0]
    return (most or 0) > (CROWDED_ROWS if limit is None else limit)


def with_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Add the columns of a one-row result to every row, as a scalar subquery (no join).

    Without a row the columns are NULL.
    """
    one = row.select(F.struct(*row.columns).alias("_gs_row")).scalar()
    return df.select("*", one.alias("_gs_row")).select(*df.columns, *[F.col(f"_gs_row.{c}").alias(c) for c in row.columns])


# ---------------------------------------------------------------------------
# edge scans
# ---------------------------------------------------------------------------

def exclusive_scan(edges: DataFrame, by: Sequence[str], bucket: str, value: str, op: str,
                   out: str, super_size: int = SUPER) -> DataFrame:
    """For each ``(by, bucket)`` row: combine ``value`` over all *earlier* buckets.

    ``op='sum'`` gives an exclusive prefix sum (0 for the first bucket);
    ``op='last'`` gives the value of the latest earlier bucket whose value is
    not NULL. See :func:`exclusive_scans`.
    """
    return exclusive_scans(edges, by, bucket, {out: (value, op)}, super_size)


def exclusive_scans(edges: DataFrame, by: Sequence[str], bucket: str, outs: dict[str, tuple[str, str]], super_size: int = SUPER) -> DataFrame:
    """Several scans in one pass: ``{out: (value, op)}`` with ``op`` ``sum``, ``last``, or ``next`` (the earliest later bucket's value).

    Two levels: inside super-buckets of ``super_size`` buckets, then across
    super-buckets (a table ``super_size`` times smaller).
    """
    by, sup = list(by), "_gs_sup"
    e = edges.withColumn(sup, F.floor(F.col(bucket) / F.lit(super_size)).cast("bigint"))
    before, after = (Window.unboundedPreceding, -1), (1, Window.unboundedFollowing)
    inner, totals, across, res = [], [], [], []
    for i, (out, (value, op)) in enumerate(outs.items()):
        if op not in ("sum", "last", "next"):
            raise ValueError(op)
        frame = after if op == "next" else before
        w_in, w_sup = (Window.partitionBy(*by, *p).orderBy(o).rowsBetween(*frame) for p, o in (([sup], bucket), ([], sup)))
        if op == "sum":
            inner.append(F.sum(value).over(w_in).alias(f"_gs_in{i}"))
            totals.append(F.sum(value).alias(f"_gs_tot{i}"))
            across.append(F.sum(f"_gs_tot{i}").over(w_sup).alias(f"_gs_pre{i}"))
            res.append((F.coalesce(F.col(f"_gs_in{i}"), F.lit(0)) + F.coalesce(F.col(f"_gs_pre{i}"), F.lit(0))).alias(out))
            continue
        pick, end = (F.first, F.min_by) if op == "next" else (F.last, F.max_by)
        there = F.col(value).isNotNull()
        inner.append(pick(value, ignorenulls=True).over(w_in).alias(f"_gs_in{i}"))
        totals.append(end(F.when(there, F.col(value)), F.when(there, F.col(bucket))).alias(f"_gs_tot{i}"))
        across.append(pick(f"_gs_tot{i}", ignorenulls=True).over(w_sup).alias(f"_gs_pre{i}"))
        res.append(F.coalesce(F.col(f"_gs_in{i}"), F.col(f"_gs_pre{i}")).alias(out))
    sums = e.groupBy(*by, sup).agg(*totals).select(*by, sup, *across)
    j = e.select("*", *inner).join(sums, on=[*by, sup], how="left")
    return j.select(*[F.col(c) for c in edges.columns], *res)


# ---------------------------------------------------------------------------
# lag(1) with edge repair
# ---------------------------------------------------------------------------

def with_prev(df: DataFrame, order: str, cols: Sequence[str], by=None, width: int | None = None,
              prefix: str = "prev_", tiebreak: Sequence[str] = (), skew_safe: bool | None = None) -> DataFrame:
    """Add ``prev_<c>`` = value of ``c`` in the previous row by ``(by, order)``.

    Same result as ``lag(c, 1).over(Window.partitionBy(by).orderBy(order))``,
    computed per bucket plus an edge scan. The previous row of the very
    first row is NULL (no default value). Buckets of a time order can be
    crowded by a burst; then (``skew_safe``, by default as measured by
    :func:`crowded`) the rows are split by count instead.
    """
    by = _list(by)
    cols = _list(cols)
    keys = [order, *tiebreak]
    if skew_safe is None:
        # distinct integer keys fill a bucket with at most its width
        timed = isinstance(df.schema[order].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))
        skew_safe = timed and crowded(df.select(*by, bucket_expr(df, order, width).alias(B)), [*by, B])
    if skew_safe:
        d = halo_window(df, keys, lambda w: {prefix + c: F.lag(c, 1).over(w) for c in cols}, preceding=1, by=by, index="range")
        return d.drop(IDX)
    packed_cols = list(dict.fromkeys(keys + cols))
    d, by = keyed(df.withColumn(B, bucket_expr(df, order, width)), by)
    w = Window.partitionBy(*by, B).orderBy(*[F.col(k) for k in keys])
    rowv = F.struct(*[F.col(c) for c in packed_cols])
    d = d.withColumn("_gs_prev", F.lag(rowv, 1).over(w))
    edges = d.groupBy(*by, B).agg(F.max_by(rowv, F.struct(*[F.col(k) for k in keys])).alias("_gs_last"))
    edges = exclusive_scan(edges, by, B, "_gs_last", "last", "_gs_before").select(*by, B, "_gs_before")
    d = d.join(edges, on=[*by, B], how="left")
    prev = F.coalesce(F.col("_gs_prev"), F.col("_gs_before"))
    out = d.select(*df.columns, *[prev[c].alias(prefix + c) for c in cols])
    return out


# ---------------------------------------------------------------------------
# global index and halo windows
# ---------------------------------------------------------------------------

def global_index(df: DataFrame, order: Sequence[str] | str, by=None, width: int | None = None,
                 out: str = IDX) -> DataFrame:
    """Dense 0-based position of each row in ``(by, order)`` order.

    ``order`` must be a total order (add a tie-breaker column), otherwise
    equal rows may swap positions between runs.
    """
    by = _list(by)
    order = _list(order)
    d, by = keyed(df.withColumn(B, bucket_expr(df, order[0], width)), by)
    w = Window.partitionBy(*by, B).orderBy(*order)
    d = d.withColumn("_gs_rn", F.row_number().over(w))
    counts = d.groupBy(*by, B).agg(F.count(F.lit(1)).alias("_gs_cnt"))
    offs = exclusive_scan(counts, by, B, "_gs_cnt", "sum", "_gs_off").select(*by, B, "_gs_off")
    d = d.join(offs, on=[*by, B], how="left")
    return d.withColumn(out, (F.col("_gs_off") + F.col("_gs_rn") - 1).cast("bigint")).drop(B, "_gs_rn", "_gs_off", KEY)


def dense_index(df: DataFrame, order: Sequence[str], by=None, width: int | None = None,
                index: str | None = None) -> DataFrame:
    """Dense position by ``(by, order)``: ``bucket`` (:func:`global_index`, buckets of the
    first order value; no sampling pass) for integer keys such as block numbers, whose
    buckets hold at most ``width`` rows; ``range`` (:func:`range_rank`, sampled range
    partitions) otherwise, so bursts of equal or dense timestamps cannot make one bucket hot.
    """
    if index is None:
        dtype = df.schema[_list(order)[0]].dataType
        index = "bucket" if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType)) else "range"
    if index == "bucket":
        return global_index(df, order, by, width)
    return range_rank(df, order, by)


def _haloed(df: DataFrame, order: list[str], preceding: int, following: int, by: list[str], width: int | None, bucket_rows: int,
            index: str | None) -> DataFrame:
    """Rows with their dense index, bucket ``B`` and ``_gs_halo`` (a copy for the frames of a neighbouring bucket)."""
    size = max(int(bucket_rows), int(preceding), int(following), 1)
    d = dense_index(df, order, by, width, index)
    b = F.floor(F.col(IDX) / F.lit(size)).cast("bigint")
    pos = F.col(IDX) - b * F.lit(size)
    # each row goes to its own bucket; the last `preceding` rows of a bucket
    # are copied into the next one, the first `following` into the previous
    # one (one generator, the input is referenced once)
    copies = [F.struct(b.alias("b"), F.lit(False).alias("h"))]
    if preceding > 0:
        copies.append(F.when(pos >= F.lit(size - preceding), F.struct((b + 1).alias("b"), F.lit(True).alias("h"))))
    if following > 0:
        copies.append(F.when(pos < F.lit(following), F.struct((b - 1).alias("b"), F.lit(True).alias("h"))))
    u = d.select("*", F.explode(F.array_compact(F.array(*copies))).alias("_gs_c"))
    u = u.select(*df.columns, IDX, F.col("_gs_c.b").alias(B), F.col("_gs_c.h").alias("_gs_halo"))
    return keyed(u, by)[0]


def halo_window(df: DataFrame, order: Sequence[str] | str, build: Callable[[Window], dict[str, Column]],
                preceding: int, following: int = 0, by=None, width: int | None = None,
                bucket_rows: int = DEFAULT_BUCKET_ROWS, index: str | None = None) -> DataFrame:
    """Apply window expressions with a frame of at most ``preceding`` rows back
    and ``following`` rows ahead, as if over ``Window.partitionBy(by).orderBy(order)``.

    ``build(w)`` receives the per-bucket window spec (ordered by the dense
    index) and returns ``{name: column}``.
    """
    by = _list(by)
    u = _haloed(df, _list(order), preceding, following, by, width, bucket_rows, index)
    w = Window.partitionBy(*([KEY] if by else []), B).orderBy(IDX)
    exprs = build(w)
    res = u.select(*df.columns, IDX, "_gs_halo", *[c.alias(n) for n, c in exprs.items()])
    return res.filter(~F.col("_gs_halo")).drop("_gs_halo")


ROLLING = ("mean", "std", "sum", "min", "max", "zscore", "median")


def _frame_parts(col: str, n: int, by: list[str], fns: set[str]) -> dict[str, tuple[Column, Column]]:
    """Running aggregates whose combination covers the last ``n`` rows: ``{name: (up to this row, from the frame's start)}``.

    Rows are cut into blocks of ``n`` by their index. A frame is the end of
    one block and the start of the next (or one whole block), so a running
    aggregate forwards and one backwards inside blocks give it in two
    operations a row, whatever ``n``. Nothing is subtracted: no cancellation.
    """
    block = F.floor(F.col(IDX) / F.lit(n))
    ahead = Window.partitionBy(*by, B, block).orderBy(IDX).rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy(*by, B, block).orderBy(F.desc(IDX)).rowsBetween(Window.unboundedPreceding, 0)
    aggs = {"n": F.count(col)}
    if fns & {"mean", "std", "zscore"}:
        aggs["mean"] = F.avg(col)
    if fns & {"std", "zscore"}:
        aggs["var"] = F.var_pop(col)
    for fn, agg in (("sum", F.sum), ("min", F.min), ("max", F.max)):
        if fn in fns:
            aggs[fn] = agg(col)
    return {k: (a.over(ahead), a.over(back)) for k, a in aggs.items()}


def rolling_many(df: DataFrame, order, specs: Sequence[tuple[str, int, str]], by=None, width: int | None = None,
                 bucket_rows: int = DEFAULT_BUCKET_ROWS, min_periods: int | None = None, eps: float = 0.0,
                 index: str | None = None, also: Callable[[Window], dict[str, Column]] | None = None) -> DataFrame:
    """WIN-5..9: several trailing statistics ``(column, rows, function)`` in one pass, as ``<column>_<function>_<rows>``.

    pandas ``rolling(n)`` semantics: NULL until the frame holds
    ``min_periods`` (default ``n``) non-null values; ``std`` is the sample
    form. Sums, means, deviations, minima and maxima cost the same for every
    ``n`` (see :func:`_frame_parts`); the exact ``median`` keeps its window
    in an ordered structure, a logarithmic step a row, over Arrow batches of
    one bucket (at most ``bucket_rows`` plus ``n`` rows). For the median a
    NaN counts as missing. ``also(w)`` adds window expressions over the same
    rows (see :func:`halo_window`; a frame within the longest statistic's).
    """
    by, order = _list(by), _list(order)
    bad = {fn for _, _, fn in specs} - set(ROLLING)
    if bad:
        raise ValueError(f"unknown rolling function {sorted(bad)[0]!r}")
    names = list(dict.fromkeys(f"{col}_{fn}_{n}" for col, n, fn in specs))
    most = max([n for _, n, _ in specs] + [2 if also else 1])
    u = _haloed(df, order, most - 1, 0, by, width, bucket_rows, index)
    by = [KEY] if by else []
    frames: dict[tuple[str, int], set[str]] = {}
    for col, n, fn in specs:
        frames.setdefault((col, n), set()).add(fn)
    medians = list(dict.fromkeys((col, n) for col, n, fn in specs if fn == "median"))
    if medians:
        u = _with_medians(u, medians, by, min_periods)
    w = Window.partitionBy(*by, B).orderBy(IDX)
    step1, step2, out = {}, dict(also(w)) if also else {}, {}
    more = list(step2)
    for k, ((col, n), fns) in enumerate(frames.items()):
        if fns == {"median"}:
            continue
        for part, (a, b) in _frame_parts(col, n, by, fns).items():
            step1[f"_a{k}_{part}"], step1[f"_b{k}_{part}"] = a, b
            # the frame starts n - 1 rows back; when that is this row's own block the forward part is the whole frame
            step2[f"_c{k}_{part}"] = F.when(F.pmod(F.col(IDX), F.lit(n)) != n - 1, F.lag(f"_b{k}_{part}", n - 1).over(w))
    u = u.select("*", *[c.alias(x) for x, c in step1.items()])
    u = u.select("*", *[c.alias(x) for x, c in step2.items()])
    zero = F.lit(0).cast("bigint")
    for k, ((col, n), fns) in enumerate(frames.items()):
        need = n if min_periods is None else min_periods
        for fn in fns - {"median"}:
            n1, n2 = F.col(f"_a{k}_n"), F.coalesce(f"_c{k}_n", zero)
            both = n1 + n2
            if fn in ("sum", "min", "max"):
                a, b = F.col(f"_a{k}_{fn}"), F.col(f"_c{k}_{fn}")
                e = F.coalesce(a + b, a, b) if fn == "sum" else F.least(a, b) if fn == "min" else F.greatest(a, b)
            else:
                m1, m2 = F.coalesce(f"_a{k}_mean", F.lit(0.0)), F.coalesce(f"_c{k}_mean", F.lit(0.0))
                mean = F.when(both > 0, (m1 * n1 + m2 * n2) / both)
                if fn == "mean":
                    e = mean
                else:
                    v1, v2 = F.coalesce(f"_a{k}_var", F.lit(0.0)), F.coalesce(f"_c{k}_var", F.lit(0.0))
                    squares = v1 * n1 + v2 * n2 + F.when((n1 > 0) & (n2 > 0), (m1 - m2) * (m1 - m2) * n1 * n2 / both).otherwise(0.0)
                    std = F.when(both > 1, F.sqrt(squares / (both - 1)))
                    e = std if fn == "std" else F.try_divide(F.col(col) - mean, std + F.lit(eps))
            out[f"{col}_{fn}_{n}"] = F.when(both >= F.lit(need), e)
    res = u.filter(~F.col("_gs_halo"))
    return res.select(*df.columns, IDX, *more, *[(out[x] if x in out else F.col(x)).alias(x) for x in names])


def _with_medians(u: DataFrame, wanted: list[tuple[str, int]], by: list[str], min_periods: int | None) -> DataFrame:
    """Exact rolling medians of each bucket's rows (the halo gives the frames of its first rows)."""
    fields = [T.StructField(f"{col}_median_{n}", T.DoubleType()) for col, n in wanted]
    values = {col: f"_gs_v{i}" for i, col in enumerate(dict.fromkeys(c for c, _ in wanted))}
    u = u.select("*", *[F.col(c).cast("double").alias(v) for c, v in values.items()])
    schema = T.StructType([f for f in u.schema.fields if f.name not in values.values()] + fields)
    kept = [f.name for f in u.schema.fields if f.name not in values.values()]

    def medians(table):
        import pandas as pd
        import pyarrow as pa
        import pyarrow.compute as pc
        table = table.take(pc.sort_indices(table.column(IDX)))
        series = {c: pd.Series(table.column(v).to_numpy()) for c, v in values.items()}
        out = table.select(kept)
        for (col, n), f in zip(wanted, fields):
            m = series[col].rolling(n, min_periods=n if min_periods is None else min_periods).median()
            out = out.append_column(f.name, pa.array(m, pa.float64(), from_pandas=True))
        return out
    return u.groupBy(*by, B).applyInArrow(medians, schema)


def rolling(df: DataFrame, order, col: str, n: int, fns: Sequence[str] = ("mean",), by=None,
            width: int | None = None, bucket_rows: int = DEFAULT_BUCKET_ROWS, min_periods: int | None = None,
            eps: float = 0.0, keep_index: bool = False) -> DataFrame:
    """WIN-5..9: rolling mean / std / median / sum / min / max / zscore of one column over ``n`` rows."""
    out = rolling_many(df, order, [(col, n, fn) for fn in fns], by, width, bucket_rows, min_periods, eps)
    return out if keep_index else out.drop(IDX)


def shifted(df: DataFrame, order, cols: Sequence[str], k: int, by=None, width: int | None = None,
            bucket_rows: int = DEFAULT_BUCKET_ROWS, name: str = "{c}_shift_{k}") -> DataFrame:
    """WIN-2: pandas ``shift(k)``: ``k > 0`` looks back (lag), ``k < 0`` ahead (lead)."""
    cols = _list(cols)

    def build(w):
        return {name.format(c=c, k=k): (F.lag(c, k).over(w) if k > 0 else F.lead(c, -k).over(w)) for c in cols}
    out = halo_window(df, order, build, preceding=max(k, 0), following=max(-k, 0), by=by, width=width,
                      bucket_rows=bucket_rows)
    return out.drop(IDX)


# ---------------------------------------------------------------------------
# exact ranks / quantiles without collecting a group
# ---------------------------------------------------------------------------

def range_rank(df: DataFrame, order: Sequence[str] | str, by=None, partitions: int | None = None,
               out: str = IDX) -> DataFrame:
    """Dense 0-based rank of each row in ``(by, order)`` order, for any orderable type.

    ``repartitionByRange`` splits the order into balanced, contiguous ranges
    (sampled boundaries); inside each partition the position comes from
    ``monotonically_increasing_id`` after a local sort (partition id in the
    high bits, position in the low 33 bits); per (partition, group) counts
    are prefix-summed over the partitions of each group. The ranked rows are
    checkpointed once (range bounds are sampled anew by every execution, so
    the counts must come from the same materialised partitions). No group is
    held in one task. Equal order values may swap ranks between runs.
    """
    by = _list(by)
    order = _list(order)
    spark = df.sparkSession
    n = int(partitions or int(spark.conf.get("spark.sql.shuffle.partitions")))
    df, by = keyed(df, by)
    d = (df.repartitionByRange(n, *by, *order).sortWithinPartitions(*by, *order)
         .withColumn("_gs_mid", F.monotonically_increasing_id()))
    d = d.withColumn("_gs_pid", F.shiftright("_gs_mid", 33)).withColumn(
        "_gs_pos", F.col("_gs_mid").bitwiseAND(F.lit((1 << 33) - 1)))
    # range bounds are sampled per execution: materialise once (reliable
    # checkpoint in the shared folder) so counts and rows see the same ranges
    from gapseries.session import cut_lineage
    d = cut_lineage(d)
    edges = d.groupBy("_gs_pid", *by).agg(F.count(F.lit(1)).alias("_gs_cnt"), F.min("_gs_pos").alias("_gs_first"))
    scan = exclusive_scan(edges, by, "_gs_pid", "_gs_cnt", "sum", "_gs_off")
    d = d.join(scan.select("_gs_pid", *by, "_gs_off", "_gs_first"), on=["_gs_pid", *by], how="left")
    return d.withColumn(out, (F.col("_gs_off") + F.col("_gs_pos") - F.col("_gs_first")).cast("bigint")).drop(
        "_gs_mid", "_gs_pid", "_gs_pos", "_gs_off", "_gs_first", KEY)


def ranked(df: DataFrame, order: Sequence[Column], out: str = "rank") -> DataFrame:
    """TOP-3: rows in the given order, with their 1-based position (no single-task window).

    ``order`` must be a total order for a repeatable result.
    """
    names = [f"_gs_o{i}" for i in range(len(order))]
    # the direction goes into the range partitioning, so any mix of asc / desc works
    keyed = df.select("*", *[c.alias(n) for c, n in zip(order, names)])
    return range_rank(keyed, names).withColumn(out, F.col(IDX) + 1).drop(IDX, *names).orderBy(out)


def exact_quantile(df: DataFrame, col: str, q: float = 0.5, by=None, out: str | None = None,
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """Exact quantile with linear interpolation (same as ``percentile(x, q)``), one row per group.

    Ranks come from :func:`range_rank`; only the (at most two) rows at the
    interpolation ranks reach the final aggregate, so the result never
    depends on holding a group's values in one task. Pass a unique column
    as ``tiebreak`` (e.g. the table key) so that a value repeated in a third
    of the rows is still split over several range partitions.
    """
    by = _list(by)
    tiebreak = _list(tiebreak)
    out = out or f"{col}_q{int(round(q * 100))}"
    x = df.select(*by, *tiebreak, F.col(col).cast("double").alias("_q_x")).filter(F.col("_q_x").isNotNull())
    ranked, keys = keyed(range_rank(x, ["_q_x", *tiebreak], by), by)
    n = keyed(x, by)[0].groupBy(*keys).agg(F.count(F.lit(1)).alias("_q_n"))
    pos = (F.col("_q_n") - 1) * F.lit(float(q))
    n = n.select(*keys, "_q_n", F.floor(pos).cast("bigint").alias("_q_lo"), F.ceil(pos).cast("bigint").alias("_q_hi"),
                 (pos - F.floor(pos)).alias("_q_frac"))
    if by:
        j = ranked.join(n, on=keys, how="inner")
    else:
        j = with_row(ranked, n)
    pick = j.filter((F.col(IDX) == F.col("_q_lo")) | (F.col(IDX) == F.col("_q_hi")))
    g = pick.groupBy(*by).agg(F.max(F.when(F.col(IDX) == F.col("_q_lo"), F.col("_q_x"))).alias("_lo_x"),
                              F.max(F.when(F.col(IDX) == F.col("_q_hi"), F.col("_q_x"))).alias("_hi_x"),
                              F.first("_q_frac").alias("_f"))
    return g.select(*by, (F.col("_lo_x") + F.col("_f") * (F.col("_hi_x") - F.col("_lo_x"))).alias(out))
