"""Gap, staleness and duplicate monitoring (GAP-*, AGG-1..5, JN-5..7, SET-2/3, TOP-2).

Everything is a DataFrame transformation; "now" is always the explicit
``as_of`` argument, never ``current_timestamp()``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapseries.operators.ordered import B, KEY, exclusive_scan, keyed, with_prev, with_row

GAP_COLS = ["gap_start", "gap_end", "gap_size"]


def _list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def _ts(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, str):
        return F.lit(v).cast("timestamp")
    return F.lit(v)


# ---------------------------------------------------------------------------
# GAP-1 sequence gaps
# ---------------------------------------------------------------------------

BITS = 1 << 15                       # keys of one bitmap (4 KiB)


def key_bitmaps(df: DataFrame, key: str = "number", by=None, width: int | None = None) -> DataFrame:
    """One row per non-empty bucket of at most 32,768 keys: ``(series key, bucket, bitmap)``.

    The bitmaps are built map-side: a task sends one bitmap per bucket it
    saw, whatever the number of rows or copies of a key. Keys that are few
    and far apart (hashes, not sequence numbers) gain nothing from it.
    """
    size = min(int(width or BITS), BITS)
    d, by = keyed(df.select(*_list(by), key).filter(F.col(key).isNotNull()), by)
    # integer arithmetic: a quotient of doubles would lose digits beyond 2^53
    k = F.col(key).cast("bigint")
    at = F.pmod(k, F.lit(size).cast("bigint"))
    b = F.call_function("div", k - at, F.lit(size).cast("bigint"))
    return d.groupBy(*by, b.alias(B)).agg(F.bitmap_construct_agg(at).alias("bitmap"))


def _bitmap_runs(bitmaps: DataFrame, by: list[str], size: int) -> DataFrame:
    """``(series key, bucket, edge)``: first and last key of a bucket and the missing ranges between them."""
    edge = T.StructType([T.StructField("lo", T.LongType()), T.StructField("hi", T.LongType()),
                         T.StructField("starts", T.ArrayType(T.LongType())), T.StructField("ends", T.ArrayType(T.LongType()))])
    schema = T.StructType([*[f for f in bitmaps.schema.fields if f.name != "bitmap"], T.StructField("_e", edge)])

    def runs(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        target = to_arrow_schema(schema)
        for batch in batches:
            out = []
            for b, bits in zip(batch.column(B).to_pylist(), batch.column("bitmap")):
                at = np.flatnonzero(np.unpackbits(np.frombuffer(bits.as_buffer(), np.uint8), bitorder="little"))
                step = np.flatnonzero(np.diff(at) > 1)
                base = b * size
                out.append({"lo": base + int(at[0]), "hi": base + int(at[-1]), "starts": (base + at[step] + 1).tolist(),
                            "ends": (base + at[step + 1] - 1).tolist()})
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in [*by, B]], pa.array(out, target.field("_e").type)], schema=target)
    return bitmaps.select(*by, B, "bitmap").mapInArrow(runs, schema)


def detect_gaps(df: DataFrame, key: str = "number", by=None, width: int | None = None,
                expected_start: int | None = None) -> DataFrame:
    """Missing ranges in an integer key: ``(gap_start, gap_end, gap_size)``.

    The keys of a bucket (``key div width``, at most 32,768) become a bitmap
    (:func:`key_bitmaps`), so the rows are read once and only bitmaps are
    shuffled. Ranges missing inside a bucket are the zero runs of its bitmap;
    the step between buckets comes from an edge table of their first and last
    keys. No head gap unless ``expected_start`` is given. Duplicate and NULL
    keys are harmless; rows without a series key form a series of their own.
    """
    names = _list(by)
    size = min(int(width or BITS), BITS)
    edges = _bitmap_runs(key_bitmaps(df, key, names, width), [KEY] if names else [], size)
    # one struct per bucket: both levels of the scan need all of it, so they share one exchange
    scan = exclusive_scan(edges, [KEY] if names else [], B, "_e", "last", "_before")
    lo, before = F.col("_e.lo"), F.col("_before.hi")
    cross = F.when(lo - before > 1, F.array(F.struct((before + 1).alias("gap_start"), (lo - 1).alias("gap_end"))))
    if expected_start is not None:
        head = F.array(F.struct(F.lit(expected_start).cast("bigint").alias("gap_start"), (lo - 1).alias("gap_end")))
        cross = F.when(before.isNull() & (lo > F.lit(expected_start)), head).otherwise(cross)
    none = F.array().cast("array<struct<gap_start:bigint,gap_end:bigint>>")
    inner = F.transform(F.arrays_zip(F.col("_e.starts").alias("gap_start"), F.col("_e.ends").alias("gap_end")),
                        lambda x: F.struct(x["gap_start"].alias("gap_start"), x["gap_end"].alias("gap_end")))
    every = scan.select(*[F.col(f"{KEY}.{c}").alias(c) for c in names], F.explode(F.concat(F.coalesce(cross, none), inner)).alias("_g"))
    return every.select(*names, "_g.gap_start", "_g.gap_end",
                        (F.col("_g.gap_end") - F.col("_g.gap_start") + 1).cast("bigint").alias("gap_size"))


def distinct_keys(df: DataFrame, key: str = "number", by=None, width: int | None = None) -> DataFrame:
    """Exact number of distinct keys, their least and largest (per series): bits set in the bitmaps, duplicates free."""
    names, size = _list(by), min(int(width or BITS), BITS)
    runs = _bitmap_runs(key_bitmaps(df, key, names, width), [KEY] if names else [], size)
    held = F.aggregate(F.arrays_zip(F.col("_e.starts").alias("s"), F.col("_e.ends").alias("e")),
                       F.col("_e.hi") - F.col("_e.lo") + 1, lambda n, x: n - (x["e"] - x["s"] + 1))
    g = runs.groupBy(*([KEY] if names else [])).agg(F.coalesce(F.sum(held), F.lit(0)).cast("bigint").alias("keys"),
                                                    F.min("_e.lo").alias("min_key"), F.max("_e.hi").alias("max_key"))
    return g.select(*[F.col(f"{KEY}.{c}").alias(c) for c in names], "keys", "min_key", "max_key")


def largest_gaps(gaps: DataFrame, k: int = 20) -> DataFrame:
    """TOP-2: the ``k`` largest gaps (ties by lower start). Display only."""
    return gaps.orderBy(F.col("gap_size").desc(), F.col("gap_start").asc()).limit(k)


def split_gaps(gaps: DataFrame, inline_max: int = 5) -> DataFrame:
    """GAP-6: small gaps are filled inline, larger ones deferred."""
    return gaps.withColumn("handling", F.when(F.col("gap_size") <= inline_max, "inline").otherwise("deferred"))


def expand_gaps(gaps: DataFrame, out: str = "number", chunk: int = 1 << 16, by=None) -> DataFrame:
    """GAP-3: one row per missing key strictly inside each gap.

    A huge gap is first cut into chunks of ``chunk`` keys and the chunks are
    spread over tasks before the keys are generated, so no single task
    expands a giant gap alone.
    """
    by = _list(by)
    c = gaps.select(*by, "gap_start", "gap_end",
                    F.explode(F.sequence(F.lit(0).cast("bigint"),
                                         F.floor((F.col("gap_end") - F.col("gap_start")) / F.lit(chunk))
                                         .cast("bigint"))).alias("_c"))
    c = c.select(*by, (F.col("gap_start") + F.col("_c") * F.lit(chunk)).alias("_lo"), "gap_end")
    c = c.select(*by, "_lo", F.least(F.col("gap_end"), F.col("_lo") + F.lit(chunk - 1)).alias("_hi"))
    c = c.repartition(F.col("_lo"))
    return c.select(*by, F.explode(F.sequence(F.col("_lo"), F.col("_hi"))).alias(out))


def missing_keys(df: DataFrame, key: str = "number", by=None, width: int | None = None) -> DataFrame:
    """JN-6: keys missing between the first and last present key."""
    return expand_gaps(detect_gaps(df, key, by, width), out=key, by=by)


def fill_from(missing: DataFrame, source: DataFrame, key: str = "number") -> DataFrame:
    """JN-7: rows of a second source for the missing keys (left semi join)."""
    return source.join(missing.select(key), on=key, how="left_semi")


def backfill_stats(missing: DataFrame, filled: DataFrame, key: str = "number") -> DataFrame:
    """GAP-9: total / success / failed of a backfill."""
    f = filled.select(key).distinct().withColumn("_ok", F.lit(1))
    j = missing.select(key).join(f, on=key, how="left")
    return j.agg(
        F.count(F.lit(1)).alias("total"),
        F.count("_ok").alias("success"),
        (F.count(F.lit(1)) - F.count("_ok")).alias("failed"),
    )


# ---------------------------------------------------------------------------
# GAP-2 / WIN-16 time gaps
# ---------------------------------------------------------------------------

def detect_time_gaps(df: DataFrame, ts: str = "timestamp", interval_s: float = 60, threshold: float = 1.5,
                     by=None, width: int | None = None, tiebreak: Sequence[str] = (),
                     skew_safe: bool | None = None) -> DataFrame:
    """Steps longer than ``interval_s * threshold`` between consecutive rows.

    ``missing = floor(delta / interval) - 1`` intervals lie inside the gap.
    The series is split into time buckets of ``width`` or, if a burst puts too
    many rows into one of them (measured, or said by ``skew_safe``), into
    sampled ranges of equal row counts.
    """
    by = _list(by)
    d = with_prev(df.select(*by, ts, *tiebreak), ts, [ts], by=by, width=width, tiebreak=tiebreak, prefix="_p_",
                  skew_safe=skew_safe)
    delta = (F.unix_micros(F.col(ts)) - F.unix_micros(F.col("_p_" + ts))) / F.lit(1e6)
    d = d.withColumn("duration_s", delta)
    return d.filter(F.col("duration_s") > F.lit(interval_s * threshold)).select(
        *by, F.col("_p_" + ts).alias("gap_start"), F.col(ts).alias("gap_end"), "duration_s",
        (F.floor(F.col("duration_s") / F.lit(float(interval_s))) - 1).cast("bigint").alias("missing_intervals"))


def spread_range(df: DataFrame, count: Column, out: str = "k", chunk: int = 1 << 16) -> DataFrame:
    """One row per ``k`` in ``0 .. count-1`` for every input row, generated in chunks.

    Chunks of ``chunk`` values are spread over tasks (round-robin
    repartition of the small chunk rows) before the values are generated,
    so one huge range is not produced by a single task.
    """
    c = df.withColumn("_sr_n", count.cast("bigint")).filter(F.col("_sr_n") > 0)
    c = c.withColumn("_sr_c", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                  F.floor((F.col("_sr_n") - 1) / F.lit(chunk)).cast("bigint"))))
    c = c.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))   # round-robin
    lo = F.col("_sr_c") * F.lit(chunk)
    hi = F.least(F.col("_sr_n") - 1, lo + F.lit(chunk - 1))
    return c.withColumn(out, F.explode(F.sequence(lo, hi))).drop("_sr_n", "_sr_c")


def expand_time_gaps(gaps: DataFrame, interval_s: int, out: str = "ts", by=None, chunk: int = 1 << 16) -> DataFrame:
    """GAP-3 for time gaps: ``start + k*interval`` for every ``k >= 1`` strictly before ``end``."""
    by = _list(by)
    step = int(interval_s) * 1_000_000
    span = F.unix_micros(F.col("gap_end")) - F.unix_micros(F.col("gap_start"))
    k_max = F.floor((span - F.lit(1)) / F.lit(step))          # largest k with start + k*step < end
    g = gaps.select(*by, "gap_start", k_max.alias("_kmax"))
    r = spread_range(g, F.col("_kmax"), "_k", chunk)
    return r.select(*by, "gap_start",
                    F.timestamp_micros(F.unix_micros(F.col("gap_start")) + (F.col("_k") + 1) * F.lit(step)).alias(out))


# ---------------------------------------------------------------------------
# AGG-1..5 statistics, completeness, freshness, health, duplicates
# ---------------------------------------------------------------------------

def table_stats(df: DataFrame, key: str = "number", ts: str = "timestamp") -> DataFrame:
    """AGG-1: count, min/max key, latest timestamp (one row)."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.min(key).alias("min_key"),
                  F.max(key).alias("max_key"), F.max(ts).alias("latest_ts"))


def completeness(df: DataFrame, key: str = "number") -> DataFrame:
    """AGG-2: expected = max - min + 1 (0 when empty), missing = expected - count."""
    s = df.agg(F.count(F.lit(1)).alias("total_rows"), F.min(key).alias("min_key"), F.max(key).alias("max_key"))
    exp = F.coalesce(F.col("max_key") - F.col("min_key") + 1, F.lit(0)).cast("bigint")
    return s.withColumn("expected", exp).withColumn("missing", F.col("expected") - F.col("total_rows"))


def freshness(df: DataFrame, ts: str = "timestamp", as_of=None, threshold_s: int = 960,
              bands: tuple[int, int] = (60, 300), key: str | None = "number") -> DataFrame:
    """AGG-3: age of the newest row at ``as_of``; raises on an empty table."""
    if as_of is None:
        raise ValueError("as_of is required (no wall clock inside operators)")
    aggs = [F.count(F.lit(1)).alias("_n"), F.max(ts).alias("latest_ts")]
    if key:
        aggs.append(F.max(key).alias("latest_key"))
    s = df.agg(*aggs)
    age = (F.unix_micros(_ts(as_of)) - F.unix_micros(F.col("latest_ts"))) / F.lit(1e6)
    s = s.withColumn("age_s", F.when(F.col("_n") > 0, F.floor(age).cast("bigint"))
                     .otherwise(F.raise_error(F.lit("no rows: freshness of an empty table")).cast("bigint")))
    s = s.withColumn("is_fresh", F.col("age_s") <= F.lit(threshold_s))
    s = s.withColumn("band", F.when(F.col("age_s") < bands[0], "GOOD").when(F.col("age_s") < bands[1], "OK")
                     .otherwise("STALE"))
    s = s.withColumn("staleness_pct", F.floor(F.col("age_s") * 100 / F.lit(threshold_s)).cast("bigint"))
    s = s.withColumn("margin_s", F.lit(threshold_s) - F.col("age_s"))
    return s.drop("_n")


def duplicates(df: DataFrame, key: str | Sequence[str] = "number") -> DataFrame:
    """AGG-5: keys present more than once, with their count."""
    keys = _list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def gap_summary(gaps: DataFrame) -> DataFrame:
    return gaps.agg(F.count(F.lit(1)).alias("gap_regions"),
                    F.coalesce(F.max("gap_size"), F.lit(0)).cast("bigint").alias("largest_gap"),
                    F.coalesce(F.sum("gap_size"), F.lit(0)).cast("bigint").alias("missing_in_gaps"))


def gap_report(df: DataFrame, key: str = "number", ts: str = "timestamp", width: int | None = None) -> DataFrame:
    """Flagship: AGG-1 + AGG-2 + GAP-1 summarised in one row.

    One aggregate pass gives count / min / max / latest time; the gap scan is
    the second pass; the two one-row results are put side by side.
    """
    stats = df.agg(F.count(F.lit(1)).alias("total_rows"), F.min(key).alias("min_key"),
                   F.max(key).alias("max_key"), F.max(ts).alias("latest_ts"))
    exp = F.coalesce(F.col("max_key") - F.col("min_key") + 1, F.lit(0)).cast("bigint")
    stats = stats.select("total_rows", "min_key", "max_key", exp.alias("expected"),
                         (exp - F.col("total_rows")).alias("missing"), "latest_ts")
    return with_row(stats, gap_summary(detect_gaps(df, key, width=width)))


def health(df: DataFrame, gap_events: DataFrame | None, as_of, key: str = "number", ts: str = "timestamp",
           threshold_s: int = 960, pass_age_s: int = 300, grace_s: int = 1800) -> DataFrame:
    """AGG-4: one health row.

    ``verification_passed``: no missing keys and age < ``pass_age_s``.
    ``healthy``: fresh and no open gap older than the grace period (counted
    from the whole tracked state, not only this run's alerts).
    """
    c = completeness(df, key)
    f = freshness(df, ts, as_of, threshold_s, key=key).select("latest_ts", "latest_key", "age_s", "is_fresh",
                                                             "band", "staleness_pct", "margin_s")
    row = with_row(c, f)
    if gap_events is not None:
        ev = gap_events.agg(
            F.count(F.when(F.col("status") == "NEW", 1)).alias("new_gaps"),
            F.count(F.when(F.col("status").isin("PERSISTENT", "NOTIFIED"), 1)).alias("persistent_gaps"),
            F.count(F.when(F.col("status") == "RESOLVED", 1)).alias("resolved_gaps"),
            F.count(F.when(F.col("status").isin("NEW", "GRACE", "PERSISTENT", "NOTIFIED")
                           & (F.col("age_s") > F.lit(grace_s)), 1)).alias("open_over_grace"),
        )
        row = with_row(row, ev)
        healthy = F.col("is_fresh") & (F.col("open_over_grace") == 0)
    else:
        healthy = F.col("is_fresh") & (F.col("missing") == 0)
    return (row.withColumn("verification_passed", (F.col("missing") == 0) & (F.col("age_s") < pass_age_s))
            .withColumn("healthy", healthy))


# ---------------------------------------------------------------------------
# GAP-4 / JN-5 lifecycle
# ---------------------------------------------------------------------------

def update_gap_state(gaps: DataFrame, state: DataFrame, as_of, grace_s: int = 1800,
                     expire_h: float | None = None) -> tuple[DataFrame, DataFrame]:
    """Reconcile current gaps with the tracked state.

    Returns ``(new_state, events)``. Keys are ``(gap_start, gap_end)``.
    Status per gap: ``NEW`` (not tracked), ``GRACE`` (tracked, age <= grace),
    ``PERSISTENT`` (age > grace, alert now, becomes notified), ``NOTIFIED``
    (already alerted; ``notified`` stays true), ``RESOLVED`` (tracked but no
    longer present, leaves the state), ``EXPIRED`` (tracked entry not seen
    for ``expire_h`` hours, dropped before reconciling).
    """
    now = _ts(as_of)
    st = state
    expired = None
    if expire_h is not None:
        cutoff = now - F.expr(f"INTERVAL {int(expire_h * 3600)} SECONDS")
        expired = st.filter(F.col("last_seen") < cutoff)
        st = st.filter(F.col("last_seen") >= cutoff)
    cur = gaps.select("gap_start", "gap_end", F.col("gap_size").alias("_cur_size"), F.lit(True).alias("_cur"))
    j = cur.join(st.withColumn("_trk", F.lit(True)), on=["gap_start", "gap_end"], how="full")
    age = F.floor((F.unix_micros(now) - F.unix_micros(F.col("first_seen"))) / F.lit(1e6)).cast("bigint")
    status = (F.when(F.col("_trk").isNull(), "NEW")
              .when(F.col("_cur").isNull(), "RESOLVED")
              .when(F.col("notified"), "NOTIFIED")
              .when(age > F.lit(grace_s), "PERSISTENT")
              .otherwise("GRACE"))
    j = j.withColumn("status", status)
    ev = j.select(
        "gap_start", "gap_end",
        F.coalesce(F.col("_cur_size"), F.col("gap_size")).cast("bigint").alias("gap_size"),
        F.coalesce(F.col("first_seen"), now).alias("first_seen"),
        F.when(F.col("_trk").isNull(), F.lit(0).cast("bigint")).otherwise(age).alias("age_s"),
        "status",
    )
    if expired is not None:
        ev = ev.unionByName(expired.select("gap_start", "gap_end", "gap_size", "first_seen",
                                           F.floor((F.unix_micros(now) - F.unix_micros(F.col("first_seen")))
                                                   / F.lit(1e6)).cast("bigint").alias("age_s"),
                                           F.lit("EXPIRED").alias("status")))
    new_state = j.filter(F.col("status") != "RESOLVED").select(
        "gap_start", "gap_end",
        F.coalesce(F.col("_cur_size"), F.col("gap_size")).cast("bigint").alias("gap_size"),
        F.coalesce(F.col("first_seen"), now).alias("first_seen"),
        now.alias("last_seen"),
        (F.coalesce(F.col("notified"), F.lit(False)) | (F.col("status") == "PERSISTENT")).alias("notified"),
    )
    return new_state, ev


def resolved(state: DataFrame, gaps: DataFrame) -> DataFrame:
    """SET-2: tracked gaps that are no longer present."""
    return state.join(gaps.select("gap_start", "gap_end"), ["gap_start", "gap_end"], "left_anti")


def new_gaps(gaps: DataFrame, state: DataFrame) -> DataFrame:
    """SET-3: current gaps not yet tracked."""
    return gaps.join(state.select("gap_start", "gap_end"), ["gap_start", "gap_end"], "left_anti")


def alerts(events: DataFrame, health_row: DataFrame, grace_s: int = 1800, threshold_s: int = 960) -> DataFrame:
    """GAP-5: alert rows (title, priority, message); delivery is not built.

    PERSISTENT (priority 2) and RESOLVED (0) per gap, STALE (2) when the
    newest row is too old, one HEALTHY (0) row when nothing else fired.
    """
    gap_alerts = events.filter(F.col("status").isin("PERSISTENT", "RESOLVED")).select(
        F.when(F.col("status") == "PERSISTENT", "PERSISTENT GAP").otherwise("GAP RESOLVED").alias("title"),
        F.when(F.col("status") == "PERSISTENT", 2).otherwise(0).alias("priority"),
        F.format_string("blocks %d to %d, size %d, first seen %s, age %d min", F.col("gap_start"),
                        F.col("gap_end"), F.col("gap_size"), F.col("first_seen").cast("string"),
                        F.floor(F.col("age_s") / 60).cast("bigint")).alias("message"),
    )
    h = health_row
    stale = h.filter(~F.col("is_fresh")).select(
        F.lit("DATA STALE").alias("title"), F.lit(2).alias("priority"),
        F.format_string("latest %d, age %ds, threshold %ds", F.col("latest_key"), F.col("age_s"),
                        F.lit(threshold_s)).alias("message"))
    fired = gap_alerts.unionByName(stale)
    n_fired = fired.agg(F.count(F.lit(1)).alias("_fired"))
    ok = with_row(h, n_fired).filter(F.col("healthy") & (F.col("_fired") == 0)).select(
        F.lit("HEALTHY").alias("title"), F.lit(0).alias("priority"),
        F.format_string("rows %d, range %d to %d, age %ds (%d%%), margin %ds", F.col("total_rows"),
                        F.col("min_key"), F.col("max_key"), F.col("age_s"), F.col("staleness_pct"),
                        F.col("margin_s")).alias("message"))
    return fired.unionByName(ok)
