"""Bucketed kernels equal the single-task window (small buckets force many borders)."""

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gapseries.operators import asof, gaps, ordered, windows
from gapseries.sources import driver

from conftest import SF01


@pytest.fixture(scope="module")
def blocks(spark):
    b = driver.blocks(spark, SF01).select("number", "timestamp", "gas_used", "transaction_count")
    return b.cache()


def _rows(df, key="number"):
    return sorted(tuple(r) for r in df.orderBy(key).collect())


def test_with_prev_equals_lag(blocks):
    got = ordered.with_prev(blocks, "number", ["number", "gas_used"], width=64)
    w = Window.orderBy("number")
    exp = blocks.select("*", F.lag("number").over(w).alias("prev_number"),
                        F.lag("gas_used").over(w).alias("prev_gas_used"))
    assert _rows(got) == _rows(exp)


def test_with_prev_keyed(blocks):
    b = blocks.withColumn("k", F.col("transaction_count") % 7)
    got = ordered.with_prev(b, "number", ["number"], by="k", width=50)
    exp = b.select("*", F.lag("number").over(Window.partitionBy("k").orderBy("number")).alias("prev_number"))
    assert _rows(got) == _rows(exp)


def test_global_index_dense(blocks):
    idx = ordered.global_index(blocks, ["number"], width=100)
    exp = blocks.select("*", (F.row_number().over(Window.orderBy("number")) - 1).cast("bigint").alias(ordered.IDX))
    assert _rows(idx) == _rows(exp)


@pytest.mark.parametrize("n,bucket_rows", [(5, 7), (60, 64), (60, 500)])
def test_rolling_equals_single_window(blocks, n, bucket_rows):
    got = ordered.rolling(blocks, ["number"], "gas_used", n, ["mean", "sum", "std", "median"],
                          bucket_rows=bucket_rows, width=256)
    f = Window.orderBy("number").rowsBetween(-(n - 1), 0)
    ok = F.count("gas_used").over(f) >= n
    exp = blocks.select("*", F.when(ok, F.avg("gas_used").over(f)).alias(f"gas_used_mean_{n}"),
                        F.when(ok, F.sum("gas_used").over(f)).alias(f"gas_used_sum_{n}"),
                        F.when(ok, F.stddev_samp("gas_used").over(f)).alias(f"gas_used_std_{n}"),
                        F.when(ok, F.percentile("gas_used", F.lit(0.5)).over(f)).alias(f"gas_used_median_{n}"))
    a = got.toPandas().sort_values("number").reset_index(drop=True)
    b = exp.toPandas().sort_values("number").reset_index(drop=True)
    pd.testing.assert_frame_equal(a[b.columns], b, check_exact=False, rtol=1e-9)


def test_shift_lead_and_lag(blocks):
    got = ordered.halo_window(blocks, ["number"], lambda w: {"ahead": F.lead("gas_used", 5).over(w),
                                                            "back": F.lag("gas_used", 3).over(w)},
                              preceding=3, following=5, bucket_rows=16, width=64).drop(ordered.IDX)
    w = Window.orderBy("number")
    exp = blocks.select("*", F.lead("gas_used", 5).over(w).alias("ahead"), F.lag("gas_used", 3).over(w).alias("back"))
    assert _rows(got) == _rows(exp)


def test_gap_sizes_sum_to_missing(blocks):
    g = gaps.detect_gaps(blocks, "number", width=100)
    single = blocks.select("number", F.lag("number").over(Window.orderBy("number")).alias("p")).filter(
        F.col("number") - F.col("p") > 1).select((F.col("p") + 1).alias("gap_start"),
                                                 (F.col("number") - 1).alias("gap_end"))
    assert sorted((r[0], r[1]) for r in g.select("gap_start", "gap_end").collect()) == \
        sorted(tuple(r) for r in single.collect())
    c = gaps.completeness(blocks).first()
    total = g.agg(F.sum("gap_size")).first()[0]
    assert total == c["missing"]


def test_asof_never_looks_ahead_and_matches_pandas(spark):
    left = driver.purchases(spark, SF01)
    right = driver.views(spark, SF01)
    got = asof.asof_join(left, right, "ts", by="user_id", width_s=3600, r_order=["view_id"]).toPandas()
    assert (got["ts_right"].isna() | (got["ts_right"] <= got["ts"])).all()
    lp = left.toPandas().sort_values("ts")
    rp = right.toPandas().sort_values("ts").rename(columns={"ts": "ts_right"})
    exp = pd.merge_asof(lp, rp, left_on="ts", right_on="ts_right", by="user_id", direction="backward")
    a = got.sort_values("event_id").reset_index(drop=True)
    b = exp.sort_values("event_id").reset_index(drop=True)
    assert a["view_id"].fillna(-1).astype("int64").tolist() == b["view_id"].fillna(-1).astype("int64").tolist()


def test_asof_equal_timestamp_matches_and_null_stays_null(spark):
    left = spark.createDataFrame([(1, "2024-01-01 00:00:10"), (1, "2024-01-01 00:00:05"), (2, "2024-01-01 00:00:01")],
                                 "k int, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    right = spark.createDataFrame([(1, "2024-01-01 00:00:05", None), (1, "2024-01-01 00:00:01", 7.0)],
                                  "k int, rts string, v double").withColumn("rts", F.col("rts").cast("timestamp"))
    out = asof.asof_join(left, right, ("ts", "rts"), by="k", width_s=2).orderBy("k", "ts").collect()
    # equal timestamps match; the matched row's NULL value is not filled from an older row
    assert [(r.k, r.v, r.rts is None) for r in out] == [(1, None, False), (1, None, False), (2, None, True)]


def test_nearest_tie_goes_to_lower_key(spark):
    targets = spark.createDataFrame([("2024-01-01 00:00:10",)], "ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    rows = spark.createDataFrame([(5, "2024-01-01 00:00:05"), (6, "2024-01-01 00:00:15"), (7, "2024-01-01 00:09:00")],
                                 "number long, timestamp string").withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    r = asof.nearest(targets, rows, tolerance_s=60, width_s=4).first()
    assert r.nearest_number == 5 and r.distance_s == 5.0


def test_zscore_whole_series(blocks):
    z = windows.zscore(blocks, "gas_used", min_count=10)
    st = blocks.agg(F.avg("gas_used"), F.stddev_samp("gas_used")).first()
    r = z.orderBy("number").first()
    assert abs(r.gas_used_z - (r.gas_used - st[0]) / (st[1] + 1e-10)) < 1e-9


def test_range_index_equals_bucket_index(blocks):
    a = ordered.dense_index(blocks, ["number"], index="bucket", width=128)
    b = ordered.dense_index(blocks, ["number"], index="range")
    assert _rows(a.select("number", ordered.IDX)) == _rows(b.select("number", ordered.IDX))


def test_halo_over_timestamps_uses_range_index(blocks):
    got = ordered.halo_window(blocks, ["timestamp", "number"], lambda w: {"p": F.lag("number", 1).over(w)},
                              preceding=1, bucket_rows=50).drop(ordered.IDX)
    exp = blocks.select("*", F.lag("number").over(Window.orderBy("timestamp", "number")).alias("p"))
    assert _rows(got) == _rows(exp)


def test_asof_forward_and_tolerance(spark):
    left = spark.createDataFrame([("2024-01-01 00:00:10",), ("2024-01-01 00:01:00",)], "ts string").withColumn(
        "ts", F.col("ts").cast("timestamp"))
    right = spark.createDataFrame([("2024-01-01 00:00:05", 1), ("2024-01-01 00:00:40", 2)],
                                  "rts string, id int").withColumn("rts", F.col("rts").cast("timestamp"))
    back = {r.ts.second + 60 * r.ts.minute: r.id for r in
            asof.asof_join(left, right, ("ts", "rts"), width_s=30, tolerance_s=15).collect()}
    assert back == {10: 1, 60: None}          # 00:01:00 -> 00:00:40 is 20 s away, beyond 15 s
    fwd = {r.ts.second + 60 * r.ts.minute: r.id for r in
           asof.asof_join(left, right, ("ts", "rts"), width_s=30, direction="forward").collect()}
    assert fwd == {10: 2, 60: None}


def test_rolling_correlation(blocks):
    from gapseries.operators import rollup
    b = blocks.withColumn("tx", F.col("transaction_count").cast("double"))
    got = rollup.correlation(b, "gas_used", "tx", window=30, order="number").orderBy("number").toPandas()
    f = Window.orderBy("number").rowsBetween(-29, 0)
    exp = b.select("number", F.when(F.count(F.lit(1)).over(f) >= 30, F.corr("gas_used", "tx").over(f)).alias("c")) \
        .orderBy("number").toPandas()
    diff = (got["corr_gas_used_tx_30"] - exp["c"]).abs().max()
    assert diff < 1e-9


def test_asof_skew_safe_equals_default(spark):
    left = driver.purchases(spark, SF01)
    right = driver.views(spark, SF01)
    a = asof.asof_join(left, right, "ts", by="user_id", r_order=["view_id"]).select("event_id", "view_id")
    b = asof.asof_join(left, right, "ts", by="user_id", r_order=["view_id"], skew_safe=True, bucket_rows=8).select(
        "event_id", "view_id")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


@pytest.mark.parametrize("n", [1, 2, 60, 200])
def test_rolling_blocks_equal_window(spark, n):
    """Every statistic, keyed (NULL key included), with NULL values, for frames below and above a bucket."""
    rows = [(i, None if i % 4 == 0 else i % 4, None if i % 7 == 3 else float((i * 37) % 101) - 50) for i in range(600)]
    df = spark.createDataFrame(rows, "n long, k long, v double")
    fns = ["mean", "std", "sum", "min", "max", "zscore", "median"]
    for need in (None, 1):
        got = ordered.rolling(df, ["n"], "v", n, fns, by="k", bucket_rows=50, width=64, min_periods=need, eps=1e-9)
        f = Window.partitionBy("k").orderBy("n").rowsBetween(-(n - 1), 0)
        ok = F.count("v").over(f) >= (need or n)
        mean, std = F.avg("v").over(f), F.stddev_samp("v").over(f)
        exprs = {"mean": mean, "std": std, "sum": F.sum("v").over(f), "min": F.min("v").over(f), "max": F.max("v").over(f),
                 "zscore": F.try_divide(F.col("v") - mean, std + 1e-9), "median": F.percentile("v", F.lit(0.5)).over(f)}
        exp = df.select("*", *[F.when(ok, e).alias(f"v_{fn}_{n}") for fn, e in exprs.items()])
        a, b = (x.toPandas().sort_values("n").reset_index(drop=True) for x in (got, exp))
        pd.testing.assert_frame_equal(a[b.columns], b, check_exact=False, rtol=1e-9, atol=1e-9)


def test_rolling_does_not_cancel(spark):
    """Values of 1e18 leave no error behind once they have left the frame."""
    df = spark.createDataFrame([(i, 1e18 if i < 50 else 0.25) for i in range(200)], "n long, v double")
    got = {r.n: r for r in ordered.rolling(df, ["n"], "v", 20, ["sum", "mean", "std"], bucket_rows=30, width=16).collect()}
    for i in range(70, 200):
        assert (got[i].v_sum_20, got[i].v_mean_20, got[i].v_std_20) == (5.0, 0.25, 0.0)


def test_rows_without_a_key_are_a_series(spark):
    rows = [(i, None if i % 3 == 0 else i % 3, float(i * i % 17)) for i in range(90)]
    df = spark.createDataFrame(rows, "n long, k long, v double")
    w = Window.partitionBy("k").orderBy("n")
    for skew_safe in (False, True):
        got = ordered.with_prev(df, "n", ["v"], by="k", width=5, skew_safe=skew_safe)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, df.withColumn("prev_v", F.lag("v").over(w)).collect()))
    got = ordered.global_index(df, ["n"], by="k", width=5)
    exp = df.withColumn(ordered.IDX, (F.row_number().over(w) - 1).cast("bigint"))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, exp.collect()))
    exp = {r.k: r.q for r in df.groupBy("k").agg(F.percentile("v", F.lit(0.5)).alias("q")).collect()}
    assert {r.k: r.v_q50 for r in ordered.exact_quantile(df, "v", by="k").collect()} == exp
    z = windows.zscore(df, "v", by="k", min_count=3)
    assert z.filter("v_z is null").count() == 0 and z.columns == ["n", "k", "v", "v_z", "v_outlier"]
    ts = df.select(F.timestamp_seconds(F.col("n") * 7200).alias("ts"), "k", "v")
    j = asof.asof_join(ts, ts.withColumnRenamed("v", "r"), "ts", by="k")
    assert j.filter("k is null and r is not null").count() == 0 and j.filter("k is not null and r <> v").count() == 0
    holes = ts.withColumn("v", F.when(F.unix_seconds("ts") % 14400 == 0, F.col("v")))
    filled = asof.ffill(holes, "ts", ["v"], by="k")
    exp = holes.select("ts", "k", F.last("v", ignorenulls=True).over(Window.partitionBy("k").orderBy("ts")).alias("v_prev"))
    name = [c for c in filled.columns if c not in ("ts", "k")][0]
    assert sorted(map(repr, filled.select("ts", "k", F.col(name).alias("v_prev")).collect())) == sorted(map(repr, exp.collect()))


def test_many_sources_in_one_pass(spark):
    """Backward and forward sources together, keyed, crowded spans cut, equal times, empty sources: as one join after the other."""
    import random
    rng = random.Random(11)
    left = spark.createDataFrame([(i, rng.choice(["a", "b", None]), rng.randint(0, 400)) for i in range(120)], "id long, k string, s long")
    side = lambda n, lo: spark.createDataFrame(
        [(i, rng.choice(["a", "b", None]), rng.randint(lo, 400)) for i in range(n)], "r long, k string, s long")
    at = lambda df: df.withColumn("ts", F.timestamp_seconds("s")).drop("s")     # noqa: E731
    left, sides = at(left), [at(side(200, 0)), at(side(80, 100)), at(side(50, 0)).limit(0)]
    rows = [[tuple(r) for r in x.select("r", "k", F.unix_seconds("ts").cast("int")).collect()] for x in sides]
    want = []
    for r in left.select("id", "k", F.unix_seconds("ts").cast("int").alias("s")).collect():
        out = [r.id]
        for table, forward in ((rows[0], False), (rows[1], True), (rows[2], False), (rows[1], False)):
            near = [x for x in table if x[1] == r.k and r.k is not None and (x[2] >= r.s if forward else x[2] <= r.s)]
            best = (min(near, key=lambda x: (x[2], x[0])) if forward else max(near, key=lambda x: (x[2], x[0]))) if near else None
            out.append(best and best[0])
        want.append(tuple(out))
    for options in ({}, {"skew_safe": False}, {"skew_safe": True, "bucket_rows": 16}, {"crowded_rows": 3}):
        got = asof.carry(left, "ts", [asof.Carried(sides[0], "ts", ["r"], "backward", "a"), asof.Carried(sides[1], "ts", ["r"], "forward", "b"),
                                      asof.Carried(sides[2], "ts", ["r"], "backward", "c"), asof.Carried(sides[1], "ts", ["r"], "backward", "d")],
                         by=["k"], width_us=40_000_000, **options)
        got = got.select("_as_l.id", "a.r", "b.r", "c.r", "d.r")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str), options


def test_fuse_and_nearest_run_nothing_while_planned(spark):
    """No job before an action, and the series is shuffled once."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    bars = spark.range(10).select(F.timestamp_seconds(F.col("id") * 3600).alias("ts"))
    src = spark.range(1000).select(F.timestamp_seconds(F.col("id") * 30).alias("timestamp"), F.col("id").alias("number"))
    fused = asof.fuse(bars, {"a": src, "b": src, "c": src}, skew_safe=False)
    near = asof.nearest(bars, src, tolerance_s=60)
    assert not tracker.getJobIdsForGroup("planning")
    spark.sparkContext.setJobGroup("other", "other")
    assert fused.count() == 10 and near.filter("nearest_number is not null").count() == 9
