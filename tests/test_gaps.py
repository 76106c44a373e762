"""Gap detection, lifecycle (grace boundary, sticky notified, multi-block gaps), time gaps."""

import datetime as dt

from pyspark.sql import functions as F

from gapseries.operators import gaps as G
from gapseries.sources.contract import GAP_STATE_SCHEMA

AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)


def _keys(spark, nums):
    return spark.createDataFrame([(n,) for n in nums], "number long")


def test_no_head_gap_by_default(spark):
    g = G.detect_gaps(_keys(spark, [5, 6, 9, 10, 14]), width=4).orderBy("gap_start").collect()
    assert [(r.gap_start, r.gap_end, r.gap_size) for r in g] == [(7, 8, 2), (11, 13, 3)]


def test_head_gap_with_expected_start(spark):
    g = G.detect_gaps(_keys(spark, [5, 6, 9]), width=2, expected_start=1).orderBy("gap_start").collect()
    assert [(r.gap_start, r.gap_end) for r in g] == [(1, 4), (7, 8)]


def test_duplicates_are_not_gaps(spark):
    assert G.detect_gaps(_keys(spark, [1, 2, 2, 3, 3, 3])).count() == 0


def test_expand_big_gap_in_chunks(spark):
    g = G.detect_gaps(_keys(spark, [0, 100_001]))
    keys = G.expand_gaps(g, chunk=1000)
    assert keys.count() == 100_000
    assert keys.agg(F.min("number"), F.max("number")).first() == (1, 100_000)


def _state(spark, rows):
    return spark.createDataFrame(rows, GAP_STATE_SCHEMA)


def test_lifecycle_cases(spark):
    s = AS_OF
    state = _state(spark, [
        (10, 10, 1, s - dt.timedelta(seconds=600), s, False),      # inside grace
        (20, 20, 1, s - dt.timedelta(seconds=1800), s, False),     # exactly 1800 s: still grace
        (30, 30, 1, s - dt.timedelta(seconds=1801), s, False),     # 1801 s: persistent, alert now
        (40, 40, 1, s - dt.timedelta(seconds=9000), s, True),      # already notified: no second alert
        (50, 52, 3, s - dt.timedelta(seconds=100), s, False),      # multi-block gap still open
        (60, 60, 1, s - dt.timedelta(seconds=100), s, False),      # filled: resolved
    ])
    cur = spark.createDataFrame([(10, 10, 1), (20, 20, 1), (30, 30, 1), (40, 40, 1), (50, 52, 3), (70, 71, 2)],
                                "gap_start long, gap_end long, gap_size long")
    new_state, ev = G.update_gap_state(cur, state, AS_OF, grace_s=1800)
    status = {r.gap_start: r.status for r in ev.collect()}
    assert status == {10: "GRACE", 20: "GRACE", 30: "PERSISTENT", 40: "NOTIFIED", 50: "GRACE", 60: "RESOLVED",
                      70: "NEW"}
    st = {r.gap_start: r for r in new_state.collect()}
    assert set(st) == {10, 20, 30, 40, 50, 70}
    assert st[30].notified and st[40].notified and not st[10].notified
    assert st[70].first_seen == AS_OF and all(r.last_seen == AS_OF for r in st.values())


def test_more_than_twenty_gaps_all_compared(spark):
    nums = list(range(0, 200, 3))          # 66 gaps of size 2
    cur = G.detect_gaps(_keys(spark, nums))
    state = cur.select("gap_start", "gap_end", "gap_size", F.lit(AS_OF - dt.timedelta(hours=2)).alias("first_seen"),
                       F.lit(AS_OF).alias("last_seen"), F.lit(False).alias("notified"))
    _, ev = G.update_gap_state(cur, state, AS_OF)
    counts = {r.status: r["count"] for r in ev.groupBy("status").count().collect()}
    assert counts == {"PERSISTENT": 66}


def test_expired_state(spark):
    state = _state(spark, [(1, 1, 1, AS_OF - dt.timedelta(days=3), AS_OF - dt.timedelta(days=2), False)])
    cur = spark.createDataFrame([], "gap_start long, gap_end long, gap_size long")
    new_state, ev = G.update_gap_state(cur, state, AS_OF, expire_h=24)
    assert new_state.count() == 0 and [r.status for r in ev.collect()] == ["EXPIRED"]


def test_time_gap_golden(spark):
    ts = [dt.datetime(2025, 1, 1, 0, m) for m in (0, 1, 2, 6)]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp")
    g = G.detect_time_gaps(df, "ts", interval_s=60, threshold=1.5, width=120_000_000).collect()
    assert len(g) == 1
    r = g[0]
    assert (r.gap_start, r.gap_end, r.duration_s, r.missing_intervals) == (ts[2], ts[3], 240.0, 3)
    filled = G.expand_time_gaps(G.detect_time_gaps(df, "ts", 60, 1.5), 60).orderBy("ts").collect()
    assert [x.ts for x in filled] == [dt.datetime(2025, 1, 1, 0, m) for m in (3, 4, 5)]


def test_freshness_bands_and_empty_raises(spark):
    df = spark.createDataFrame([(1, AS_OF - dt.timedelta(seconds=59))], "number long, timestamp timestamp")
    r = G.freshness(df, "timestamp", AS_OF, threshold_s=600).first()
    assert (r.age_s, r.band, r.is_fresh) == (59, "GOOD", True)
    import pytest
    empty = df.filter(F.lit(False))
    with pytest.raises(Exception):
        G.freshness(empty, "timestamp", AS_OF).collect()


def test_time_gaps_skew_safe_equals_default(spark):
    from gapseries.sources import driver
    b = driver.blocks(spark, "/root/testdata/sf0.001", ["timestamp"])
    a = G.detect_time_gaps(b, "timestamp", 300, 1.5, tiebreak=["number"], width=3_600_000_000)
    c = G.detect_time_gaps(b, "timestamp", 300, 1.5, tiebreak=["number"], skew_safe=True)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, c.collect())) and a.count() > 0


def test_alerts_healthy_and_stale(spark):
    blocks = spark.createDataFrame([(n, AS_OF - dt.timedelta(seconds=30)) for n in range(1, 6)],
                                   "number long, timestamp timestamp")
    empty = spark.createDataFrame([], "gap_start long, gap_end long, gap_size long, first_seen timestamp, "
                                      "age_s long, status string")
    h = G.health(blocks, empty, AS_OF)
    a = G.alerts(empty, h).collect()
    assert [(r.title, r.priority) for r in a] == [("HEALTHY", 0)]
    late = G.health(blocks, empty, AS_OF + dt.timedelta(hours=2))
    b = G.alerts(empty, late).collect()
    assert [(r.title, r.priority) for r in b] == [("DATA STALE", 2)]


def test_sizing_conf():
    from gapseries.session import sizing_conf
    c = sizing_conf(100 * 2 ** 40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    assert sizing_conf(1, 8)["spark.sql.shuffle.partitions"] == "16"


def test_bitmap_gaps_equal_window(spark):
    """Bitmaps against lag: negative and very large keys, duplicates, NULLs, series without a key, tiny and full buckets."""
    import random

    from pyspark.sql import Window
    rng = random.Random(3)
    keys = [rng.randint(-300, 300) for _ in range(200)] + [(1 << 60) + rng.randint(0, 90_000) for _ in range(300)]
    rows = [(k, rng.choice([None, "a", "b"])) for k in keys] + [(None, "a"), (None, None)]
    df = spark.createDataFrame(rows, "number long, chain string")
    w = Window.partitionBy("chain").orderBy("number")
    exp = (df.dropna(subset=["number"]).distinct().withColumn("p", F.lag("number").over(w)).filter("number - p > 1")
           .selectExpr("chain", "p + 1 AS gap_start", "number - 1 AS gap_end", "number - p - 1 AS gap_size"))
    for width in (None, 7, 64):
        got = G.detect_gaps(df, "number", by="chain", width=width)
        assert got.columns == ["chain", "gap_start", "gap_end", "gap_size"]
        assert sorted(map(repr, got.collect())) == sorted(map(repr, exp.collect()))
        held = G.distinct_keys(df, "number", by="chain", width=width)
        want = df.dropna(subset=["number"]).groupBy("chain").agg(F.count_distinct("number").alias("keys"), F.min("number").alias("min_key"),
                                                                F.max("number").alias("max_key"))
        assert sorted(map(repr, held.collect())) == sorted(map(repr, want.collect()))
    assert G.detect_gaps(df.limit(0)).collect() == []


def test_bitmap_gaps_read_the_table_once(spark, tmp_path):
    spark.range(0, 200_000).filter("id % 1000 <> 7").withColumnRenamed("id", "number").write.parquet(str(tmp_path / "t"))
    out = G.detect_gaps(spark.read.parquet(str(tmp_path / "t")))
    assert out.count() == 200
    plan = out._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("== Initial Plan ==")[0]
    assert "bitmap_construct_agg" in plan
