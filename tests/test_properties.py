"""Property tests: bucketed kernels equal brute force on random inputs and bucket sizes."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gapseries.operators import gaps as G
from gapseries.operators import latest as L
from gapseries.operators import ordered

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(keys=st.lists(st.integers(0, 400), min_size=1, max_size=80), width=st.integers(1, 64))
def test_gaps_match_brute_force(spark, keys, width):
    df = spark.createDataFrame([(k,) for k in keys], "number long")
    got = sorted((r.gap_start, r.gap_end, r.gap_size) for r in G.detect_gaps(df, width=width).collect())
    u = sorted(set(keys))
    exp = sorted((a + 1, b - 1, b - a - 1) for a, b in zip(u, u[1:]) if b - a > 1)
    assert got == exp
    assert sum(g[2] for g in got) == (u[-1] - u[0] + 1) - len(u)


@SETTINGS
@given(keys=st.lists(st.integers(0, 300), min_size=1, max_size=60, unique=True), width=st.integers(1, 40),
       n=st.integers(1, 9), rows=st.integers(1, 12))
def test_rolling_sum_and_lag_match_brute_force(spark, keys, width, n, rows):
    ks = sorted(keys)
    df = spark.createDataFrame([(k, float(k % 7)) for k in ks], "number long, v double")
    out = ordered.halo_window(df, ["number"], lambda w: {
        "s": F.sum("v").over(w.rowsBetween(-(n - 1), 0)), "p": F.lag("number", 2).over(w)},
        preceding=max(n - 1, 2), width=width, bucket_rows=rows).collect()
    got = {r.number: (r.s, r.p) for r in out}
    vals = [float(k % 7) for k in ks]
    for i, k in enumerate(ks):
        assert got[k][0] == sum(vals[max(0, i - n + 1):i + 1])
        assert got[k][1] == (ks[i - 2] if i >= 2 else None)


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 20), st.integers(1, 5), st.integers(0, 9)), min_size=1, max_size=60))
def test_latest_is_idempotent_and_picks_max_seq(spark, rows):
    df = spark.createDataFrame(rows, "number long, _ingest_seq long, v long")
    once = L.latest(df, "number")
    twice = L.latest(once.unionByName(df), "number")
    a = sorted(tuple(r) for r in once.collect())
    assert a == sorted(tuple(r) for r in twice.collect())
    best = {}
    for k, s, v in rows:
        best[k] = max(best.get(k, (s, v)), (s, v))
    assert a == sorted((k, s, v) for k, (s, v) in best.items())


@SETTINGS
@given(vals=st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50)), min_size=1, max_size=80),
       q=st.sampled_from([0.0, 0.25, 0.5, 0.9, 1.0]))
def test_exact_quantile_matches_numpy(spark, vals, q):
    import numpy as np
    df = spark.createDataFrame(vals, "g long, x long")
    got = {r.g: r.xq for r in ordered.exact_quantile(df, "x", q, by="g", out="xq").collect()}
    exp = {}
    for g in {v[0] for v in vals}:
        exp[g] = float(np.quantile([v[1] for v in vals if v[0] == g], q))
    assert got.keys() == exp.keys()
    assert all(abs(got[g] - exp[g]) < 1e-9 for g in exp)
