"""Feature edge cases: short series, NULLs, zero denominators, constant and empty series."""

from pyspark.sql import functions as F

from gapseries.operators import gaps as G
from gapseries.operators import ordered, windows


def _df(spark, rows):
    return spark.createDataFrame(rows, "number long, v double")


def test_fewer_rows_than_window_and_null_inside(spark):
    df = _df(spark, [(1, 1.0), (2, None), (3, 3.0)])
    r = {x.number: x.v_mean_3 for x in ordered.rolling(df, ["number"], "v", 3, ["mean"]).collect()}
    assert r == {1: None, 2: None, 3: None}          # 2 non-null values in a 3-row frame: NULL
    r2 = {x.number: x.v_mean_2 for x in ordered.rolling(df, ["number"], "v", 2, ["mean"], min_periods=1).collect()}
    assert r2 == {1: 1.0, 2: 1.0, 3: 3.0}


def test_zero_denominator_and_single_row(spark):
    df = _df(spark, [(1, 0.0), (2, 5.0)])
    pc = {x.number: x.v_pct_change for x in windows.pct_change(df, "number", "v").collect()}
    assert pc == {1: None, 2: None}
    one = _df(spark, [(7, 1.0)])
    assert windows.lagged(one, "number", ["v"]).first().prev_v is None
    assert {x.number: x.v_shift_2 for x in windows.lagged(_df(spark, [(1, 1.0), (2, 2.0), (3, 3.0)]), "number",
                                                          ["v"], k=2).collect()} == {1: None, 2: None, 3: 1.0}


def test_constant_series(spark):
    df = _df(spark, [(i, 4.0) for i in range(20)])
    z = windows.zscore(df, "v", min_count=10).select("v_z").distinct().collect()
    assert [r.v_z for r in z] == [0.0]
    s = ordered.rolling(df, ["number"], "v", 5, ["std"]).filter(F.col("v_std_5").isNotNull())
    assert {r.v_std_5 for r in s.collect()} == {0.0}


def test_empty_input(spark):
    empty = _df(spark, [])
    assert G.detect_gaps(empty).count() == 0
    assert ordered.rolling(empty, ["number"], "v", 3, ["mean"]).count() == 0
    c = G.completeness(empty).first()
    assert (c.total_rows, c.expected, c.missing) == (0, 0, 0)


def test_schema_layer_checks(spark):
    from gapseries.operators import quality as Q
    from gapseries.sources.contract import block_contract
    df = spark.createDataFrame([(1, -5)], "number long, gas_used long")
    issues = dict(Q.schema_issues(block_contract(), df))
    assert issues["size"] == "missing" and "gas_used" not in issues
    row = Q.check_schema(df, block_contract()).first()
    assert row.ok_number_not_null and not row["ok_gas_used_min_0"]
