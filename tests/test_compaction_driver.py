"""Compaction sends listings through the driver, never the rows of a folder."""

from gapseries.sinks import compaction as C
from gapseries.sinks import writers as W
from gapseries.sources import driver

from conftest import SF001


def test_rows_are_not_broadcast(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    for k in range(2):
        W.write_blocks(driver.raw_blocks(spark, SF001).where(f"number % 2 = {k}"), path)
    plans = []
    frame = type(driver.raw_blocks(spark, SF001))
    deal = frame.repartitionById
    monkeypatch.setattr(frame, "repartitionById", lambda df, *a: plans.append(
        df._jdf.queryExecution().optimizedPlan().toString()) or deal(df, *a))
    before = W.read_table(spark, path).count()
    C.compact_files(spark, path, "number")
    assert plans and all("rightHint=(strategy=broadcast)" in p for p in plans)
    assert W.read_table(spark, path).count() == before
