"""Sink plans: write to a scratch table under ``spark.checkpoint.dir``, read it
back and return what a user would check (counts, retained reports, compacted
partitions)."""

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from gapseries.plans.q_quality import REPORTS, _report
from gapseries.plans.registry import register
from gapseries.plans.sqlviews import BLOCKS, RAW_BLOCKS, SOURCES, with_
from gapseries.session import cut_lineage, scratch_path
from gapseries.sinks import compaction as C
from gapseries.sinks import deltas as X
from gapseries.sinks import writers as W
from gapseries.sources import decoders as D
from gapseries.sources import driver


def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@register("write_upsert_verify", "SNK-1 SNK-2 SNK-7 AGG-9", sql=with_(RAW_BLOCKS) + """,
first AS (SELECT * FROM raw_blocks WHERE _ingest_seq = 1)
SELECT CAST(year("timestamp") AS INTEGER) AS year, count(*) AS source_rows, count(*) AS target_rows,
       true AS match, CAST(sum(gas_used) AS BIGINT) AS gas_used_after_upsert
FROM (SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY number ORDER BY _ingest_seq DESC) AS _rn
                                    FROM raw_blocks) t WHERE _rn = 1) GROUP BY 1""")
def write_upsert_verify(spark, sf_dir):
    """Append first versions (month partitions), upsert the revisions (touched
    partitions only, twice: a replay changes nothing), verify per-year counts."""
    path = os.path.join(_scratch(spark, "blocks"), "table")
    raw = driver.raw_blocks(spark, sf_dir)
    first = raw.filter(F.col("_ingest_seq") == 1)
    W.write_blocks(first, path, mode="overwrite")
    W.upsert_table(spark, path, raw.filter(F.col("_ingest_seq") == 2))
    W.upsert_table(spark, path, raw.filter(F.col("_ingest_seq") == 2))
    table = W.read_table(spark, path)
    v = W.verify_counts(first, table)
    gas = table.groupBy(F.year("timestamp").alias("year")).agg(F.sum("gas_used").cast("bigint")
                                                                 .alias("gas_used_after_upsert"))
    return v.join(gas, "year", "left").select(F.col("year").cast("int").alias("year"), "source_rows", "target_rows",
                                             "match", "gas_used_after_upsert")


@register("report_retention", "SNK-9 SNK-10 SRC-11", sql=with_(BLOCKS, REPORTS) + """
SELECT check_name, count(*) AS runs, CAST(sum(failures) AS BIGINT) AS failures, min("timestamp") AS first_run
FROM reports WHERE CAST("timestamp" AS DATE) >= DATE '2024-01-24' GROUP BY check_name""")
def report_retention(spark, sf_dir):
    """Append daily validation reports, keep the last 7 days in a new snapshot, read them back by date."""
    base = _scratch(spark, "reports")
    W.append_reports(_report(spark, sf_dir), "validation", base)
    kept = os.path.join(base, "kept")
    W.retain(spark, base, "validation", dt.datetime(2024, 1, 31), 7, os.path.join(kept, "validation"))
    r = D.read_reports(spark, kept, "validation", start="2024-01-24")
    return r.groupBy("check_name").agg(F.count(F.lit(1)).alias("runs"), F.sum("failures").cast("bigint")
                                       .alias("failures"), F.min("timestamp").alias("first_run"))


@register("hourly_compaction", "SNK-4 SNK-12 SNK-5 SNK-11", sql=with_(BLOCKS) + """
SELECT CAST("timestamp" AS DATE) AS date, count(*) AS blocks, CAST(sum(transaction_count) AS BIGINT) AS tx
FROM blocks GROUP BY 1""")
def hourly_compaction(spark, sf_dir):
    """Write hourly snapshot partitions (Snappy), compact them into daily
    partitions, export the daily table as CSV and read it back."""
    base = _scratch(spark, "hourly")
    blocks = driver.blocks(spark, sf_dir, ["timestamp", "transaction_count"]).select("timestamp", "number", "transaction_count")
    W.write_hourly(blocks, os.path.join(base, "hourly"))
    W.compact(spark, os.path.join(base, "hourly"), os.path.join(base, "daily"))
    daily = spark.read.parquet(os.path.join(base, "daily"))
    W.export(daily, os.path.join(base, "csv"), "csv")
    back = (spark.read.schema("timestamp timestamp, number long, transaction_count long")
            .option("header", True).csv(os.path.join(base, "csv")))
    return back.groupBy(F.to_date("timestamp").alias("date")).agg(
        F.count(F.lit(1)).alias("blocks"), F.sum("transaction_count").cast("bigint").alias("tx"))


@register("delta_upsert", "SNK-2 SNK-8", sql=with_(RAW_BLOCKS) + """,
newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY number ORDER BY _ingest_seq DESC) AS _rn FROM raw_blocks) t
           WHERE _rn = 1)
SELECT stage, strftime("timestamp", '%Y%m%d') AS day, count(*) AS blocks, CAST(sum(gas_used) AS BIGINT) AS gas_used,
       CAST(sum(number) AS BIGINT) AS numbers
FROM newest, (VALUES ('laid over'), ('merged')) s(stage) GROUP BY 1, 2""")
def delta_upsert(spark, sf_dir):
    """First versions as base, the revisions flushed as three deltas (one delivered twice): the table read with its deltas
    laid over, and again after they were merged."""
    path = os.path.join(_scratch(spark, "deltas"), "table")
    raw = driver.raw_blocks(spark, sf_dir)
    W.write_blocks(raw.filter(F.col("_ingest_seq") == 1), os.path.join(path, "base"), mode="overwrite")
    later = raw.filter(F.col("_ingest_seq") > 1)
    for k in (0, 1, 2, 1):
        X.append_delta(spark, path, later.filter(F.pmod(F.xxhash64("number"), F.lit(3)) == k), f"flush-{k}")

    def days(stage):
        return X.read_merged(spark, path).groupBy(F.date_format("timestamp", "yyyyMMdd").alias("day")).agg(
            F.count(F.lit(1)).alias("blocks"), F.sum("gas_used").cast("bigint").alias("gas_used"),
            F.sum("number").cast("bigint").alias("numbers")).select(F.lit(stage).alias("stage"), "day", "blocks", "gas_used", "numbers")
    before = cut_lineage(days("laid over"))         # the merge removes what it reads
    X.merge_deltas(spark, path)
    return before.unionByName(days("merged"))


@register("size_compaction", "SNK-12", sql=with_(BLOCKS) + """
SELECT strftime("timestamp", '%Y%m%d') AS day, count(*) AS blocks, CAST(sum(gas_used) AS BIGINT) AS gas_used, 1 AS files
FROM blocks GROUP BY 1""")
def size_compaction(spark, sf_dir):
    """Daily partitions written by four loads, packed by file size: rows and files of each day afterwards (a day is far below
    the target, so one file each)."""
    path = os.path.join(_scratch(spark, "packed"), "table")
    blocks = driver.blocks(spark, sf_dir).drop("year_month")
    for k in range(4):
        W.write_blocks(blocks.filter(F.pmod(F.col("number"), F.lit(4)) == k), path, part_col="day")
    C.compact_files(spark, path, "number")
    table = W.read_table(spark, path, part_col="day").select("day", "gas_used", F.col("_metadata.file_path").alias("file"))
    return table.groupBy("day").agg(F.count(F.lit(1)).alias("blocks"), F.sum("gas_used").cast("bigint").alias("gas_used"),
                                    F.count_distinct("file").cast("int").alias("files"))


@register("append_ignore", "SNK-3 JN-12", sql=with_(SOURCES) + """
SELECT strftime("timestamp", '%Y%m%d') AS day, count(*) AS blocks, CAST(sum(gas_used) AS BIGINT) AS gas_used,
       CAST(sum(number) AS BIGINT) AS numbers
FROM (SELECT "timestamp", gas_used, number FROM src_primary UNION ALL
      SELECT "timestamp", gas_used, number FROM src_backfill b WHERE NOT EXISTS (SELECT 1 FROM src_primary a WHERE a.number = b.number)) t
GROUP BY 1""")
def append_ignore(spark, sf_dir):
    """The first source stored, the second appended where its keys are new, twice (the second time nothing is)."""
    path = os.path.join(_scratch(spark, "append"), "table")
    W.write_blocks(driver.source_blocks(spark, sf_dir, "primary"), path, mode="overwrite")
    for _ in range(2):
        W.append_new(spark, path, driver.source_blocks(spark, sf_dir, "backfill"))
    return W.read_table(spark, path).groupBy(F.date_format("timestamp", "yyyyMMdd").alias("day")).agg(
        F.count(F.lit(1)).alias("blocks"), F.sum("gas_used").cast("bigint").alias("gas_used"), F.sum("number").cast("bigint").alias("numbers"))
