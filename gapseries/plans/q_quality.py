"""Quality plans: row validation, validation / gap / anomaly reports and report queries."""

from pyspark.sql import functions as F

from gapseries.functions import features as X
from gapseries.operators import gaps as G
from gapseries.operators import quality as Q
from gapseries.operators import ordered, rollup
from gapseries.plans.registry import register, round_doubles
from gapseries.plans.sqlviews import BLOCKS, with_
from gapseries.sources import driver

AS_OF = "2024-01-31 00:00:00"

# (name, layer, message, sql predicate): the twins of the library's block rules and of two custom rules
RULES = [
    ("gas_used_within_limit", "sanity", "0 <= gas_used <= gas_limit", "gas_used >= 0 AND gas_used <= gas_limit"),
    ("size_positive", "sanity", "size > 0", "size > 0"),
    ("tx_count_non_negative", "sanity", "transaction_count >= 0", "transaction_count >= 0"),
    ("base_fee_after_london", "sanity", "base fee >= 1 wei from London on",
     f"number < {driver.SCALED_LONDON} OR base_fee_per_gas >= 1"),
    ("difficulty_zero_after_merge", "sanity", "difficulty is 0 from the Merge on",
     f"number < {driver.SCALED_MERGE} OR difficulty = 0"),
    ("blob_gas_within_max", "custom", "a block can't hold more than 6 blobs", "blob_gas_used IS NULL OR blob_gas_used <= 786432"),
    ("avg_gas_per_tx_max", "custom", "average gas per transaction <= 500000",
     "(CASE WHEN transaction_count > 0 THEN gas_used / transaction_count ELSE 0.0 END) <= 500000"),
]


def _rules():
    return Q.block_rules(driver.SCALED_LONDON, driver.SCALED_MERGE) + [
        Q.custom_rule("blob_gas_within_max", F.col("blob_gas_used").isNull() | (F.col("blob_gas_used") <= 786432),
                      "a block can't hold more than 6 blobs"),
        Q.custom_rule("avg_gas_per_tx_max", X.avg_gas_per_tx() <= 500000, "average gas per transaction <= 500000")]


def _fail_sql(sql_pred: str) -> str:
    return f"NOT COALESCE({sql_pred}, false)"


@register("block_validation", "DQ-1 DQ-2 DQ-5 DQ-7", sql=with_(BLOCKS) + """
SELECT number, concat_ws(',', """ + ", ".join(
    f"CASE WHEN {_fail_sql(s)} THEN '{n}' END" for n, _, _, s in RULES) + """) = '' AS valid,
       concat_ws(',', """ + ", ".join(f"CASE WHEN {_fail_sql(s)} THEN '{n}' END" for n, _, _, s in RULES) + """)
         AS errors
FROM blocks""")
def block_validation(spark, sf_dir):
    b = driver.blocks(spark, sf_dir)
    rules = Q.schema_rules(driver.scaled_contract(), b.columns) + _rules()
    v = Q.validate_rows(b, rules)
    return v.select("number", F.col("validation.valid").alias("valid"),
                    F.array_join("validation.errors", ",").alias("errors"))


def _report(spark, sf_dir):
    b = driver.blocks(spark, sf_dir).withColumn("day", F.to_date("timestamp"))
    return Q.report(b, _rules(), AS_OF, "ethereum", by="day", tolerance=0.01,
                    run_ts=F.to_timestamp(F.date_add(F.col("day"), 1)))


def _report_sql() -> str:
    parts = []
    for n, layer, msg, s in RULES:
        msg = msg.replace("'", "''")
        parts.append(f"""SELECT CAST(day + INTERVAL 1 DAY AS TIMESTAMP) AS "timestamp", 'ethereum' AS chain,
         '{layer}' AS layer, CASE WHEN f = 0 THEN 'pass' WHEN f / r <= 0.01 THEN 'warning' ELSE 'fail' END AS status,
         '{n}' AS check_name, '{msg}' AS message,
         '{{"failures":' || f || ',"records":' || r || ',"day":"' || strftime(day, '%Y-%m-%d') || '"}}' AS context,
         t0 AS data_timestamp_start, t1 AS data_timestamp_end, r AS records_validated, CAST(f AS BIGINT) AS failures,
         CAST(NULL AS DOUBLE) AS execution_time_ms
  FROM (SELECT CAST("timestamp" AS DATE) AS day, count(*) AS r, min("timestamp") AS t0, max("timestamp") AS t1,
               count(*) FILTER (WHERE {_fail_sql(s)}) AS f FROM blocks GROUP BY 1) g""")
    return "reports AS (\n" + "\nUNION ALL\n".join(parts) + "\n)"


REPORTS = _report_sql()


@register("validation_report", "DQ-6 SNK-9 FN-27", sql=with_(BLOCKS, REPORTS) + "SELECT * FROM reports")
def validation_report(spark, sf_dir):
    return _report(spark, sf_dir)


@register("failures_by_check", "AGG-10 TOP-3", sql=with_(BLOCKS, REPORTS) + """
SELECT *, row_number() OVER (ORDER BY failure_count DESC, chain, layer, check_name) AS rank FROM (
SELECT chain, layer, check_name, count(*) AS failure_count, CAST(sum(failures) AS BIGINT) AS total_failures,
       max("timestamp") AS last_failure
FROM reports WHERE status = 'fail' AND "timestamp" >= TIMESTAMP '2024-01-24 00:00:00' GROUP BY chain, layer, check_name) t""")
def failures_by_check(spark, sf_dir):
    """The last seven days, most failures first."""
    f = rollup.failures_by(_report(spark, sf_dir), ["chain", "layer", "check_name"], AS_OF)
    return ordered.ranked(f, [-F.col("failure_count"), F.col("chain"), F.col("layer"), F.col("check_name")])


@register("success_rate", "AGG-11", sql=with_(BLOCKS, REPORTS) + """
SELECT chain, layer, count(*) AS total_checks, count(*) FILTER (WHERE status = 'pass') AS passes,
       count(*) FILTER (WHERE status = 'fail') AS fails, count(*) FILTER (WHERE status = 'warning') AS warnings,
       round(CAST(count(*) FILTER (WHERE status = 'pass') AS DOUBLE) / count(*) * 100, 9) AS success_rate
FROM reports WHERE "timestamp" >= TIMESTAMP '2024-01-24 00:00:00' GROUP BY chain, layer""")
def success_rate(spark, sf_dir):
    return round_doubles(rollup.success_rate(_report(spark, sf_dir), ["chain", "layer"], AS_OF))


@register("layer_status_counts", "AGG-12", sql=with_(BLOCKS, REPORTS) + """
SELECT layer, status, count(*) AS n FROM reports GROUP BY layer, status""")
def layer_status_counts(spark, sf_dir):
    return rollup.layer_counts(_report(spark, sf_dir), "layer", "status")


@register("errors_between", "DQ-10 FIL-10", sql=with_(BLOCKS, REPORTS) + """
SELECT * FROM reports WHERE status = 'fail'
  AND "timestamp" BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'""")
def errors_between(spark, sf_dir):
    return Q.errors_between(_report(spark, sf_dir), "2024-01-10 00:00:00", "2024-01-20 00:00:00")


ANOMALY_SQL = """anoms AS (
  SELECT "timestamp" AS "timestamp", 'ethereum' AS chain, "timestamp" AS data_timestamp, 'utilisation' AS field,
         round(u, 9) AS value, round(z, 9) AS z_score, round(m, 9) AS mean, round(s, 9) AS std,
         CASE WHEN z > 0 THEN 'spike' ELSE 'drop' END AS anomaly_type,
         CASE WHEN abs(z) >= 5 THEN 'high' WHEN abs(z) >= 4 THEN 'medium' WHEN abs(z) >= 3 THEN 'low' END AS severity
  FROM (SELECT "timestamp", u,
               CASE WHEN count(u) OVER w >= 60 THEN avg(u) OVER w END AS m,
               CASE WHEN count(u) OVER w >= 60 THEN stddev_samp(u) OVER w END AS s,
               CASE WHEN count(u) OVER w >= 60 THEN (u - avg(u) OVER w) / (stddev_samp(u) OVER w + 1e-10) END AS z
        FROM (SELECT number, "timestamp", gas_used / gas_limit AS u FROM blocks) b
        WINDOW w AS (ORDER BY number ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)) t
  WHERE abs(z) > 3
)"""


def _anomalies(spark, sf_dir):
    b = driver.blocks(spark, sf_dir, ["timestamp", "gas_used", "gas_limit"]).select(
        "number", "timestamp", (F.col("gas_used") / F.col("gas_limit")).alias("utilisation"))
    return Q.anomalies(b, "utilisation", "number", "timestamp", n=60, z=3.0, chain="ethereum")


@register("anomaly_report", "DQ-4 WIN-9 SNK-9", sql=with_(BLOCKS, ANOMALY_SQL) + "SELECT * FROM anoms")
def anomaly_report(spark, sf_dir):
    return round_doubles(_anomalies(spark, sf_dir))


@register("recent_anomalies", "DQ-9 TOP-3", sql=with_(BLOCKS, ANOMALY_SQL) + """
SELECT chain, data_timestamp, field, value, z_score, anomaly_type, severity,
       row_number() OVER (ORDER BY z_score DESC, data_timestamp, chain, field) AS rank FROM anoms
WHERE severity = 'medium' AND "timestamp" >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 240 HOUR""")
def recent_anomalies(spark, sf_dir):
    a = round_doubles(Q.recent_anomalies(_anomalies(spark, sf_dir), AS_OF, hours=240, severity_level="medium"))
    return ordered.ranked(a, [-F.col("z_score"), F.col("data_timestamp"), F.col("chain"), F.col("field")])


GAP_REPORT_SQL = """tgaps AS (
  SELECT prev AS gap_start, "timestamp" AS gap_end,
         (epoch_us("timestamp") - epoch_us(prev)) / 1e6 AS duration_s,
         CAST(floor(((epoch_us("timestamp") - epoch_us(prev)) / 1e6) / 300.0) - 1 AS BIGINT) AS missing_intervals
  FROM (SELECT "timestamp", lag("timestamp") OVER (ORDER BY "timestamp", number) AS prev FROM blocks) t
  WHERE (epoch_us("timestamp") - epoch_us(prev)) / 1e6 > 450
),
greports AS (
  SELECT gap_end + INTERVAL 10 MINUTE AS "timestamp", 'ethereum' AS chain, gap_start, gap_end,
         duration_s AS gap_duration_seconds, missing_intervals AS expected_records,
         CASE WHEN missing_intervals >= 2 THEN 'pending' ELSE 'completed' END AS backfill_status,
         CAST(missing_intervals AS BIGINT) AS backfill_attempts,
         CASE WHEN missing_intervals >= 2 THEN NULL ELSE gap_end + INTERVAL 1 HOUR END AS backfill_completed_at
  FROM tgaps
)"""


def _gap_reports(spark, sf_dir):
    tg = G.detect_time_gaps(driver.blocks(spark, sf_dir, ["timestamp"]), "timestamp", 300, 1.5, tiebreak=["number"])
    pending = F.col("missing_intervals") >= 2
    return Q.gap_report_rows(tg, "ethereum", F.col("gap_end") + F.expr("INTERVAL 10 MINUTES"),
                             F.when(pending, "pending").otherwise("completed"), F.col("missing_intervals"),
                             F.when(~pending, F.col("gap_end") + F.expr("INTERVAL 1 HOUR")))


@register("gap_reports", "SNK-9 GAP-2", sql=with_(BLOCKS, GAP_REPORT_SQL) + """
SELECT "timestamp", chain, gap_start, gap_end, round(gap_duration_seconds, 9) AS gap_duration_seconds,
       expected_records, backfill_status, backfill_attempts, backfill_completed_at FROM greports""")
def gap_reports(spark, sf_dir):
    return round_doubles(_gap_reports(spark, sf_dir))


@register("persistent_gaps", "GAP-7 TOP-3", sql=with_(BLOCKS, GAP_REPORT_SQL) + """
SELECT *, row_number() OVER (ORDER BY gap_hours DESC, chain, gap_start) AS rank FROM (
SELECT chain, gap_start, gap_end, round(gap_duration_seconds / 3600.0, 9) AS gap_hours, backfill_status,
       backfill_attempts, round((epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us("timestamp")) / 3.6e9, 9)
         AS hours_since_detection
FROM greports WHERE backfill_status <> 'completed' AND "timestamp" <= TIMESTAMP '2024-01-30 00:00:00') t""")
def persistent_gaps(spark, sf_dir):
    g = round_doubles(Q.persistent_gaps(_gap_reports(spark, sf_dir), AS_OF, hours=24))
    return ordered.ranked(g, [-F.col("gap_hours"), F.col("chain"), F.col("gap_start")])


@register("gap_report_filter", "FIL-10", sql=with_(BLOCKS, GAP_REPORT_SQL) + """
SELECT "timestamp", chain, gap_start, gap_end, round(gap_duration_seconds, 9) AS gap_duration_seconds,
       expected_records, backfill_status, backfill_attempts, backfill_completed_at FROM greports
WHERE chain = 'ethereum' AND backfill_status IN ('pending', 'failed') AND gap_duration_seconds >= 900""")
def gap_report_filter(spark, sf_dir):
    g = Q.report_filter(_gap_reports(spark, sf_dir), min_duration_s=900, chain="ethereum",
                        backfill_status=["pending", "failed"])
    return round_doubles(g)


@register("mempool_validation", "DQ-3 DQ-5", sql="""
WITH m AS (
  SELECT round(value / 10) + 2 AS f1, round(value / 10) + 1 AS f2, round(value / 10) AS f3, round(value / 10) - 1 AS f4,
         1.0 AS f5, CAST(date_trunc('second', ts) AS TIMESTAMP) AS "timestamp"
  FROM events
)
SELECT "timestamp", concat_ws(',',
         CASE WHEN NOT (f1 >= f2 AND f2 >= f3 AND f3 >= f4 AND f4 >= f5) THEN 'fee_order' END,
         CASE WHEN NOT (f1 BETWEEN 1 AND 1000) THEN 'fastest_fee_range' END,
         CASE WHEN NOT (f2 BETWEEN 1 AND 1000) THEN 'half_hour_fee_range' END,
         CASE WHEN NOT (f3 BETWEEN 1 AND 1000) THEN 'hour_fee_range' END,
         CASE WHEN NOT (f4 BETWEEN 1 AND 1000) THEN 'economy_fee_range' END,
         CASE WHEN NOT (f5 BETWEEN 1 AND 1000) THEN 'minimum_fee_range' END) AS errors
FROM m""")
def mempool_validation(spark, sf_dir):
    from gapseries.plans.q_sources import mempool_snapshots
    v = Q.validate_rows(mempool_snapshots(spark, sf_dir), Q.mempool_rules())
    return v.select("timestamp", F.array_join("validation.errors", ",").alias("errors"))


FLAGS_SQL = """flags AS (
  SELECT number, number - lag(number) OVER o > 1 AS has_gap,
         CASE WHEN count(u) OVER w >= 60 THEN abs((u - avg(u) OVER w) / (stddev_samp(u) OVER w + 1e-10)) > 3 END AS is_anomaly
  FROM (SELECT number, gas_used / gas_limit AS u FROM blocks) b
  WINDOW o AS (ORDER BY number), w AS (ORDER BY number ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)
)"""


@register("block_validation_flags", "DQ-5 DQ-2 DQ-7", sql=with_(BLOCKS, FLAGS_SQL) + """
SELECT number, concat_ws(',', """ + ", ".join(f"CASE WHEN {_fail_sql(s)} THEN '{n}' END" for n, _, _, s in RULES) + """) AS errors,
       coalesce(f.has_gap, false) AS has_gap, coalesce(f.is_anomaly, false) AS is_anomaly
FROM blocks b JOIN flags f USING (number)""")
def block_validation_flags(spark, sf_dir):
    """The validation record with its gap and anomaly flags: a number missing before the block, and a rolling z-score beyond 3."""
    b = driver.blocks(spark, sf_dir)
    b = b.withColumn("_u", F.col("gas_used") / F.col("gas_limit"))
    d = ordered.rolling_many(b, ["number"], [("_u", 60, "zscore")], eps=1e-10,
                             also=lambda w: {"_step": F.col("number") - F.lag("number", 1).over(w)}).drop(ordered.IDX)
    v = Q.validate_rows(d, _rules(), F.coalesce(F.col("_step") > 1, F.lit(False)), F.coalesce(F.abs("_u_zscore_60") > 3, F.lit(False)))
    return v.select("number", F.array_join("validation.errors", ",").alias("errors"), F.col("validation.has_gap").alias("has_gap"),
                    F.col("validation.is_anomaly").alias("is_anomaly"))


def _change_sql(col: str, kind: str) -> str:
    return f"""SELECT "timestamp", 'ethereum' AS chain, "timestamp" AS data_timestamp, '{col}' AS field,
       CAST({col} AS DOUBLE) AS value, round(({col} - p) / abs(p), 9) AS z_score, CAST(p AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std,
       '{kind}' AS anomaly_type,
       CASE WHEN abs(({col} - p) / abs(p)) >= 2 THEN 'high' WHEN abs(({col} - p) / abs(p)) >= 1 THEN 'medium' ELSE 'low' END AS severity
FROM (SELECT "timestamp", {col}, CAST(lag({col}) OVER (ORDER BY number) AS DOUBLE) AS p FROM blocks) t
WHERE p <> 0 AND abs(({col} - p) / abs(p)) > 0.5"""


@register("change_anomalies", "DQ-4", sql=with_(BLOCKS) + _change_sql("base_fee_per_gas", "rate_change") + " UNION ALL "
          + _change_sql("size", "volume"))
def change_anomalies(spark, sf_dir):
    """Fee jumps (rate of change) and size jumps (volume) from block to block."""
    b = driver.blocks(spark, sf_dir, ["timestamp", "base_fee_per_gas", "size"])
    return round_doubles(Q.change_anomalies(b, "base_fee_per_gas", kind="rate_change").unionByName(
        Q.change_anomalies(b, "size", kind="volume")))
