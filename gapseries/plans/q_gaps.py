"""Gap detection, lifecycle, freshness and health plans over the block table."""

from pyspark.sql import functions as F

from gapseries.operators import gaps as G
from gapseries.plans.registry import register
from gapseries.plans.sqlviews import BLOCKS, RAW_BLOCKS, SOURCES, with_
from gapseries.sources import driver

AS_OF = "2024-01-31 00:00:00"
AS_OF_SQL = f"TIMESTAMP '{AS_OF}'"


def _gaps_sql(src: str, name: str = "gaps") -> str:
    return f"""{name} AS (
  SELECT prev + 1 AS gap_start, number - 1 AS gap_end, CAST(number - prev - 1 AS BIGINT) AS gap_size FROM (
    SELECT number, lag(number) OVER (ORDER BY number) AS prev FROM {src}) t WHERE number - prev > 1
)"""


GAPS = _gaps_sql("blocks")

STATS_SQL = """SELECT count(*) AS total_rows, min(number) AS min_key, max(number) AS max_key,
       CAST(COALESCE(max(number) - min(number) + 1, 0) AS BIGINT) AS expected,
       CAST(COALESCE(max(number) - min(number) + 1, 0) - count(*) AS BIGINT) AS missing
FROM blocks"""


@register("gap_report", "AGG-1 AGG-2 GAP-1", sql=with_(BLOCKS, GAPS) + f"""
SELECT s.*, l.latest_ts, g.gap_regions, g.largest_gap, g.missing_in_gaps
FROM ({STATS_SQL}) s,
     (SELECT max("timestamp") AS latest_ts FROM blocks) l,
     (SELECT count(*) AS gap_regions, CAST(COALESCE(max(gap_size), 0) AS BIGINT) AS largest_gap,
             CAST(COALESCE(sum(gap_size), 0) AS BIGINT) AS missing_in_gaps FROM gaps) g""")
def gap_report(spark, sf_dir):
    return G.gap_report(driver.blocks(spark, sf_dir, ["timestamp"]))


def _keys(spark, sf_dir):
    # every stored version: duplicates are free in the bitmaps, so nothing is deduplicated first
    return driver.raw_blocks(spark, sf_dir).select("number")


@register("detect_gaps", "GAP-1 WIN-1", sql=with_(BLOCKS, GAPS) + "SELECT * FROM gaps")
def detect_gaps(spark, sf_dir):
    return G.detect_gaps(_keys(spark, sf_dir), "number")


@register("detect_gaps_head", "GAP-1 T8", sql=with_(BLOCKS, GAPS) + """
SELECT * FROM gaps
UNION ALL
SELECT CAST(-5 AS BIGINT) AS gap_start, min(number) - 1 AS gap_end, CAST(min(number) + 5 AS BIGINT) AS gap_size
FROM blocks HAVING min(number) > -5""")
def detect_gaps_head(spark, sf_dir):
    # explicit expected first key: a true head gap before the first block
    return G.detect_gaps(_keys(spark, sf_dir), "number", expected_start=-5)


@register("largest_gaps", "TOP-2", sql=with_(BLOCKS, GAPS) + """
SELECT * FROM gaps ORDER BY gap_size DESC, gap_start ASC LIMIT 20""")
def largest_gaps(spark, sf_dir):
    return G.largest_gaps(G.detect_gaps(_keys(spark, sf_dir)), 20)


@register("split_gaps", "GAP-6", sql=with_(BLOCKS, GAPS) + """
SELECT *, CASE WHEN gap_size <= 2 THEN 'inline' ELSE 'deferred' END AS handling FROM gaps""")
def split_gaps(spark, sf_dir):
    return G.split_gaps(G.detect_gaps(_keys(spark, sf_dir)), inline_max=2)


@register("missing_keys", "JN-6 GAP-3", sql=with_(BLOCKS, GAPS) + """
SELECT CAST(unnest(generate_series(gap_start, gap_end)) AS BIGINT) AS number FROM gaps""")
def missing_keys(spark, sf_dir):
    return G.missing_keys(_keys(spark, sf_dir), "number")


TIME_GAPS = """tgaps AS (
  SELECT prev AS gap_start, "timestamp" AS gap_end,
         (epoch_us("timestamp") - epoch_us(prev)) / 1e6 AS duration_s,
         CAST(floor(((epoch_us("timestamp") - epoch_us(prev)) / 1e6) / 300.0) - 1 AS BIGINT) AS missing_intervals
  FROM (SELECT "timestamp", lag("timestamp") OVER (ORDER BY "timestamp", number) AS prev FROM blocks) t
  WHERE (epoch_us("timestamp") - epoch_us(prev)) / 1e6 > 450
)"""


@register("time_gaps", "GAP-2 WIN-16", sql=with_(BLOCKS, TIME_GAPS) + "SELECT * FROM tgaps")
def time_gaps(spark, sf_dir):
    return G.detect_time_gaps(driver.blocks(spark, sf_dir, ["timestamp"]), "timestamp", interval_s=300, threshold=1.5,
                              tiebreak=["number"])


@register("expand_time_gaps", "GAP-3 FIL-12", sql=with_(BLOCKS, TIME_GAPS) + """
SELECT gap_start, unnest(generate_series(gap_start + INTERVAL 300 SECOND, gap_end - INTERVAL 1 MICROSECOND,
                                         INTERVAL 300 SECOND)) AS ts
FROM tgaps""")
def expand_time_gaps(spark, sf_dir):
    g = G.detect_time_gaps(driver.blocks(spark, sf_dir, ["timestamp"]), "timestamp", interval_s=300, threshold=1.5,
                           tiebreak=["number"])
    return G.expand_time_gaps(g, 300)


@register("duplicates", "AGG-5", sql=with_(RAW_BLOCKS) + """
SELECT number, count(*) AS copies FROM raw_blocks GROUP BY number HAVING count(*) > 1""")
def duplicates(spark, sf_dir):
    return G.duplicates(driver.raw_blocks(spark, sf_dir), "number")


@register("completeness", "AGG-2 AGG-1", sql=with_(BLOCKS) + STATS_SQL)
def completeness(spark, sf_dir):
    return G.completeness(driver.blocks(spark, sf_dir, ["number"]))


@register("distinct_keys", "AGG-2 AGG-5", sql=with_(RAW_BLOCKS) + """
SELECT transaction_count % 4 AS part, count(DISTINCT number) AS keys, min(number) AS min_key, max(number) AS max_key FROM raw_blocks GROUP BY 1""")
def distinct_keys(spark, sf_dir):
    """Exact distinct block numbers per part of the raw versions, by bitmap."""
    raw = driver.raw_blocks(spark, sf_dir).select("number", (F.col("transaction_count") % 4).alias("part"))
    return G.distinct_keys(raw, "number", by="part")


@register("gaps_by_part", "GAP-1 JN-6", sql=with_(RAW_BLOCKS) + """
SELECT k, prev + 1 AS gap_start, number - 1 AS gap_end, CAST(number - prev - 1 AS BIGINT) AS gap_size FROM (
  SELECT k, number, lag(number) OVER (PARTITION BY k ORDER BY number) AS prev
  FROM (SELECT DISTINCT number, CASE WHEN number % 3 <> 0 THEN number % 3 END AS k FROM raw_blocks WHERE number % 7 < 5) d) t
WHERE number - prev > 1""")
def gaps_by_part(spark, sf_dir):
    """Gaps of several interleaved series, one of them without a key."""
    raw = driver.raw_blocks(spark, sf_dir).select("number").filter(F.col("number") % 7 < 5)
    k = F.col("number") % 3
    return G.detect_gaps(raw.withColumn("k", F.when(k != 0, k)), "number", by="k", width=1000)


FRESH_SQL = f"""SELECT max("timestamp") AS latest_ts, max(number) AS latest_key,
       CAST(floor((epoch_us({AS_OF_SQL}) - epoch_us(max("timestamp"))) / 1e6) AS BIGINT) AS age_s
FROM blocks"""


@register("freshness", "AGG-3 FN-25", sql=with_(BLOCKS) + f"""
SELECT latest_ts, latest_key, age_s, age_s <= 960 AS is_fresh,
       CASE WHEN age_s < 60 THEN 'GOOD' WHEN age_s < 300 THEN 'OK' ELSE 'STALE' END AS band,
       CAST(floor(age_s * 100 / 960) AS BIGINT) AS staleness_pct, 960 - age_s AS margin_s
FROM ({FRESH_SQL}) f""")
def freshness(spark, sf_dir):
    return G.freshness(driver.blocks(spark, sf_dir, ["timestamp"]), "timestamp", AS_OF, threshold_s=960)


# ---- lifecycle -------------------------------------------------------------
# Tracked state from an earlier run over the primary source only: first seen
# 900 s per missing block before as_of (size 2 sits exactly on the grace
# boundary), already notified from size 5.

STATE_SQL = f"""state AS (
  SELECT gap_start, gap_end, gap_size,
         {AS_OF_SQL} - to_seconds(gap_size * 900) AS first_seen,
         {AS_OF_SQL} - INTERVAL 300 SECOND AS last_seen,
         gap_size >= 5 AS notified
  FROM pgaps
)"""

EVENTS_SQL = f"""events AS (
  SELECT COALESCE(c.gap_start, t.gap_start) AS gap_start, COALESCE(c.gap_end, t.gap_end) AS gap_end,
         CAST(COALESCE(c.gap_size, t.gap_size) AS BIGINT) AS gap_size,
         COALESCE(t.first_seen, {AS_OF_SQL}) AS first_seen,
         CASE WHEN t.gap_start IS NULL THEN CAST(0 AS BIGINT)
              ELSE CAST(floor((epoch_us({AS_OF_SQL}) - epoch_us(t.first_seen)) / 1e6) AS BIGINT) END AS age_s,
         CASE WHEN t.gap_start IS NULL THEN 'NEW'
              WHEN c.gap_start IS NULL THEN 'RESOLVED'
              WHEN t.notified THEN 'NOTIFIED'
              WHEN epoch_us({AS_OF_SQL}) - epoch_us(t.first_seen) > 1800 * 1000000 THEN 'PERSISTENT'
              ELSE 'GRACE' END AS status,
         t.notified AS t_notified
  FROM gaps c FULL OUTER JOIN state t ON c.gap_start = t.gap_start AND c.gap_end = t.gap_end
)"""

LIFECYCLE_CTES = (BLOCKS, SOURCES, GAPS, _gaps_sql("src_primary", "pgaps"), STATE_SQL, EVENTS_SQL)


def _state(spark, sf_dir):
    pg = G.detect_gaps(driver.source_blocks(spark, sf_dir, "primary"))
    now_us = F.unix_micros(F.lit(AS_OF).cast("timestamp"))
    return pg.select("gap_start", "gap_end", "gap_size",
                     F.timestamp_micros(now_us - F.col("gap_size") * F.lit(900_000_000)).alias("first_seen"),
                     F.timestamp_micros(now_us - F.lit(300_000_000)).alias("last_seen"),
                     (F.col("gap_size") >= 5).alias("notified"))


def _lifecycle(spark, sf_dir):
    cur = G.detect_gaps(driver.blocks(spark, sf_dir, ["number"]))
    return G.update_gap_state(cur, _state(spark, sf_dir), AS_OF, grace_s=1800)


@register("gap_lifecycle_events", "GAP-4 JN-5", sql=with_(*LIFECYCLE_CTES) + """
SELECT gap_start, gap_end, gap_size, first_seen, age_s, status FROM events""")
def gap_lifecycle_events(spark, sf_dir):
    return _lifecycle(spark, sf_dir)[1]


@register("gap_state_next", "GAP-4 JN-5 T10", sql=with_(*LIFECYCLE_CTES) + f"""
SELECT gap_start, gap_end, gap_size, first_seen, {AS_OF_SQL} AS last_seen,
       COALESCE(t_notified, false) OR status = 'PERSISTENT' AS notified
FROM events WHERE status <> 'RESOLVED'""")
def gap_state_next(spark, sf_dir):
    return _lifecycle(spark, sf_dir)[0]


@register("new_gaps", "SET-3", sql=with_(*LIFECYCLE_CTES) + """
SELECT * FROM gaps c WHERE NOT EXISTS (SELECT 1 FROM state t WHERE t.gap_start = c.gap_start AND t.gap_end = c.gap_end)""")
def new_gaps(spark, sf_dir):
    return G.new_gaps(G.detect_gaps(driver.blocks(spark, sf_dir, ["number"])), _state(spark, sf_dir))


@register("resolved_gaps", "SET-2", sql=with_(*LIFECYCLE_CTES) + """
SELECT * FROM state t WHERE NOT EXISTS (SELECT 1 FROM gaps c WHERE t.gap_start = c.gap_start AND t.gap_end = c.gap_end)""")
def resolved_gaps(spark, sf_dir):
    return G.resolved(_state(spark, sf_dir), G.detect_gaps(driver.blocks(spark, sf_dir, ["number"])))


HEALTH_SQL = f"""health AS (
  SELECT s.*, f.latest_ts, f.latest_key, f.age_s, f.age_s <= 960 AS is_fresh,
         CASE WHEN f.age_s < 60 THEN 'GOOD' WHEN f.age_s < 300 THEN 'OK' ELSE 'STALE' END AS band,
         CAST(floor(f.age_s * 100 / 960) AS BIGINT) AS staleness_pct, 960 - f.age_s AS margin_s,
         e.new_gaps, e.persistent_gaps, e.resolved_gaps, e.open_over_grace,
         s.missing = 0 AND f.age_s < 300 AS verification_passed,
         f.age_s <= 960 AND e.open_over_grace = 0 AS healthy
  FROM ({STATS_SQL}) s, ({FRESH_SQL}) f,
       (SELECT count(*) FILTER (WHERE status = 'NEW') AS new_gaps,
               count(*) FILTER (WHERE status IN ('PERSISTENT', 'NOTIFIED')) AS persistent_gaps,
               count(*) FILTER (WHERE status = 'RESOLVED') AS resolved_gaps,
               count(*) FILTER (WHERE status IN ('NEW', 'GRACE', 'PERSISTENT', 'NOTIFIED') AND age_s > 1800)
                 AS open_over_grace
        FROM events) e
)"""


def _health(spark, sf_dir):
    ev = _lifecycle(spark, sf_dir)[1]
    return G.health(driver.blocks(spark, sf_dir, ["timestamp"]), ev, AS_OF, threshold_s=960), ev


@register("health", "AGG-4 T23", sql=with_(*LIFECYCLE_CTES, HEALTH_SQL) + "SELECT * FROM health")
def health(spark, sf_dir):
    return _health(spark, sf_dir)[0]


@register("alerts", "GAP-5", sql=with_(*LIFECYCLE_CTES, HEALTH_SQL) + """
SELECT CASE WHEN status = 'PERSISTENT' THEN 'PERSISTENT GAP' ELSE 'GAP RESOLVED' END AS title,
       CASE WHEN status = 'PERSISTENT' THEN 2 ELSE 0 END AS priority,
       printf('blocks %d to %d, size %d, first seen %s, age %d min', gap_start, gap_end, gap_size,
              strftime(first_seen, '%Y-%m-%d %H:%M:%S'), CAST(floor(age_s / 60) AS BIGINT)) AS message
FROM events WHERE status IN ('PERSISTENT', 'RESOLVED')
UNION ALL
SELECT 'DATA STALE', 2, printf('latest %d, age %ds, threshold %ds', latest_key, age_s, 960) FROM health WHERE NOT is_fresh
UNION ALL
SELECT 'HEALTHY', 0, printf('rows %d, range %d to %d, age %ds (%d%%), margin %ds', total_rows, min_key, max_key,
                            age_s, staleness_pct, margin_s)
FROM health WHERE healthy AND NOT is_fresh = false AND
  (SELECT count(*) FROM events WHERE status IN ('PERSISTENT', 'RESOLVED')) = 0""")
def alerts(spark, sf_dir):
    h, ev = _health(spark, sf_dir)
    return G.alerts(ev, h)


@register("fill_from_backfill", "JN-7 SET-5", sql=with_(SOURCES, _gaps_sql("src_primary", "pgaps")) + """
SELECT b.* FROM src_backfill b
WHERE b.number IN (SELECT unnest(generate_series(gap_start, gap_end)) FROM pgaps)""")
def fill_from_backfill(spark, sf_dir):
    missing = G.missing_keys(driver.source_blocks(spark, sf_dir, "primary"))
    return G.fill_from(missing, driver.source_blocks(spark, sf_dir, "backfill"))


@register("backfill_stats", "GAP-9", sql=with_(SOURCES, _gaps_sql("src_primary", "pgaps")) + """
SELECT count(*) AS total, count(b.number) AS success, count(*) - count(b.number) AS failed
FROM (SELECT unnest(generate_series(gap_start, gap_end)) AS number FROM pgaps) m
LEFT JOIN (SELECT DISTINCT number FROM src_backfill) b ON m.number = b.number""")
def backfill_stats(spark, sf_dir):
    missing = G.missing_keys(driver.source_blocks(spark, sf_dir, "primary"))
    filled = G.fill_from(missing, driver.source_blocks(spark, sf_dir, "backfill"))
    return G.backfill_stats(missing, filled)
