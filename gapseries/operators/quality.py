"""Layered data-quality rules and report tables (DQ-1..10, GAP-7).

A rule is a named boolean ``Column`` (true = row passes), never a Python
callable per row. Rules come from the contract (schema layer), from
domain sanity checks, or from the user (DQ-7). Reports are produced in one
aggregation pass over the data and unpivoted to one row per check.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gapseries.operators import ordered


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: Column = field(compare=False)
    message: str = ""
    layer: str = "sanity"
    severity: str = "error"


# -- rule sets -------------------------------------------------------------------

def schema_rules(contract: T.StructType, df_columns: Sequence[str]) -> list[Rule]:
    """DQ-1: required columns not NULL, ``minimum`` bounds from the contract metadata."""
    rules = []
    for f in contract.fields:
        if f.name not in df_columns:
            continue
        if not f.nullable:
            rules.append(Rule(f"{f.name}_not_null", F.col(f.name).isNotNull(), f"{f.name} is required", "schema"))
        mn = f.metadata.get("minimum") if f.metadata else None
        if mn is not None:
            rules.append(Rule(f"{f.name}_min_{mn}", F.col(f.name).isNull() | (F.col(f.name) >= F.lit(mn)),
                              f"{f.name} must be >= {mn}", "schema"))
    return rules


def schema_issues(contract: T.StructType, df: DataFrame) -> list[tuple[str, str]]:
    """DQ-1 at the schema level (metadata only): missing columns and type mismatches."""
    issues = []
    have = {f.name: f.dataType for f in df.schema.fields}
    for f in contract.fields:
        if f.name not in have:
            issues.append((f.name, "missing"))
        elif have[f.name] != f.dataType:
            issues.append((f.name, f"type {have[f.name].simpleString()} != {f.dataType.simpleString()}"))
    return issues


def block_rules(london: int, merge: int, key: str = "number") -> list[Rule]:
    """DQ-2: block sanity, era aware."""
    n = F.col(key)
    return [
        Rule("gas_used_within_limit", (F.col("gas_used") >= 0) & (F.col("gas_used") <= F.col("gas_limit")),
             "0 <= gas_used <= gas_limit"),
        Rule("size_positive", F.col("size") > 0, "size > 0"),
        Rule("tx_count_non_negative", F.col("transaction_count") >= 0, "transaction_count >= 0"),
        Rule("base_fee_after_london", (n < F.lit(london)) | (F.col("base_fee_per_gas") >= 1),
             "base fee >= 1 wei from London on"),
        Rule("difficulty_zero_after_merge", (n < F.lit(merge)) | (F.col("difficulty") == 0),
             "difficulty is 0 from the Merge on"),
    ]


def mempool_rules() -> list[Rule]:
    """DQ-3: mempool sanity: fee ordering, fees within 1..1000, non-negative counts."""
    fees = ["fastest_fee", "half_hour_fee", "hour_fee", "economy_fee", "minimum_fee"]
    order = F.lit(True)
    for a, b in zip(fees, fees[1:]):
        order = order & (F.col(a) >= F.col(b))
    rules = [Rule("fee_order", order, "fastest >= half hour >= hour >= economy >= minimum")]
    rules += [Rule(f"{c}_range", F.col(c).between(1, 1000), f"1 <= {c} <= 1000") for c in fees]
    rules += [Rule("count_non_negative", F.col("unconfirmed_count") >= 0, "unconfirmed_count >= 0"),
              Rule("vsize_non_negative", F.col("vsize_mb") >= 0, "vsize_mb >= 0")]
    return rules


def custom_rule(name: str, predicate: Column, message: str = "", layer: str = "custom",
                severity: str = "error") -> Rule:
    """DQ-7: a user rule (a Column expression)."""
    return Rule(name, predicate, message or name, layer, severity)


# -- row level -------------------------------------------------------------------

def check(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """DQ-1/2/3: one boolean column per rule (``ok_<name>``); NULL counts as failed."""
    return df.select("*", *[F.coalesce(r.predicate, F.lit(False)).alias(f"ok_{r.name}") for r in rules])


def check_schema(df: DataFrame, contract: T.StructType) -> DataFrame:
    """DQ-1: per-row schema-layer flags derived from the contract."""
    return check(df, schema_rules(contract, df.columns))


def check_sanity(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """DQ-2 / DQ-3: per-row sanity flags for a rule set (``block_rules`` / ``mempool_rules``)."""
    return check(df, rules)


def validate_rows(df: DataFrame, rules: Sequence[Rule], gap_flag: Column | None = None,
                  anomaly_flag: Column | None = None) -> DataFrame:
    """DQ-5: per-row validation record ``validation = struct(valid, errors, has_gap, is_anomaly)``."""
    failed = F.array_compact(F.array(*[F.when(~F.coalesce(r.predicate, F.lit(False)), F.lit(r.name))
                                       for r in rules]))
    rec = F.struct(
        (F.size(failed) == 0).alias("valid"), failed.alias("errors"),
        (gap_flag if gap_flag is not None else F.lit(None).cast("boolean")).alias("has_gap"),
        (anomaly_flag if anomaly_flag is not None else F.lit(None).cast("boolean")).alias("is_anomaly"))
    return df.withColumn("validation", rec)


# -- reports ---------------------------------------------------------------------

def report(df: DataFrame, rules: Sequence[Rule], as_of, chain: str, ts: str = "timestamp", by=None,
           tolerance: float = 0.0, run_ts: Column | None = None) -> DataFrame:
    """DQ-6: validation report rows, one per check (and per ``by`` group).

    ``status`` is ``pass`` with no failure, ``warning`` while the failure
    share is within ``tolerance``, else ``fail``. ``context`` is JSON.
    One aggregation computes every rule; an array of structs unpivots.
    """
    by = [by] if isinstance(by, str) else list(by or [])
    aggs = [F.count(F.lit(1)).alias("_records"), F.min(ts).alias("_t0"), F.max(ts).alias("_t1")]
    aggs += [F.count_if(~F.coalesce(r.predicate, F.lit(False))).alias(f"_f{i}") for i, r in enumerate(rules)]
    wide = df.groupBy(*by).agg(*aggs)
    each = [F.struct(F.lit(r.name).alias("check_name"), F.lit(r.layer).alias("layer"), F.lit(r.message).alias("message"),
                     F.col(f"_f{i}").alias("failures")) for i, r in enumerate(rules)]
    long = wide.select(*by, "_records", "_t0", "_t1", F.explode(F.array(*each)).alias("_r")).select(
        *by, "_records", "_t0", "_t1", "_r.*")
    share = F.try_divide(F.col("failures"), F.col("_records"))
    status = (F.when(F.col("failures") == 0, "pass").when(share <= F.lit(tolerance), "warning").otherwise("fail"))
    when = run_ts if run_ts is not None else (F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else F.lit(as_of))
    return long.select(
        when.alias("timestamp"), F.lit(chain).alias("chain"), "layer", status.alias("status"), "check_name",
        "message",
        F.to_json(F.struct(F.col("failures"), F.col("_records").alias("records"),
                           *[F.col(b) for b in by])).alias("context"),
        F.col("_t0").alias("data_timestamp_start"), F.col("_t1").alias("data_timestamp_end"),
        F.col("_records").alias("records_validated"), F.col("failures").cast("bigint").alias("failures"),
        F.lit(None).cast("double").alias("execution_time_ms"),
    )


SEVERITY_BANDS = (3.0, 4.0, 5.0)   # |z| >= 3 low, >= 4 medium, >= 5 high (parameter)


def severity(z: Column, bands: tuple[float, float, float] = SEVERITY_BANDS) -> Column:
    az = F.abs(z)
    return F.when(az >= bands[2], "high").when(az >= bands[1], "medium").when(az >= bands[0], "low")


def anomalies(df: DataFrame, col: str, order: str = "number", ts: str = "timestamp", n: int = 60,
              z: float = 3.0, chain: str = "ethereum", as_of=None, eps: float = 1e-10,
              bands: tuple[float, float, float] = SEVERITY_BANDS, bucket_rows: int | None = None) -> DataFrame:
    """DQ-4: rolling z-score anomalies → anomaly report rows (spike / drop)."""
    kw = {"bucket_rows": bucket_rows} if bucket_rows else {}
    r = ordered.rolling_many(df.select(order, ts, col), [order], [(col, n, fn) for fn in ("mean", "std", "zscore")], eps=eps, **kw)
    r = r.withColumnsRenamed({f"{col}_mean_{n}": "_mean", f"{col}_std_{n}": "_std", f"{col}_zscore_{n}": "_z"})
    r = r.filter(F.abs(F.col("_z")) > F.lit(z))
    when = F.lit(as_of).cast("timestamp") if as_of is not None else F.col(ts)
    return r.select(when.alias("timestamp"), F.lit(chain).alias("chain"), F.col(ts).alias("data_timestamp"),
                    F.lit(col).alias("field"), F.col(col).cast("double").alias("value"),
                    F.col("_z").alias("z_score"), F.col("_mean").alias("mean"), F.col("_std").alias("std"),
                    F.when(F.col("_z") > 0, "spike").otherwise("drop").alias("anomaly_type"),
                    severity(F.col("_z"), bands).alias("severity"))


def gap_report_rows(time_gaps: DataFrame, chain: str, detected: Column, status: Column,
                    attempts: Column, completed_at: Column) -> DataFrame:
    """Gap report table rows (schema of the gap report) from detected time gaps."""
    return time_gaps.select(
        detected.alias("timestamp"), F.lit(chain).alias("chain"), "gap_start", "gap_end",
        F.col("duration_s").alias("gap_duration_seconds"),
        F.col("missing_intervals").alias("expected_records"), status.alias("backfill_status"),
        attempts.cast("bigint").alias("backfill_attempts"), completed_at.alias("backfill_completed_at"))


def persistent_gaps(gap_reports: DataFrame, as_of, hours: float = 24) -> DataFrame:
    """GAP-7 / TOP-3: gaps not backfilled within ``hours`` of detection, largest first."""
    now = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else F.lit(as_of)
    cutoff = now - F.expr(f"INTERVAL {int(hours * 3600)} SECONDS")
    g = gap_reports.filter((F.col("backfill_status") != "completed") & (F.col("timestamp") <= cutoff))
    return g.select("chain", "gap_start", "gap_end", (F.col("gap_duration_seconds") / 3600.0).alias("gap_hours"),
                    "backfill_status", "backfill_attempts",
                    ((F.unix_micros(now) - F.unix_micros(F.col("timestamp"))) / F.lit(3.6e9))
                    .alias("hours_since_detection")).orderBy(F.desc("gap_hours"), "chain", "gap_start")


def recent_anomalies(anoms: DataFrame, as_of, hours: float = 1, severity_level: str = "high") -> DataFrame:
    """DQ-9 / TOP-3: anomalies of a severity detected in the last ``hours``, by z descending."""
    now = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else F.lit(as_of)
    lo = now - F.expr(f"INTERVAL {int(hours * 3600)} SECONDS")
    return (anoms.filter((F.col("severity") == severity_level) & (F.col("timestamp") >= lo))
            .select("chain", "data_timestamp", "field", "value", "z_score", "anomaly_type", "severity")
            .orderBy(F.desc("z_score"), "data_timestamp", "chain", "field"))


def change_anomalies(df: DataFrame, col: str, order: str = "number", ts: str = "timestamp", jump: float = 0.5,
                     chain: str = "ethereum", kind: str = "rate_change", as_of=None,
                     bands: tuple[float, float, float] = (0.5, 1.0, 2.0)) -> DataFrame:
    """DQ-4: sudden changes from one row to the next → anomaly report rows.

    ``rate_change`` (prices, fees) and ``volume`` (sizes, counts) flag a relative
    change of more than ``jump``; ``z_score`` holds the change, ``mean`` the
    value before, the severity follows ``bands`` of the change. A step from
    zero has no relative change and is not flagged.
    """
    d = ordered.with_prev(df.select(order, ts, col), order, [col], prefix="_p_")
    change = F.try_divide(F.col(col) - F.col("_p_" + col), F.abs(F.col("_p_" + col)))
    d = d.withColumn("_chg", change).filter(F.abs("_chg") > F.lit(jump))
    when = F.col(ts) if as_of is None else F.lit(as_of).cast("timestamp")
    return d.select(when.alias("timestamp"), F.lit(chain).alias("chain"), F.col(ts).alias("data_timestamp"),
                    F.lit(col).alias("field"), F.col(col).cast("double").alias("value"), F.col("_chg").cast("double").alias("z_score"),
                    F.col("_p_" + col).cast("double").alias("mean"), F.lit(None).cast("double").alias("std"),
                    F.lit(kind).alias("anomaly_type"), severity(F.col("_chg"), bands).alias("severity"))


def errors_between(reports: DataFrame, t0, t1) -> DataFrame:
    """DQ-10: failed checks of runs in ``[t0, t1]``."""
    return reports.filter((F.col("status") == "fail")
                          & F.col("timestamp").between(F.lit(t0).cast("timestamp"), F.lit(t1).cast("timestamp")))


def report_filter(df: DataFrame, min_duration_s: float | None = None, since=None, **eq) -> DataFrame:
    """FIL-10: equality filters on report columns, optional minimum gap duration and start time."""
    out = df
    for k, v in eq.items():
        out = out.filter(F.col(k).isin(*v) if isinstance(v, (list, tuple, set)) else F.col(k) == F.lit(v))
    if min_duration_s is not None:
        out = out.filter(F.col("gap_duration_seconds") >= F.lit(min_duration_s))
    if since is not None:
        out = out.filter(F.col("timestamp") >= F.lit(since).cast("timestamp"))
    return out
