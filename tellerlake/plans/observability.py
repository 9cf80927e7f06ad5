"""Metrics, alerts, anomalies and dashboard tables over run logs and quality results.

Run logs and metric tables hold one row per run, table and day; windows over them are bounded by
the calendar.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tellerlake.functions.measures import pct
from tellerlake.operators.windows import dod_change, rolling_band, top_n_per
from tellerlake.quality.engine import rule_pass_rate

# Default alert thresholds as (metric, comparison, limit, severity).
THRESHOLDS = (
    ("PipelineFailures", ">=", 1.0, "critical"),
    ("PipelineDurationSeconds", ">", 1800.0, "critical"),
    ("FailedJobsPerHour", ">=", 2.0, "critical"),
    ("JobDurationSeconds", ">", 600.0, "warning"),
    ("DQPassRate", "<", 95.0, "warning"),
    ("QuarantinedRows", ">", 50.0, "warning"),
    ("WarehouseLoadFailed", ">=", 1.0, "warning"),
    ("FailedSharePct", ">", 5.0, "alert"),
    ("DailySuccess", "tracked", 0.0, "info"),
    ("SilverRows", "tracked", 0.0, "info"),
    ("GoldRows", "tracked", 0.0, "info"),
)
# Runs should end within this time.
SLA_SECONDS = 1500

METRIC_COLUMNS = ["metric", "table_name", "day", "value"]


def thresholds_df(spark: SparkSession, rows: tuple = THRESHOLDS) -> DataFrame:
    return spark.createDataFrame(list(rows), "metric string, comparison string, limit_value double, severity string")


def long_metrics(df: DataFrame, columns: dict[str, str], table: str = "table_name", day: str = "day") -> DataFrame:
    """Turn measure columns into rows (metric, table_name, day, value) in one pass."""
    pairs = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value")) for m, c in columns.items()]
    )
    exploded = df.select(F.col(table).alias("table_name"), F.col(day).alias("day"), F.explode(pairs).alias("m"))
    return exploded.select("m.metric", "table_name", "day", "m.value")


def metrics(outcomes: DataFrame, row_results: DataFrame, run_log: DataFrame | None = None) -> DataFrame:
    """Quality, row and duration metrics of the runs.

    ``outcomes`` are rule outcomes, ``row_results`` has table_name, day, evaluated_rows, failed_rows,
    ``run_log`` is the run log.
    """
    by_rule = rule_pass_rate(outcomes).join(outcomes.groupBy("table_name").agg(F.max("run_date").alias("day")), "table_name")
    rows = row_results.withColumns(
        {
            "pass_rate": pct(F.col("evaluated_rows") - F.col("failed_rows"), F.col("evaluated_rows")),
            "failed_share": pct(F.col("failed_rows"), F.col("evaluated_rows")),
        }
    )
    parts = [
        long_metrics(by_rule, {"DQRulesPassed": "rules_passed", "DQRulesFailed": "rules_failed"}),
        long_metrics(
            rows,
            {
                "RowsProcessed": "evaluated_rows",
                "QuarantinedRows": "failed_rows",
                "DQPassRate": "pass_rate",
                "FailedSharePct": "failed_share",
            },
        ),
    ]
    if run_log is not None:
        steps = run_log.groupBy(F.col("step").alias("table_name"), F.to_date("run_ts").alias("day")).agg(
            F.max("duration_s").alias("seconds")  # the longest run: many short ones raise no alarm
        )
        parts.append(long_metrics(steps, {"JobDurationSeconds": "seconds"}))
    return reduce(DataFrame.unionByName, parts)


def run_spans(run_log: DataFrame) -> DataFrame:
    """Whole runs: first start to last end of their steps, and whether any step failed.

    ``run_log`` has batch_id, started_at, duration_s and status.
    """
    ends = F.col("started_at").cast("double") + F.col("duration_s")
    return run_log.groupBy("batch_id").agg(
        F.to_date(F.min("started_at")).alias("day"),
        F.round(F.max(ends) - F.min(F.col("started_at").cast("double")), 3).alias("seconds"),
        F.count_if(F.col("status") == "FAILED").alias("failed_steps"),
    )


def whole_run_metrics(run_log: DataFrame) -> DataFrame:
    """Metrics of whole runs per day, under the table name ``pipeline``.

    Failed and succeeded runs, the longest run, the most failures in any sliding hour, failed warehouse steps, and
    the rows that silver and gold steps wrote.
    """
    runs = run_spans(run_log).groupBy("day").agg(
        F.count_if(F.col("failed_steps") > 0).alias("failed_runs"), F.count_if(F.col("failed_steps") == 0).alias("good_runs"), F.max("seconds").alias("seconds"),
    )
    hours = failure_bursts(run_log, "started_at", least=1).groupBy(F.to_date("window_start").alias("day")).agg(F.max("failures").alias("worst_hour"))
    good = F.col("status") == "SUCCESS"
    steps = run_log.groupBy(F.to_date("started_at").alias("day")).agg(
        F.count_if((F.col("phase") == "warehouse") & (F.col("status") == "FAILED")).alias("warehouse_failed"),
        F.sum(F.when(good & (F.col("phase") == "silver"), F.col("rows")).otherwise(0)).alias("silver_rows"),
        F.sum(F.when(good & (F.col("phase") == "gold"), F.col("rows")).otherwise(0)).alias("gold_rows"),
    )
    named = [
        (runs, {"PipelineFailures": "failed_runs", "PipelineDurationSeconds": "seconds", "DailySuccess": "good_runs"}),
        (hours, {"FailedJobsPerHour": "worst_hour"}),
        (steps, {"WarehouseLoadFailed": "warehouse_failed", "SilverRows": "silver_rows", "GoldRows": "gold_rows"}),
    ]
    return reduce(DataFrame.unionByName, [long_metrics(df.withColumn("table_name", F.lit("pipeline")), columns) for df, columns in named])


def alerts(metric_rows: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Metrics beyond their threshold, with severity. The threshold table has a few fixed rows."""
    v, t = F.col("value"), F.col("limit_value")
    comparison = F.col("comparison")
    breached = (
        ((comparison == ">") & (v > t)) | ((comparison == ">=") & (v >= t)) | ((comparison == "<") & (v < t))
    )
    return metric_rows.join(F.broadcast(thresholds), "metric").filter(breached)


def dense_days(daily: DataFrame, metric: str = "value", until: str | None = None) -> DataFrame:
    """One row per table and calendar day, 0 where a table got nothing, from its first day to its last.

    ``until`` names a last day for all tables, so that a table that stopped altogether is seen too.
    """
    last = F.max("day") if until is None else F.greatest(F.max("day"), F.lit(until).cast("date"))
    spans = daily.groupBy("table_name").agg(F.min("day").alias("_lo"), last.alias("_hi"))
    calendar = spans.select("table_name", F.explode(F.sequence("_lo", "_hi")).alias("day"))
    return calendar.join(daily, ["table_name", "day"], "left").withColumn(metric, F.coalesce(metric, F.lit(0).cast(daily.schema[metric].dataType)))


def row_anomalies(
    daily: DataFrame, metric: str = "value", days: int = 14, sigmas: float = 2.0, min_days: int = 7, upper_only: bool = False
) -> DataFrame:
    """Days whose value leaves the band of the days before; silent while history is short.

    ``daily`` has table_name, day and the metric, one row per table and day.
    """
    banded = rolling_band(daily, ["table_name"], "day", metric, days, sigmas)
    value = F.col(metric).cast("double")
    outside = value > F.col("upper_bound")
    if not upper_only:
        outside = outside | (value < F.col("lower_bound"))
    return banded.withColumn("is_anomaly", ((F.col("baseline_days") >= min_days) & F.coalesce(outside, F.lit(False))).cast("int"))


def duration_anomalies(daily: DataFrame, metric: str = "value", days: int = 14, sigmas: float = 2.0) -> DataFrame:
    return row_anomalies(daily, metric, days, sigmas, upper_only=True)


def deviation(daily: DataFrame, metric: str, drop_pct: float = 20.0, baseline_pct: float = 10.0, days: int = 14) -> DataFrame:
    """Days that fall by ``drop_pct`` against the day before or leave the baseline by ``baseline_pct``; any value leaves a baseline of 0."""
    steps = dod_change(daily, ["table_name"], "day", metric)
    banded = rolling_band(steps, ["table_name"], "day", metric, days)
    away = F.abs(F.col(metric) - F.col("baseline_mean")) * 100.0 / F.nullif("baseline_mean", F.lit(0.0))
    return banded.withColumns(
        {
            "dropped": F.coalesce((F.col("change_pct") <= -drop_pct).cast("int"), F.lit(0)),
            "off_baseline": F.coalesce(F.when(F.col("baseline_mean") == 0, F.col(metric) != 0).otherwise(away > baseline_pct), F.lit(False)).cast("int"),
        }
    )


def alert_rows(anomalies: DataFrame, metric: str = "value") -> DataFrame:
    """Anomalous days with the expected range as text."""
    low, high = F.round("lower_bound", 0).cast("bigint"), F.round("upper_bound", 0).cast("bigint")
    return anomalies.filter("is_anomaly = 1").select(
        "table_name",
        "day",
        F.col(metric).alias("value"),
        F.concat(low.cast("string"), F.lit("-"), high.cast("string")).alias("expected_range"),
    )


def failure_bursts(events: DataFrame, ts: str = "ts", window: str = "1 hour", slide: str = "5 minutes", least: int = 2) -> DataFrame:
    """Sliding windows with at least ``least`` failed jobs.

    Failures are first counted per slide step, so each row is copied into windows only after that.
    """
    failures = events.filter(F.col("status") == "FAILED")
    steps = failures.groupBy(F.window(ts, slide).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    placed = steps.select(F.window(F.col("w.start"), window, slide).alias("w"), "n")
    return (
        placed.groupBy("w").agg(F.sum("n").alias("failures"))
        .filter(F.col("failures") >= least)
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "failures")
    )


def concurrent_runs(runs: DataFrame, start: str = "run_ts", seconds: str = "duration_s") -> DataFrame:
    """Per day with a start: the most runs at work at the same time, and when that was first reached.

    A run works from its start up to, but not at, its end. Starts and ends are summed per moment, then per day; the
    days' sums carry over what runs past midnight, so each day is swept on its own and no run is paired with another.
    """
    begin = F.col(start).cast("timestamp")
    end = F.timestamp_seconds(begin.cast("double") + F.col(seconds))
    moves = runs.filter(F.col(seconds) > 0).select(F.explode(F.array(F.struct(begin.alias("at"), F.lit(1).alias("step"), F.lit(1).alias("started")), F.struct(end.alias("at"), F.lit(-1).alias("step"), F.lit(0).alias("started")))).alias("m"))
    moments = moves.groupBy(F.col("m.at").alias("at")).agg(F.sum("m.step").alias("step"), F.sum("m.started").alias("started")).withColumn("day", F.to_date("at"))
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    days = moments.groupBy("day").agg(F.sum("step").alias("net"), F.sum("started").alias("starts"))
    carried = days.withColumn("carried", F.coalesce(F.sum("net").over(before), F.lit(0)))  # a row per day
    within = Window.partitionBy("day").orderBy("at")
    running = moments.join(carried.filter("starts > 0").select("day", "carried"), "day").withColumn("active", F.col("carried") + F.sum("step").over(within))
    return running.groupBy("day").agg(F.max("active").alias("peak_runs"), F.min_by("at", F.struct(-F.col("active"), F.col("at"))).alias("peak_at"))


def daily_runs(runs: DataFrame) -> DataFrame:
    """Succeeded and failed runs per day, with the share of runs inside the SLA."""
    n = F.count(F.lit(1))
    return runs.groupBy(F.to_date("run_ts").alias("day")).agg(
        n.alias("runs"),
        F.count_if(F.col("status") == "SUCCESS").alias("succeeded"),
        F.count_if(F.col("status") != "SUCCESS").alias("failed"),
        pct(F.count_if(F.col("duration_s") < SLA_SECONDS), n).alias("within_sla_pct"),
    )


def run_trend(runs: DataFrame, days: int = 30) -> DataFrame:
    """Success and failure per day over the last ``days`` days of the log."""
    per_day = daily_runs(runs)
    last = runs.agg(F.max(F.to_date("run_ts"))).first()[0]
    return per_day.filter(F.col("day") > F.date_sub(F.lit(last).cast("date"), days))


def last_runs(runs: DataFrame, n: int = 7) -> DataFrame:
    return runs.orderBy(F.desc("run_ts"), "batch_id").limit(n)


def top_failing_rules(outcomes: DataFrame, n: int = 3) -> DataFrame:
    failing = outcomes.filter("failing_rows > 0").select("table_name", "rule", "failing_rows", "evaluated_rows")
    return top_n_per(failing, ["table_name"], [F.desc("failing_rows"), F.asc("rule")], n)


def rows_by_zone(counts: DataFrame) -> DataFrame:
    return counts.groupBy("zone").agg(F.sum("rows").alias("rows"))


def rows_by_zone_day(counts: DataFrame) -> DataFrame:
    """Rows and failed steps of each zone per day."""
    return counts.groupBy("zone", F.to_date("run_ts").alias("day")).agg(
        F.sum("rows").alias("rows"), F.count_if(F.col("status") == "FAILED").alias("failed_steps"),
    )


def job_trend(runs: DataFrame, days: int = 30) -> DataFrame:
    """Per job and day of the last ``days`` days of the log: runs, failure rate, mean and longest duration."""
    last = runs.agg(F.max(F.to_date("run_ts"))).first()[0]
    recent = runs.filter(F.to_date("run_ts") > F.date_sub(F.lit(last).cast("date"), days))
    n = F.count(F.lit(1))
    return recent.groupBy("step", F.to_date("run_ts").alias("day")).agg(
        n.alias("runs"), pct(F.count_if(F.col("status") == "FAILED"), n).alias("failure_rate_pct"),
        F.round(F.avg("duration_s"), 3).alias("mean_duration_s"), F.max("duration_s").alias("max_duration_s"),
    )


def quality_trend(outcomes: DataFrame, days: int = 30) -> DataFrame:
    """Per table and day of the last ``days`` days: rows checked, rows in quarantine and pass rate.

    ``outcomes`` are rule outcomes of many runs (table_name, run_date, rule_no, evaluated_rows, failed_rows); the row figures of a run stand in each of its rules.
    """
    last = outcomes.agg(F.max("run_date")).first()[0]
    recent = outcomes.filter(F.col("run_date") > F.date_sub(F.lit(last).cast("date"), days))
    per_run = recent.filter("rule_no = 1").groupBy("table_name", F.col("run_date").alias("day")).agg(
        F.sum("evaluated_rows").alias("evaluated_rows"), F.sum("failed_rows").alias("quarantined_rows"),
    )
    return per_run.withColumn("pass_rate_pct", pct(F.col("evaluated_rows") - F.col("quarantined_rows"), F.col("evaluated_rows")))
