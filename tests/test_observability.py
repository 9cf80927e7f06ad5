from __future__ import annotations

from datetime import date, datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

from tellerlake.plans import observability as obs

START = date(2024, 1, 1)


def daily(spark, values, name="t"):
    data = [(name, START + timedelta(days=i), v) for i, v in enumerate(values) if v is not None]
    return spark.createDataFrame(data, "table_name string, day date, value long")


def anomalies(df):
    return [r.day for r in df.filter("is_anomaly = 1").orderBy("day").collect()]


def test_short_history_is_silent(spark):
    assert anomalies(obs.row_anomalies(daily(spark, [10, 11, 10, 11, 10, 11, 5000]))) == []


def test_spike_and_drop_are_found(spark):
    flat = [100, 101, 99, 100, 101, 99, 100, 101, 99, 100, 101, 99, 100, 101]
    assert anomalies(obs.row_anomalies(daily(spark, [*flat, 400]))) == [START + timedelta(days=14)]
    low = daily(spark, [*flat, 10])
    assert anomalies(obs.row_anomalies(low)) == [START + timedelta(days=14)]
    assert anomalies(obs.duration_anomalies(low)) == []
    alert = obs.alert_rows(obs.row_anomalies(low)).first()
    assert (alert.value, alert.expected_range) == (10, "98-102")


def test_gaps_count_by_calendar_and_flat_history_has_no_band(spark):
    with_gap = daily(spark, [100] * 7 + [None] * 20 + [500])
    assert anomalies(obs.row_anomalies(with_gap)) == []
    flat = obs.row_anomalies(daily(spark, [100] * 10 + [100, 101]))
    assert anomalies(flat) == [START + timedelta(days=11)]


def test_deviation_rules(spark):
    got = rows(obs.deviation(daily(spark, [100, 79, 80, 86]), "value"), "value", "dropped", "off_baseline")
    assert got == [(100, 0, 0), (79, 1, 1), (80, 0, 1), (86, 0, 0)]


def test_alerts_compare_by_metric(spark):
    metrics = spark.createDataFrame(
        [("DQPassRate", "a", START, 94.9), ("DQPassRate", "b", START, 95.0), ("QuarantinedRows", "a", START, 51.0), ("QuarantinedRows", "b", START, 50.0),
         ("PipelineFailures", "p", START, 1.0), ("SilverRows", "a", START, 0.0), ("Unknown", "a", START, 1.0)],
        "metric string, table_name string, day date, value double",
    )
    got = rows(obs.alerts(metrics, obs.thresholds_df(spark)), "metric", "table_name", "severity")
    assert got == [("DQPassRate", "a", "warning"), ("PipelineFailures", "p", "critical"), ("QuarantinedRows", "a", "warning")]


def test_bursts(spark):
    t = datetime(2024, 1, 1)
    events = spark.createDataFrame([(t, "FAILED"), (t + timedelta(minutes=59), "FAILED"), (t + timedelta(hours=3), "FAILED")], "ts timestamp, status string")
    assert rows(obs.failure_bursts(events)) == [(t, t + timedelta(hours=1), 2)]
    assert obs.failure_bursts(events, least=3).count() == 0


def runs(spark):
    data = [(f"r{i}", datetime(2024, 1, 1 + i % 3, i % 24), "SUCCESS" if i % 4 else "FAILED", 1400.0 if i % 2 else 1500.0) for i in range(12)]
    return spark.createDataFrame(data, "batch_id string, run_ts timestamp, status string, duration_s double")


def test_dashboards(spark):
    log = runs(spark)
    per_day = rows(obs.daily_runs(log), "day", "runs", "succeeded", "failed", "within_sla_pct")
    assert per_day == [(date(2024, 1, 1), 4, 3, 1, 50.0), (date(2024, 1, 2), 4, 3, 1, 50.0), (date(2024, 1, 3), 4, 3, 1, 50.0)]
    assert obs.run_trend(log, 2).count() == 2
    last = [r.batch_id for r in obs.last_runs(log, 3).collect()]
    assert last == ["r11", "r8", "r5"]
    zones = spark.createDataFrame([("silver", 3), ("silver", 4), ("gold", 1)], "zone string, rows long")
    assert rows(obs.rows_by_zone(zones)) == [("gold", 1), ("silver", 7)]


def test_metrics_from_outcomes(spark):
    outcomes = spark.createDataFrame([("t", START, "r1", 0, 10, "Passed"), ("t", START, "r2", 3, 10, "Failed")], "table_name string, run_date date, rule string, failing_rows long, evaluated_rows long, outcome string")
    results = spark.createDataFrame([("t", START, 10, 3)], "table_name string, day date, evaluated_rows long, failed_rows long")
    log = spark.createDataFrame([("s", datetime(2024, 1, 1), 12.5), ("s", datetime(2024, 1, 1), 2.5)], "step string, run_ts timestamp, duration_s double")
    got = {(m, t): v for m, t, _, v in rows(obs.metrics(outcomes, results, log))}
    assert got == {
        ("DQRulesPassed", "t"): 1.0, ("DQRulesFailed", "t"): 1.0, ("RowsProcessed", "t"): 10.0, ("QuarantinedRows", "t"): 3.0,
        ("DQPassRate", "t"): 70.0, ("FailedSharePct", "t"): 30.0, ("JobDurationSeconds", "s"): 12.5,
    }
    assert rows(obs.top_failing_rules(outcomes), "rule", "rank") == [("r2", 1)]


def test_a_table_that_got_nothing_raises_an_alarm(spark):
    days = [START + timedelta(days=i) for i in range(30)]
    daily = spark.createDataFrame([("t", d, 100 + i % 3) for i, d in enumerate(days) if i != 25] + [("gone", d, 50 + i % 2) for i, d in enumerate(days[:20])], "table_name string, day date, value long")
    dense = obs.dense_days(daily, "value", until=days[-1].isoformat())
    assert dense.count() == 60
    assert rows(obs.row_anomalies(daily).filter("is_anomaly = 1"), "day") == []
    found = rows(obs.row_anomalies(dense).filter("is_anomaly = 1 AND value = 0"), "table_name", "day")
    assert ("t", days[25]) in found and ("gone", days[20]) in found
    flagged = rows(obs.deviation(dense, "value").filter("dropped = 1"), "table_name", "day")
    assert ("t", days[25]) in flagged and ("gone", days[20]) in flagged
    # Behind nothing but zeros a zero is no deviation, any row is.
    zeros = spark.createDataFrame([("z", START + timedelta(days=i), 0 if i < 20 else 7) for i in range(21)], "table_name string, day date, value long")
    assert rows(obs.deviation(zeros, "value").filter("off_baseline = 1"), "day") == [(START + timedelta(days=20),)]


def test_runs_at_the_same_time(spark):
    t = datetime(2024, 1, 1, 23, 0)
    data = [(t, 7200.0), (t + timedelta(minutes=10), 600.0), (t + timedelta(minutes=20), 60.0), (t + timedelta(minutes=90), 60.0), (t + timedelta(days=3), 0.0), (t + timedelta(days=5), 1.5)]
    runs = spark.createDataFrame(data, "run_ts timestamp, duration_s double")
    # The second ends when the third starts; the first runs past midnight; a run without length is never at work.
    assert rows(obs.concurrent_runs(runs), "day", "peak_runs", "peak_at") == [
        (date(2024, 1, 1), 2, t + timedelta(minutes=10)), (date(2024, 1, 2), 2, t + timedelta(minutes=90)), (date(2024, 1, 6), 1, t + timedelta(days=5)),
    ]


def test_each_threshold_fires_once(spark):
    t = datetime(2024, 1, 1, 1)
    log = [
        ("b1", "bronze", "a", "FAILED", 10, 700.0, t), ("b1", "silver", "b", "FAILED", 10, 30.0, t + timedelta(minutes=50)), ("b1", "warehouse", "w", "FAILED", 0, 5.0, t + timedelta(minutes=55)),
        ("b2", "silver", "b", "SUCCESS", 40, 5.0, t + timedelta(days=1)), ("b2", "gold", "g", "SUCCESS", 30, 5.0, t + timedelta(days=1, minutes=2)),
    ]
    runs = spark.createDataFrame(log, "batch_id string, phase string, step string, status string, rows long, duration_s double, started_at timestamp")
    got = {(r.metric, r.day): r.value for r in obs.whole_run_metrics(runs).collect()}
    one, two = t.date(), (t + timedelta(days=1)).date()
    assert got[("PipelineDurationSeconds", one)] == 3305.0 and got[("PipelineDurationSeconds", two)] == 125.0
    assert (got[("PipelineFailures", one)], got[("DailySuccess", two)], got[("FailedJobsPerHour", one)], got[("WarehouseLoadFailed", one)]) == (1.0, 1.0, 3.0, 1.0)
    assert (got[("SilverRows", one)], got[("SilverRows", two)], got[("GoldRows", two)]) == (0.0, 40.0, 30.0)
    outcomes = spark.createDataFrame([("t", one, "r", 60, 100, "Failed")], "table_name string, run_date date, rule string, failing_rows long, evaluated_rows long, outcome string")
    results = spark.createDataFrame([("t", one, 100, 60)], "table_name string, day date, evaluated_rows long, failed_rows long")
    every = obs.metrics(outcomes, results, runs.withColumn("run_ts", F.col("started_at"))).unionByName(obs.whole_run_metrics(runs))
    fired = sorted(r.metric for r in obs.alerts(every, obs.thresholds_df(spark)).collect())
    assert fired == sorted(m for m, comparison, _, _ in obs.THRESHOLDS if comparison != "tracked")
