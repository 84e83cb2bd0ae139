from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkmon.operators import monitor

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def windows(spark):
    rows = [
        (START + timedelta(minutes=m), site, kind, m + 1)
        for m in range(10)
        for site in ("Basel", "Zurich")
        for kind in ("Lathe", "CNC_Mill")
    ]
    return spark.createDataFrame(
        rows, "window_start timestamp, site string, machine_type string, events long"
    )


@pytest.fixture(scope="module")
def alerts(spark):
    rows = [(START + timedelta(minutes=m), f"M-{m % 3}", "Lathe" if m % 3 else "CNC_Mill") for m in range(10)]
    return spark.createDataFrame(rows, "event_time timestamp, machine_id string, machine_type string")


def drift_log(spark, n):
    rows = [(b, b % 3, b / 7) for b in range(n)]
    return spark.createDataFrame(rows, "batch_id long, n_drifted_sensors long, max_drift_z double")


def test_cursor_position_counts_windows_and_events(windows):
    row = monitor.cursor_position(windows, 4).collect()[0]
    assert row.asDict() == {
        "now": START + timedelta(minutes=3),
        "n_windows": 10,
        "cursor": 4,
        "events_seen": 4 * (1 + 2 + 3 + 4),
    }
    assert monitor.cursor_position(windows).collect()[0]["cursor"] == 10


def test_kpi_counts_alerts_up_to_the_window_start(spark, windows, alerts):
    position = monitor.cursor_position(windows, 4)
    seen = monitor.alerts_seen(alerts, position)
    row = monitor.kpi_at_cursor(seen, drift_log(spark, 5), position).collect()[0]
    assert (row["n_alerts"], row["events_seen"], row["alert_rate_pct"]) == (4, 40, 10.0)
    # round(5 * 0.4) = 2 batches, so the last visible one is batch 1
    assert row["drifted_sensors"] == 1


def test_kpi_without_events(spark, windows, alerts):
    position = monitor.cursor_position(windows.limit(0))
    seen = monitor.alerts_seen(alerts.limit(0), position)
    row = monitor.kpi_at_cursor(seen, drift_log(spark, 0), position).collect()[0]
    assert (row["n_alerts"], row["events_seen"], row["alert_rate_pct"]) == (0, 0, 0.0)
    assert row["drifted_sensors"] == 0


@pytest.mark.parametrize("n, cursor", [(5, 1), (5, 5), (6, 10), (25, 1), (25, 3), (1, 1)])
def test_drift_prefix_rounds_half_to_even_and_keeps_one(spark, windows, n, cursor):
    position = monitor.cursor_position(windows, cursor)
    rows = monitor.drift_prefix(drift_log(spark, n), position).collect()
    assert len(rows) == max(1, round(n * cursor / 10))
    assert {r["batch_id"] for r in rows} == set(range(len(rows)))


def test_throughput_and_counts(windows, alerts):
    rows = monitor.throughput_by_site(windows).collect()
    assert len(rows) == 20 and all(r["events"] == 2 * (r["window_start"].minute + 1) for r in rows)
    counted = monitor.count_by(alerts, "machine_type").collect()
    assert [tuple(r) for r in counted] == [("Lathe", 6), ("CNC_Mill", 4)]


def test_no_window_yet_shows_every_alert(windows, alerts):
    position = monitor.cursor_position(windows.limit(0))
    assert monitor.at_cursor(alerts, "event_time", position).count() == 10


def test_cursor_sorts_nothing(spark, windows):
    position = monitor.cursor_position(windows, 4)
    plan = monitor.drift_prefix(drift_log(spark, 5), position)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrdered" not in plan and "Window " not in plan and "Sort " not in plan


def test_top_incidents_with_one_dominant_machine(spark, alerts):
    # A third of all rows and all high probabilities belong to one machine that is not visible.
    rows = [(f"{i:05d}", "M-hidden", 0.99) for i in range(1000)]
    rows += [(f"{i:05d}", f"M-{i % 3}", (i % 700) / 1000) for i in range(1000, 3000)]
    raised = spark.createDataFrame(rows, "event_id string, machine_id string, anomaly_prob double")
    best = monitor.top_alerts_seen(raised, alerts).withColumnRenamed("anomaly_prob", "alert_prob")
    shown = monitor.with_preview(best.withColumn("recommended_action", F.lit("x" * 200))).collect()
    visible = sorted((r for r in rows if r[1] != "M-hidden"), key=lambda r: (-r[2], r[0]))[:4]
    assert [(r["event_id"], r["alert_prob"]) for r in shown] == [(v[0], v[2]) for v in visible]
    assert all(len(r["action_preview"]) == 160 for r in shown)


def test_top_incidents_cut_within_tasks_before_the_shuffle(spark, alerts):
    raised = spark.createDataFrame(
        [("a", "M-1", 0.5)], "event_id string, machine_id string, anomaly_prob double"
    )
    plan = monitor.top_alerts_seen(raised, alerts)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def summary(spark, events, alerts, incidents, log):
    n_alerts = alerts.select(F.count(F.lit(1))).scalar()
    machines, reports = monitor.machine_totals(events), monitor.incident_totals(incidents)
    return monitor.run_summary(machines, n_alerts, reports, log).collect()[0].asDict()


EVENTS = "site string, machine_id string, label int"
INCIDENTS = "likely_cause string, severity string"


def test_run_summary(spark):
    events = spark.createDataFrame(
        [("Zurich", f"M-{i % 4}", int(i % 8 == 0)) for i in range(24)] + [("Basel", "M-0", 0)], EVENTS
    )
    alerts = spark.createDataFrame([(i,) for i in range(3)], "id int")
    incidents = spark.createDataFrame(
        [("tool wear", "watch"), ("tool wear", "critical"), ("bearing wear", "watch")], INCIDENTS
    )
    log = spark.createDataFrame(
        [(0, 2, 9.0), (1, 0, 0.1), (2, 0, 1.234), (3, 1, 1.1)],
        "batch_id long, n_drifted_sensors long, max_drift_z double",
    )
    assert summary(spark, events, alerts, incidents, log) == {
        "n_events": 25,
        "n_alerts": 3,
        "alert_rate_pct": 12.0,
        "true_anomaly_rate_pct": 12.0,
        "n_incidents": 3,
        "incidents_by_cause": {"tool wear": 2, "bearing wear": 1},
        "incidents_by_severity": {"watch": 2, "critical": 1},
        "sites": ["Basel", "Zurich"],
        "machines": 4,
        "drift_batches": 4,
        "max_drift_z_end": 1.23,
        "drifted_at_end": 1,
    }


def test_run_summary_of_nothing(spark):
    row = summary(
        spark,
        spark.createDataFrame([], EVENTS),
        spark.createDataFrame([], "id int"),
        spark.createDataFrame([], INCIDENTS),
        drift_log(spark, 0),
    )
    assert row["n_events"] == row["n_alerts"] == row["n_incidents"] == row["machines"] == 0
    assert row["alert_rate_pct"] == row["max_drift_z_end"] == 0.0 and row["drifted_at_end"] == 0
    assert row["incidents_by_cause"] == {} and row["sites"] == []
