"""Stream equals batch, late rows, replay, quarantine and the two concurrent queries."""

import json
import time

import pytest
from pyspark.sql import functions as F

from sparkmon.constants import SENSORS
from sparkmon.operators.drift import feature_reference
from sparkmon.operators.incidents import alerts
from sparkmon.operators.windows import window_metrics
from sparkmon.plans.run import Layout, report, start_streams
from sparkmon.sources import files
from sparkmon.plans.telemetry import as_events, surrogate_probability
from sparkmon.sources.wire import encode
from sparkmon.streaming.open_windows import all_windows, open_windows
from sparkmon.streaming.queries import late_rows_dropped, process_batch, start_window_metrics


def write_in_order(events, folder, per_file):
    """JSON files in event order, one after the other, with rising modification times."""
    folder.mkdir()
    rows = [r["value"] for r in encode(events).orderBy(F.col("key").cast("long")).collect()]
    import os

    for i, start in enumerate(range(0, len(rows), per_file)):
        path = folder / f"part-{i:05d}.json"
        path.write_text("\n".join(rows[start : start + per_file]))
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))


@pytest.fixture(scope="module")
def run(spark, events, guides, tmp_path_factory):
    """Both queries over 10 files, three per micro-batch, plus the report."""
    root = tmp_path_factory.mktemp("run")
    write_in_order(as_events(events), root / "in", 100)
    layout = Layout(str(root / "out"))
    stream = files.stream_json(spark, str(root / "in"), max_files=3)
    reference = feature_reference(events)
    handles = start_streams(stream, surrogate_probability, reference, layout)
    summary = report(spark, files.read_json(spark, str(root / "in")), guides, layout)
    return root, layout, handles, summary.collect()[0]


def test_windows_equal_batch_up_to_the_watermark(spark, run):
    root, layout, _, _ = run
    batch = files.read_json(spark, str(root / "in"))
    closed = batch.select(F.max("event_time") - F.expr("INTERVAL 2 MINUTES")).scalar()
    want = window_metrics(batch).filter(F.col("window_end") <= closed)
    got = files.read_window_metrics(spark, layout.windows)
    assert got.count() > 900
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_open_windows_complete_the_finished_ones(spark, run):
    root, layout, _, _ = run
    want = window_metrics(files.read_json(spark, str(root / "in")))
    got = all_windows(spark, layout.windows, layout.checkpoint("windows"))
    assert got.filter("NOT closed").count() > 0
    got = got.drop("closed")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_open_windows_follow_a_restarted_stream(spark, events, tmp_path):
    """Null sensors, a window that goes on after a restart, and one that closes then."""
    rows = as_events(events).filter("CAST(event_id AS INT) < 40").withColumn(
        "power_kw", F.when(F.col("event_id").cast("int") % 3 > 0, F.col("power_kw"))
    )
    (tmp_path / "in").mkdir()
    checkpoint, data = str(tmp_path / "checkpoint"), str(tmp_path / "data")
    seen = []
    for number, part in enumerate(("CAST(event_id AS INT) < 25", "CAST(event_id AS INT) >= 25")):
        lines = [r["value"] for r in encode(rows.filter(part)).collect()]
        (tmp_path / "in" / f"part-{number}.json").write_text("\n".join(lines))
        stream = files.stream_json(spark, str(tmp_path / "in"))
        start_window_metrics(stream, data, checkpoint, window="10 minutes").awaitTermination()
        want = window_metrics(files.read_json(spark, str(tmp_path / "in")), "10 minutes")
        got = all_windows(spark, data, checkpoint).drop("closed")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        seen.append({tuple(r) for r in open_windows(spark, checkpoint).select("window_start", "site", "machine_type").collect()})
    finished = {tuple(r) for r in files.read_window_metrics(spark, data).select("window_start", "site", "machine_type").collect()}
    assert seen[0] & finished and seen[1] and not seen[1] & finished


def test_each_micro_batch_owns_one_folder(spark, run):
    _, layout, _, _ = run
    log = files.read_drift_log(spark, layout.drift).orderBy("batch_id").collect()
    assert [(r["batch_id"], r["n_events"]) for r in log] == [(0, 300), (1, 300), (2, 300), (3, 100)]
    detail = files.read_drift_detail(spark, layout.drift_detail)
    assert detail.count() == 4 * len(SENSORS)
    raised = files.read_alerts(spark, layout.alerts).groupBy("batch_id").count().collect()
    assert {r["batch_id"]: r["count"] for r in raised} == {r["batch_id"]: r["n_alerts"] for r in log}


def test_alerts_equal_batch(spark, events, run):
    _, layout, _, _ = run
    want = {r["event_id"] for r in alerts(surrogate_probability(events)).collect()}
    got = [r["event_id"] for r in files.read_alerts(spark, layout.alerts).collect()]
    assert len(got) == len(want) and set(got) == want


def test_summary_and_incidents(spark, events, run):
    _, layout, _, summary = run
    n_alerts = files.read_alerts(spark, layout.alerts).count()
    assert summary["n_events"] == 1000 and summary["n_alerts"] == summary["n_incidents"] == n_alerts
    assert sum(summary["incidents_by_cause"].values()) == n_alerts
    assert sum(summary["incidents_by_severity"].values()) == n_alerts
    assert summary["sites"] == ["Basel", "Geneva", "Zurich"]
    assert summary["machines"] == events.select("machine_id").distinct().count()
    assert summary["drift_batches"] == 4
    assert files.read_incidents(spark, layout.incidents).count() == n_alerts


def test_finished_queries_report_no_error(run):
    assert all(h.exception() is None and not h.isActive for h in run[2])


def test_late_rows_are_dropped_from_windows_only(spark, events, tmp_path):
    write_in_order(as_events(events).filter("CAST(event_id AS INT) < 600"), tmp_path / "in", 100)
    stray = as_events(events).filter("event_id = '0'").withColumn("event_id", F.lit("999999"))
    late = encode(stray).collect()[0]["value"]
    (tmp_path / "in" / "late.json").write_text(late)
    layout = Layout(str(tmp_path / "out"))
    stream = files.stream_json(spark, str(tmp_path / "in"), max_files=3)
    windows, scoring = start_streams(
        stream, surrogate_probability, feature_reference(events), layout
    )
    assert late_rows_dropped(windows) == 1
    total = files.read_drift_log(spark, layout.drift).agg(F.sum("n_events")).collect()[0][0]
    assert total == 601


def test_replaying_a_batch_changes_nothing(spark, events, tmp_path):
    out, reference = str(tmp_path), feature_reference(events)
    snapshots = []
    for _ in range(2):
        process_batch(events.limit(200), 5, surrogate_probability, reference, out)
        snapshots.append(
            (
                sorted(files.read_alerts(spark, f"{out}/alerts").collect()),
                sorted(files.read_drift_log(spark, f"{out}/drift").collect()),
            )
        )
    assert snapshots[0] == snapshots[1] and len(snapshots[0][0]) > 0


def test_unscorable_rows_do_not_stop_the_batch(spark, events, tmp_path):
    out = str(tmp_path)
    broken = events.limit(50).withColumn(
        "power_kw", F.when(F.col("event_id").cast("int") % 10 == 0, None).otherwise(F.col("power_kw"))
    )
    bad = broken.filter("power_kw IS NULL").count()
    process_batch(broken, 0, surrogate_probability, feature_reference(events), out)
    log = files.read_drift_log(spark, f"{out}/drift").collect()[0]
    quarantined = spark.read.json(f"{out}/quarantine")
    assert log["n_events"] == 50 and 0 < bad == quarantined.count()
    assert {r["reason"] for r in quarantined.collect()} == {"sensor value"}
    assert files.read_alerts(spark, f"{out}/alerts").filter("power_kw IS NULL").count() == 0


def test_empty_batch_writes_nothing(spark, events, tmp_path):
    out = tmp_path / "none"
    process_batch(events.limit(0), 0, surrogate_probability, feature_reference(events), str(out))
    assert not out.exists()


def test_restart_continues_where_the_checkpoint_ended(spark, events, tmp_path):
    write_in_order(as_events(events).filter("CAST(event_id AS INT) < 200"), tmp_path / "in", 100)
    layout = Layout(str(tmp_path / "out"))
    stream = files.stream_json(spark, str(tmp_path / "in"))
    reference = feature_reference(events)
    start_streams(stream, surrogate_probability, reference, layout)
    more = encode(as_events(events).filter("CAST(event_id AS INT) BETWEEN 200 AND 299")).collect()
    (tmp_path / "in" / "more.json").write_text("\n".join(r["value"] for r in more))
    start_streams(stream, surrogate_probability, reference, layout)
    log = files.read_drift_log(spark, layout.drift).orderBy("batch_id").collect()
    assert [(r["batch_id"], r["n_events"]) for r in log] == [(0, 200), (1, 100)]


def test_handles_are_returned_without_waiting(spark, events, tmp_path):
    write_in_order(as_events(events).limit(50), tmp_path / "in", 50)
    layout = Layout(str(tmp_path / "out"))
    stream = files.stream_json(spark, str(tmp_path / "in"))
    handle = start_window_metrics(
        stream, layout.windows, layout.checkpoint("windows"), trigger={"processingTime": "1 second"}
    )
    try:
        assert handle.isActive
        deadline = time.time() + 60
        while not handle.recentProgress and time.time() < deadline:
            time.sleep(0.2)
        assert json.loads(handle.lastProgress.json)["numInputRows"] >= 0
    finally:
        handle.stop()
