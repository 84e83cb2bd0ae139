"""The commit log of a sink, late readings and the typed event log."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from sparkmon.operators.drift import feature_reference
from sparkmon.plans.run import Layout, start_logged_streams
from sparkmon.plans.telemetry import as_events, surrogate_probability
from sparkmon.sources import files, sinks
from sparkmon.sources.commits import Commit, commits, micros, publish
from sparkmon.streaming.queries import process_batch
from tests.test_streaming import write_in_order


def ids(df):
    return sorted(r.event_id for r in df.collect())


def test_what_is_not_published_is_not_read(spark, events, tmp_path):
    path = str(tmp_path / "alerts")
    scored = surrogate_probability(events)
    rows = sinks.alert_log_rows(scored.limit(9).select(*files.read_alerts(spark, path).columns[:-1]))
    sinks.write_attempt(rows, path, 0)
    assert files.read_alerts(spark, path).count() == 0
    folder = sinks.write_attempt(rows.limit(4), path, 0)
    publish(spark, path, Commit(0, folder, 5, 6))
    assert files.read_alerts(spark, path).count() == 4
    publish(spark, path, Commit(0, sinks.write_attempt(rows, path, 0)))
    sinks.write_batch(rows, path, 1)
    assert files.read_alerts(spark, path).groupBy("batch_id").count().count() == 2
    assert files.read_alerts(spark, path).count() == 18
    assert [c.batch_id for c in commits(spark, path)] == [0, 1]


def test_a_batch_that_dies_before_publishing_shows_nothing_of_itself(spark, events, tmp_path):
    out, reference = str(tmp_path), feature_reference(events)

    def die(batch_id):
        raise InterruptedError(batch_id)

    with pytest.raises(InterruptedError):
        process_batch(events.limit(200), 0, surrogate_probability, reference, out, before_publish=die)
    sinks_of = {"alerts": files.read_alerts, "drift": files.read_drift_log, "drift_detail": files.read_drift_detail}
    assert all(read(spark, f"{out}/{name}").count() == 0 for name, read in sinks_of.items())
    process_batch(events.limit(200), 0, surrogate_probability, reference, out)
    assert files.read_drift_log(spark, f"{out}/drift").collect()[0].n_events == 200
    attempts = [p for p in (tmp_path / "drift" / "batch_id=0").iterdir() if p.is_dir()]
    assert len(attempts) == 2


def test_a_cursor_leaves_out_batches_that_begin_later(spark, events, tmp_path):
    out, reference = str(tmp_path), feature_reference(events)
    days = [r[0] for r in events.select(F.to_date("event_time").alias("d")).distinct().orderBy("d").limit(4).collect()]
    for number, day in enumerate(days):
        batch = as_events(events).filter(F.to_date("event_time") == day)
        process_batch(batch, number, surrogate_probability, reference, out)
    cursor = datetime.combine(days[1], datetime.min.time()) + timedelta(hours=23, minutes=59)
    whole = files.read_alerts(spark, f"{out}/alerts")
    pruned = files.read_alerts(spark, f"{out}/alerts", until=cursor)
    assert {f.split("batch_id=")[1][0] for f in pruned.inputFiles()} == {"0", "1"}
    assert len(whole.inputFiles()) > len(pruned.inputFiles())
    seen = F.col("event_time") <= F.lit(cursor.replace(tzinfo=timezone.utc))
    assert ids(pruned.filter(seen)) == ids(whole.filter(seen)) != []
    assert files.read_alerts(spark, f"{out}/alerts", until=datetime(2000, 1, 1)).count() == 0
    assert micros(cursor) == micros(cursor.replace(tzinfo=timezone.utc))


def test_late_readings_are_kept_and_scored(spark, events, tmp_path):
    out, reference = str(tmp_path), feature_reference(events)
    rows = as_events(events).withColumn("number", F.col("event_id").cast("int"))
    first, last = rows.filter("number < 300"), rows.filter("number BETWEEN 300 AND 399")
    strays = rows.filter("number < 7").withColumn("event_id", F.concat(F.lit("late-"), "event_id"))
    # Not late: its window is still open two minutes behind the newest reading.
    newest = first.agg(F.max("event_time")).scalar()
    open_one = rows.filter("number = 0").withColumns({"event_id": F.lit("open"), "event_time": newest - F.expr("INTERVAL 1 MINUTE")})
    batches = [first, last.unionByName(strays).unionByName(open_one)]
    for number, batch in enumerate(batches):
        process_batch(batch.drop("number"), number, surrogate_probability, reference, out)
    late = files.read_late_rows(spark, f"{out}/late")
    assert ids(late) == [f"late-{i}" for i in range(7)]
    assert {r.batch_id for r in late.collect()} == {1}
    log = {r.batch_id: r.n_events for r in files.read_drift_log(spark, f"{out}/drift").collect()}
    assert log == {0: 300, 1: 108}
    # A replay judges the batch by the ones before it, not by its own commit.
    process_batch(batches[1].drop("number"), 1, surrogate_probability, reference, out)
    assert ids(files.read_late_rows(spark, f"{out}/late")) == [f"late-{i}" for i in range(7)]


def test_the_source_is_read_once_for_both_queries(spark, events, tmp_path):
    write_in_order(as_events(events).filter("CAST(event_id AS INT) < 400"), tmp_path / "in", 50)
    layout = Layout(str(tmp_path / "out"))
    stream = files.stream_json(spark, str(tmp_path / "in"), max_files=3)
    handles = start_logged_streams(stream, surrogate_probability, feature_reference(events), layout)
    sources = [{s["description"] for p in h.recentProgress for s in p["sources"]} for h in handles]
    assert all("/in]" in s for s in sources[0]) and all("/events]" in s for s in sources[1] | sources[2])
    read = [sum(p["numInputRows"] for p in h.recentProgress) for h in handles]
    assert read == [400, 400, 400]
    assert files.read_events(spark, layout.events).count() == 400
    assert files.read_drift_log(spark, layout.drift).agg(F.sum("n_events")).collect()[0][0] == 400
