import json
import math

import pytest
from pyspark.sql import functions as F

from sparkmon.constants import SENSORS
from sparkmon.schema import ALERT_SCHEMA, WIRE_SCHEMA
from sparkmon.sources import files, kafka, sinks, wire
from sparkmon.plans.telemetry import as_events, telemetry

GOOD = {
    "event_id": "e1",
    "event_time": "2024-01-01T00:00:02",
    "site": "Zurich",
    "machine_id": "M-1",
    "machine_type": "Lathe",
    **{s: 1.5 for s in SENSORS},
    "label": 0,
    "fault_type": None,
}


def decoded(spark, *payloads):
    texts = [p if isinstance(p, str) or p is None else json.dumps(p) for p in payloads]
    binary = [(None if t is None else bytearray(t, "utf-8"),) for t in texts]
    return wire.decode(spark.createDataFrame(binary, "value binary"))


def test_decode_types_a_binary_message(spark):
    row = decoded(spark, GOOD).collect()[0]
    assert row["event_time"].isoformat() == "2024-01-01T00:00:02"
    assert row["temperature_c"] == 1.5 and row["fault_type"] is None and row["label"] == 0


def test_bad_rows_are_quarantined_with_a_reason(spark):
    missing = {k: v for k, v in GOOD.items() if k != "power_kw"}
    late = GOOD | {"event_time": "soon"}
    rows = decoded(spark, GOOD, missing, late, "{broken", None)
    assert rows.filter(wire.is_valid()).count() == 1
    reasons = sorted(r["reason"] for r in wire.quarantined_rows(rows).collect())
    assert reasons == ["event time", "sensor value", "unreadable", "unreadable"]


def test_nan_is_not_scorable(spark, events):
    odd = events.limit(1).withColumn("power_kw", F.lit(math.nan))
    assert odd.filter(wire.is_valid()).count() == 0


def test_parsing_happens_once_below_filters(spark):
    plan = decoded(spark, GOOD).filter(wire.is_valid())._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_encode_keeps_nulls_and_iso_time(spark, events):
    first = as_events(events.filter("label = 0")).limit(1)
    row, message = first.collect()[0], wire.encode(first).collect()[0]
    fields = json.loads(message["value"])
    assert list(fields) == WIRE_SCHEMA.names and fields["fault_type"] is None
    assert fields["event_time"] == row["event_time"].isoformat()
    assert message["key"] == row["event_id"]


def test_whole_seconds_have_no_fraction(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:02' AS t, timestamp'2024-01-01 00:00:02.000120' AS u")
    assert tuple(df.select(wire.iso_time("t"), wire.iso_time("u")).collect()[0]) == (
        "2024-01-01T00:00:02",
        "2024-01-01T00:00:02.000120",
    )


def test_event_files_are_ordered_and_bounded(spark, events, tmp_path):
    path = str(tmp_path / "in")
    n = sinks.write_event_files(as_events(events), path, events_per_file=100)
    written = sorted((tmp_path / "in").glob("*.json"))
    assert n == len(written) >= 10
    times = []
    for f in written:
        lines = f.read_text().splitlines()
        assert len(lines) <= 100
        times += [json.loads(line)["event_time"] for line in lines]
    assert times == sorted(times) and len(times) == events.count()
    assert files.read_json(spark, path).count() == events.count()


def test_replacing_a_batch_is_idempotent_even_when_empty(spark, events, tmp_path):
    path = str(tmp_path / "alerts")
    rows = events.limit(5).select(
        *[F.col(c).cast(ALERT_SCHEMA[c].dataType) for c in ALERT_SCHEMA.names[:-2]],
        F.lit(0.9).alias("anomaly_prob"),
    )
    for frame, total in ((rows, 5), (rows, 5), (rows.limit(0), 0)):
        sinks.write_batch(frame, path, 7)
        read = files.read_alerts(spark, path)
        assert read.count() == total
        assert read.filter("batch_id = 7 AND event_time IS NOT NULL").count() == total


def test_absent_sinks_read_as_empty(spark, tmp_path):
    path = str(tmp_path / "none")
    for read in (
        files.read_alerts,
        files.read_drift_log,
        files.read_drift_detail,
        files.read_window_metrics,
        files.read_incidents,
    ):
        assert read(spark, path).count() == 0


def test_corpus_scan_names_documents_by_stem(spark, tmp_path):
    (tmp_path / "b.guide.md").write_text("# B\nline")
    (tmp_path / "a.md").write_text("# A")
    (tmp_path / "skip.txt").write_text("no")
    rows = files.read_corpus(spark, str(tmp_path)).orderBy("name").collect()
    assert [(r["name"], r["text"]) for r in rows] == [("a", "# A"), ("b.guide", "# B\nline")]


def test_packaged_guides_all_have_an_action(guides):
    from sparkmon.functions.text import guide_action

    rows = guides.select("name", "text", guide_action("text").alias("action")).collect()
    assert len(rows) == 5 and all(len(r["action"]) > 20 and "#" not in r["action"] for r in rows)


def test_kafka_needs_its_connector(spark):
    try:
        stream = kafka.read_kafka(spark, "localhost:1", "topic")
    except Exception as e:
        assert "kafka" in str(e).lower()
        pytest.skip("Kafka connector not on the class path")
    assert stream.isStreaming


def test_view_label_rate_and_fault_names(spark):
    from pyspark.sql import functions as F

    view = as_events(telemetry(spark.read.parquet("/root/testdata/sf0.01/events.parquet")))
    stats = view.agg(
        F.avg("label"),
        F.count_if(F.col("fault_type").isNull() == (F.col("label") == 1)),
        *[F.avg(F.when(F.col("label") == 1, F.col(s))) - F.avg(F.when(F.col("label") == 0, F.col(s))) for s in SENSORS],
    ).collect()[0]
    assert abs(stats[0] - 0.06) < 0.02 and stats[1] == 0
    assert all(rise > 0 for rise in stats[2:])


class Recorder:
    """Stands in for a reader or writer and keeps the options it is given."""

    def __init__(self, result=None):
        self.options, self.result = {}, result

    def format(self, name):
        self.options["format"] = name
        return self

    def option(self, key, value):
        self.options[key] = value
        return self

    def load(self):
        return self.result


def test_kafka_options_and_decoding(spark):
    class Session:
        readStream = Recorder(
            spark.createDataFrame([(bytearray(json.dumps(GOOD), "utf-8"),)], "value binary")
        )

    rows = kafka.read_kafka(Session, "broker:9092", "telemetry")
    assert Session.readStream.options == {
        "format": "kafka",
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "telemetry",
        "startingOffsets": "earliest",
    }
    assert rows.collect()[0]["machine_type"] == "Lathe"
