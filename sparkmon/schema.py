"""Telemetry schemas, declared once; the wire form is derived from the typed form."""

from pyspark.sql import types as T

from sparkmon.constants import SENSORS

IDENTITY = ["event_id", "event_time", "site", "machine_id", "machine_type"]

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("site", T.StringType()),
        T.StructField("machine_id", T.StringType()),
        T.StructField("machine_type", T.StringType()),
        *[T.StructField(s, T.DoubleType()) for s in SENSORS],
        T.StructField("label", T.IntegerType()),
        T.StructField("fault_type", T.StringType()),
    ]
)

# On the wire the event time is an ISO-8601 string.
WIRE_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.StringType() if f.name == "event_time" else f.dataType)
        for f in EVENT_SCHEMA
    ]
)

WINDOW_METRICS_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("site", T.StringType()),
        T.StructField("machine_type", T.StringType()),
        T.StructField("events", T.LongType()),
        *[T.StructField(f"avg_{s}", T.DoubleType()) for s in SENSORS],
    ]
)

ALERT_SCHEMA = T.StructType(
    [
        *[WIRE_SCHEMA[c] for c in IDENTITY],
        *[T.StructField(s, T.DoubleType()) for s in SENSORS],
        T.StructField("anomaly_prob", T.DoubleType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

#: Alerts without a score, as the late rows are kept.
LATE_SCHEMA = T.StructType([field for field in ALERT_SCHEMA if field.name != "anomaly_prob"])

SCORE_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("anomaly_prob", T.DoubleType()),
        T.StructField("model_version", T.IntegerType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

DRIFT_SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("n_drifted_sensors", T.LongType()),
        T.StructField("max_drift_z", T.DoubleType()),
        T.StructField("total_out_of_spec", T.LongType()),
        T.StructField("n_events", T.LongType()),
        T.StructField("n_alerts", T.LongType()),
    ]
)

DRIFT_DETAIL_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("sensor", T.StringType()),
        T.StructField("batch_mean", T.DoubleType()),
        T.StructField("ref_mean", T.DoubleType()),
        T.StructField("drift_z", T.DoubleType()),
        T.StructField("drifted", T.BooleanType()),
        T.StructField("out_of_spec", T.LongType()),
    ]
)

REFERENCE_SCHEMA = T.StructType(
    [
        T.StructField("sensor", T.StringType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("std", T.DoubleType()),
    ]
)

INCIDENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("machine_id", T.StringType()),
        T.StructField("site", T.StringType()),
        T.StructField("machine_type", T.StringType()),
        T.StructField("alert_prob", T.DoubleType()),
        T.StructField("anomaly_prob", T.DoubleType()),
        T.StructField("severity", T.StringType()),
        T.StructField("symptom", T.StringType()),
        T.StructField("likely_cause", T.StringType()),
        T.StructField("recommended_action", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("retrieval_score", T.DoubleType()),
    ]
)
