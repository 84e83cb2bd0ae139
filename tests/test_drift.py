import math

import pytest
from pyspark.sql import functions as F

from sparkmon.constants import SENSORS
from sparkmon.operators import drift

KEY = ["batch_id"]


def evaluate(rows, reference, batch=1):
    statistics = drift.batch_statistics(rows.withColumn("batch_id", F.lit(batch)), KEY)
    detail = drift.drift_detail(statistics, reference, KEY)
    by_sensor = {r["sensor"]: r for r in detail.collect()}
    return by_sensor, drift.drift_summary(detail, KEY).collect()[0]


def early(events):
    return events.filter(F.dayofmonth("event_time") <= 15)


def test_clean_rows_show_no_drift(events):
    reference = drift.feature_reference(early(events))
    _, summary = evaluate(early(events), reference)
    assert summary["n_drifted_sensors"] == 0 and summary["max_drift_z"] < 1.0


def test_shifted_sensor_is_flagged(events):
    reference = drift.feature_reference(early(events))
    shifted = early(events).withColumn("temperature_c", F.col("temperature_c") + 25)
    detail, summary = evaluate(shifted, reference)
    assert detail["temperature_c"]["drifted"] and not detail["power_kw"]["drifted"]
    assert summary["n_drifted_sensors"] == 1


def test_only_the_ramp_at_the_end_of_the_month_drifts(spark):
    from sparkmon.plans.catalog import drift_summary, view

    folder = "/root/testdata/sf0.01"
    assert drift_summary(spark, folder).filter("batch_id <= 18 AND n_drifted_sensors > 0").count() == 0
    last = view(spark, folder).filter(F.dayofmonth("event_time") >= 27)
    reference = drift.feature_reference(early(view(spark, folder)))
    detail, summary = evaluate(last, reference)
    assert detail["temperature_c"]["drifted"] and detail["vibration_mm_s"]["drifted"]
    assert summary["n_drifted_sensors"] == 2


def readings(spark, *temperatures):
    rows = [(t, 2.8, 68.0, 22.0, 78.0) for t in temperatures]
    return spark.createDataFrame(rows, ", ".join(f"{s} double" for s in SENSORS))


def test_out_of_spec_excludes_the_bounds_and_nan(spark):
    rows = readings(spark, 9.9, 10.0, 120.0, 120.1, math.nan, None)
    counts = {r["sensor"]: r["out_of_spec"] for r in drift.out_of_spec_counts(rows).collect()}
    assert counts == {s: 2 if s == "temperature_c" else 0 for s in SENSORS}


def test_zero_deviation_counts_as_one_and_missing_values_are_skipped(spark):
    reference = drift.feature_reference(readings(spark, 60.0, 60.0))
    detail, _ = evaluate(readings(spark, 61.5, math.nan, None), reference)
    assert detail["temperature_c"]["drift_z"] == 1.5


def test_threshold_is_strict(spark):
    reference = drift.feature_reference(readings(spark, 60.0, 60.0))
    detail, _ = evaluate(readings(spark, 61.0), reference)
    assert detail["temperature_c"]["drift_z"] == 1.0 and not detail["temperature_c"]["drifted"]


def test_moments_combine_to_the_same_statistics(spark, events):
    keys = events.withColumn("batch_id", F.dayofmonth("event_time").cast("long"))
    parts = drift.moments(keys, ["batch_id", "site", "machine_id"])
    order = lambda df: [tuple(r) for r in df.orderBy(df.columns[0]).collect()]
    whole = order(drift.batch_statistics(keys, ["batch_id"]))
    combined = order(drift.combined_statistics(parts, ["batch_id"]))
    for a, b in zip(whole, combined, strict=True):
        assert a == pytest.approx(b)
    for a, b in zip(order(drift.feature_reference(keys)), order(drift.combined_reference(parts)), strict=True):
        assert a[0] == b[0] and a[1:] == pytest.approx(b[1:])
