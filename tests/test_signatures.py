"""Signatures from a table against a direct computation, and models by version."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkmon.constants import NO_FAULT, SENSORS
from sparkmon.operators import scoring
from sparkmon.operators.signatures import compile_signatures, match_signatures

START = datetime(2024, 3, 1)
SIGNATURE = "fault string, ordinal int, sensor string, weight double, valid_from timestamp_ntz, valid_until timestamp_ntz"
READING = "event_id int, event_time timestamp_ntz, " + ", ".join(f"z_{s} double" for s in SENSORS)


@pytest.fixture(scope="module")
def tables(spark):
    pick = random.Random(1)
    signatures = []
    for i in range(300):
        begin = START + timedelta(hours=pick.randrange(0, 240))
        end = begin + timedelta(hours=pick.choice([0, 1, 5, 24, 100]))
        for s in pick.sample(SENSORS, pick.randrange(1, 4)):
            signatures.append((f"fault {i % 200}", i // 2, s, round(pick.uniform(-0.5, 2), 1), begin, end))
    signatures += [("broken", 0, "power_kw", None, START, START + timedelta(9)), ("open", 0, "power_kw", 1.0, None, None)]
    readings = [
        (i, START + timedelta(minutes=pick.randrange(0, 15000)), *[pick.choice([None, None, 1.5, 2.0]) for _ in SENSORS])
        for i in range(400)
    ]
    readings += [(400, None, *[2.0] * len(SENSORS)), (401, START, *[None] * len(SENSORS))]
    return signatures, readings


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_match_equals_trying_every_signature(spark, tables, threshold):
    signatures, readings = tables
    by_signature = {}
    for fault, ordinal, sensor, weight, begin, end in signatures:
        if weight is not None and begin is not None and begin < end:
            by_signature.setdefault((ordinal, fault, begin, end), {})[sensor] = weight
    expected = {}
    for event_id, time, *z in readings:
        best = (0.0, 0, NO_FAULT)
        for (ordinal, fault, begin, end), weights in by_signature.items():
            if time is None or not begin <= time < end:
                continue
            total = sum((v or 0.0) * weights.get(s, 0.0) for s, v in zip(SENSORS, z))
            if round(total, 6) > 0:
                best = max(best, (round(total, 6), -ordinal, fault))
        expected[event_id] = best[2]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        frame = spark.createDataFrame(readings, READING).repartition(3)
        rows = match_signatures(frame, spark.createDataFrame(signatures, SIGNATURE)).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r.event_id: r.fault for r in rows} == expected and len(rows) == len(readings)
    assert len(set(expected.values())) > 40


def test_readings_are_not_exploded(spark, tables):
    signatures, readings = tables
    frame = spark.createDataFrame(readings, READING)
    plan = match_signatures(frame, spark.createDataFrame(signatures, SIGNATURE))._jdf.queryExecution().toString()
    assert "Generate" not in plan and "BroadcastHashJoin" in plan


def test_no_signatures_name_no_fault(spark, tables):
    none = spark.createDataFrame([], SIGNATURE)
    assert compile_signatures(none).count() == 0
    rows = match_signatures(spark.createDataFrame(tables[1], READING), none).collect()
    assert {r.fault for r in rows} == {NO_FAULT}


def test_the_latest_published_model_is_loaded_once(spark, events, tmp_path, monkeypatch):
    registry = str(tmp_path / "models")
    with pytest.raises(FileNotFoundError):
        scoring.latest_model(spark, registry)
    model = scoring.fit(events, scoring.classifier(maxIter=1))
    loads = []
    load = scoring.load_model
    monkeypatch.setattr(scoring, "load_model", lambda path: loads.append(path) or load(path))
    scoring.publish_model(model, registry, 3)
    assert [scoring.latest_model(spark, registry)[0] for _ in range(3)] == [3, 3, 3] and len(loads) == 1
    # What is saved but not published does not count.
    model.write().save(f"{registry}/batch_id=9/attempt=x")
    assert scoring.versioned_scores(events, registry).select("model_version").distinct().collect()[0][0] == 3
    scoring.publish_model(model, registry, 4)
    assert scoring.latest_model(spark, registry)[0] == 4 and len(loads) == 2
    # A version that is published again is read again.
    scoring.publish_model(model, registry, 4)
    scoring.latest_model(spark, registry)
    assert len(loads) == 3 and len([k for k in scoring._LOADED if k[0].startswith(registry)]) == 1
