"""Every query with a SQL counterpart equals it on the whole tables."""

import pytest

from pyspark.sql import functions as F

from __spark_entry__ import entry
from sparkmon.plans import catalog
from sparkmon.plans.catalog import PLANS
from sparkmon.plans.oracles import ORACLES
from sparkmon.streaming import queries
from tests.oracle_check import differences

# Quality floors hold from some thousand events on.
LARGER = {"gbt_quality", "gbt_cv_metrics"}


def test_every_query_has_a_counterpart():
    assert set(PLANS) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, folder, name):
    folder = folder.replace("sf0.001", "sf0.01") if name in LARGER else folder
    assert differences(PLANS[name](spark, folder), folder, ORACLES[name]) == []


# Scans of ``events`` in the plans that read them most; what is staged before counts too.
@pytest.mark.parametrize("name", ["run_summary", "kpi_at_cursor", "top_incidents", "drift_prefix", "incidents"])
def test_events_are_read_at_most_twice(spark, folder, name, monkeypatch):
    read = []
    table = catalog.table
    monkeypatch.setattr(catalog, "table", lambda s, f, t: read.append(t) or table(s, f, t))
    plan = PLANS[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert read.count("events") <= 2 and "events.parquet" not in plan


def test_the_reference_period_reaches_the_scan(spark, folder):
    plan = PLANS["feature_reference"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(ts," in plan


def test_days_of_different_months_are_different_batches(spark, folder, tmp_path):
    events = spark.read.parquet(f"{folder}/events.parquet")
    later = events.withColumn("ts", F.expr("ts + INTERVAL 31 DAYS"))
    events.unionByName(later).write.parquet(str(tmp_path / "events.parquet"))
    days = PLANS["drift_summary"](spark, str(tmp_path))
    expected = events.unionByName(later).select(F.to_date("ts")).distinct().count()
    assert days.count() == expected


@pytest.mark.parametrize("name", ["stream_alerts", "stream_late"])
def test_streams_read_a_table_of_many_files(spark, folder, tmp_path, name):
    events = spark.read.parquet(f"{folder}/events.parquet")
    events.repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    whole = sorted(tuple(r) for r in PLANS[name](spark, folder).collect())
    parts = sorted(tuple(r) for r in PLANS[name](spark, str(tmp_path)).collect())
    assert whole and parts == whole
    if name == "stream_alerts":
        assert len({row[-1] for row in whole}) == catalog.STREAM_PARTS


def test_only_cosine_scoring_names_a_fault_within_another(spark, folder):
    faults = {n: {r.fault for r in PLANS[n](spark, folder).collect()} for n in ("fault_match", "fault_match_cosine")}
    assert "coolant_loss" not in faults["fault_match"] and "coolant_loss" in faults["fault_match_cosine"]


def test_entry_reports_incidents(spark):
    df = entry(spark)
    assert {"event_id", "likely_cause", "recommended_action"} <= set(df.columns)
    assert df.count() > 0


def many_events(spark, path, rows=20_000):
    """Readings over ten days, far more than ``K.EVENTS_PER_FILE``."""
    columns = [
        "id AS event_id",
        "timestamp_ntz'2024-01-10 00:00:00' + make_dt_interval(0, 0, 0, id * 40) AS ts",
        "id % 90 AS user_id",
        "IF(id % 7 = 0, 'error', 'view') AS event_type",
        "0D AS value",
        "'' AS props",
    ]
    spark.range(rows).selectExpr(*columns).write.parquet(f"{path}/events.parquet")
    return str(path)


def test_end_to_end_batches_do_not_grow_with_the_events(spark, tmp_path, monkeypatch):
    batches, process = [], queries.process_batch
    monkeypatch.setattr(queries, "process_batch", lambda *a, **k: batches.append(a[1]) or process(*a, **k))
    row = PLANS["end_to_end_summary"](spark, many_events(spark, tmp_path)).first()
    assert row.n_events == 20_000 and row.n_alerts == row.n_incidents > 0
    assert 0 < len(batches) <= 2 * catalog.STREAM_PARTS


@pytest.mark.parametrize("name", ["stream_late", "stream_late_rows"])
def test_streams_are_fed_with_few_files(spark, tmp_path, monkeypatch, name):
    counts, write = [], catalog.sinks.write_event_files
    monkeypatch.setattr(catalog.sinks, "write_event_files", lambda *a: counts.append(write(*a)) or counts[-1])
    folder = many_events(spark, tmp_path)
    assert PLANS[name](spark, folder).count() == 1
    assert len(counts) == catalog.STREAM_PARTS and sum(counts) <= 4 * catalog.STREAM_PARTS
