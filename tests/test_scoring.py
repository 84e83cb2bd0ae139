import random

import pytest
from pyspark.sql import functions as F

from sparkmon.operators import evaluate, scoring
from sparkmon.plans.run import model_scorer
from sparkmon.plans.train import train
from sparkmon.schema import REFERENCE_SCHEMA
from sparkmon.sources import files
from sparkmon.plans.telemetry import telemetry


@pytest.fixture(scope="module")
def rows(spark):
    view = telemetry(spark.read.parquet("/root/testdata/sf0.01/events.parquet").repartition(4))
    return view.filter(F.dayofmonth("event_time") <= 18).persist()


@pytest.fixture(scope="module")
def trained(rows):
    return train(rows, depths=[2, 3], folds=2, name="detector", version=1, iterations=5)


def test_hash_split_is_stable_and_complete(rows):
    a, b = scoring.hash_split(rows), scoring.hash_split(rows.repartition(7))
    assert a.train.count() + a.test.count() == rows.count()
    assert a.train.select("event_id").exceptAll(b.train.select("event_id")).count() == 0
    assert 0.77 < a.train.count() / rows.count() < 0.83
    for side in (a.train, a.test):
        assert side.select("label").distinct().count() == 2


def test_metrics_row(trained):
    row = trained.metrics.collect()[0]
    assert row["auc"] > 0.9 and row["precision"] > 0.8 and row["recall"] > 0.6
    assert row["best_max_depth"] in (2, 3) and row["cv_folds"] == 2 and row["n_train"] > 3000
    assert (row["registry_model"], row["registry_version"]) == ("detector", 1)


def test_each_depth_of_the_grid_takes_effect(rows):
    gbt = scoring.classifier(maxIter=2)
    tuned = scoring.cross_validate(rows, depths=[1, 4], folds=2, gbt=gbt)
    assert len(set(tuned.avgMetrics)) == 2
    best = [1, 4][tuned.avgMetrics.index(max(tuned.avgMetrics))]
    assert tuned.bestModel.stages[-1].getMaxDepth() == best


def test_feature_vector_width(trained, rows):
    # five sensors, four machine types and three sites ("keep" adds one level, the last is dropped)
    assert trained.model.stages[-1].numFeatures == 12
    scored = scoring.score(trained.model, rows)
    assert scored.columns[: len(rows.columns)] == rows.columns


def test_saved_model_scores_the_same(spark, rows, trained, tmp_path):
    trained.save(str(tmp_path))
    loaded = scoring.load_model(str(tmp_path / "model"))
    sample = rows.limit(200)
    a = scoring.score(trained.model, sample).select("event_id", "anomaly_prob", "prediction")
    b = scoring.score(loaded, sample).select("event_id", "anomaly_prob", "prediction")
    assert sorted(a.collect()) == sorted(b.collect())
    reference = files.read_reference(spark, str(tmp_path / "reference"))
    assert reference.schema == REFERENCE_SCHEMA and reference.count() == 5
    assert spark.read.json(str(tmp_path / "metrics")).collect()[0]["registry_version"] == 1


def test_fresh_rows_are_scored_well(spark, trained):
    fresh = telemetry(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    fresh = fresh.filter(F.dayofmonth("event_time") <= 18)
    stats = (
        scoring.score(trained.model, fresh)
        .agg(
            F.min("anomaly_prob"),
            F.max("anomaly_prob"),
            F.avg((F.col("prediction") == F.col("label")).cast("int")),
            F.count_if(~F.col("prediction").isin(0.0, 1.0)),
        )
        .collect()[0]
    )
    assert 0 <= stats[0] <= stats[1] <= 1 and stats[2] > 0.9 and stats[3] == 0


def test_model_scores_unseen_and_missing_categories(trained, rows):
    odd = rows.limit(3).withColumn("site", F.lit(None).cast("string")).withColumn("machine_type", F.lit("New"))
    assert scoring.score(trained.model, odd).filter("anomaly_prob BETWEEN 0 AND 1").count() == 3


def test_model_in_the_stream(spark, rows, trained, tmp_path):
    from sparkmon.streaming.queries import process_batch

    broken = rows.limit(300).withColumn(
        "acoustic_db",
        F.when(F.col("event_id").cast("int") % 50 == 0, None).otherwise(F.col("acoustic_db")),
    )
    process_batch(broken, 0, model_scorer(trained.model), trained.reference, str(tmp_path))
    log = files.read_drift_log(spark, f"{tmp_path}/drift").collect()[0]
    alerts = files.read_alerts(spark, f"{tmp_path}/alerts")
    assert log["n_events"] == 300 and log["n_alerts"] == alerts.count() > 0
    assert alerts.filter("anomaly_prob < 0.6 OR acoustic_db IS NULL").count() == 0


def predictions(spark, rows):
    return spark.createDataFrame(rows, "label double, prediction double, p double")


def test_confusion_and_ratios(spark):
    rows = [(1.0, 1.0, 0.9)] * 3 + [(0.0, 1.0, 0.8)] + [(1.0, 0.0, 0.2)] * 2 + [(0.0, 0.0, 0.1)] * 4
    row = evaluate.confusion(predictions(spark, rows)).collect()[0]
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (3, 1, 2, 4)
    assert row["precision"] == 0.75 and row["recall"] == 0.6 and row["accuracy"] == 0.7
    assert row["f1"] == pytest.approx(2 * 0.75 * 0.6 / 1.35)


def test_zero_denominators(spark):
    row = evaluate.confusion(predictions(spark, [(0.0, 0.0, 0.5)])).collect()[0]
    assert row["precision"] == row["recall"] == row["f1"] == 0.0 and row["accuracy"] == 1.0
    empty = evaluate.confusion(predictions(spark, [(0.0, 0.0, 0.5)]).limit(0)).collect()[0]
    assert empty["accuracy"] is None and empty["precision"] == 0.0


def test_exact_auc_counts_pairs(spark):
    rng = random.Random(1)
    rows = [(float(rng.random() < 0.3), 0.0, round(rng.random(), 2)) for _ in range(400)]
    pos = [p for label, _, p in rows if label == 1]
    neg = [p for label, _, p in rows if label == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    got = evaluate.roc_auc(predictions(spark, rows), "p", exact=True)
    assert got == pytest.approx(wins / (len(pos) * len(neg)), abs=1e-12)


def test_a_fit_uses_all_cores(spark, rows, monkeypatch):
    """Also where the rows come from one file or row group."""
    seen = []

    def looked_at(training, *args, **options):
        seen.extend(training.rdd.glom().map(len).collect())
        raise InterruptedError

    monkeypatch.setattr(scoring, "cross_validate", looked_at)
    with pytest.raises(InterruptedError):
        train(rows.coalesce(1))
    assert len(seen) >= spark.sparkContext.defaultParallelism and min(seen) > 0
