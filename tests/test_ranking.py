"""Running totals, n-th values and the exact AUC against direct computations."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from sparkmon.operators.evaluate import exact_auc, roc_auc
from sparkmon.operators.ranking import nth_smallest, running_maximum, running_totals


@pytest.fixture(scope="module")
def numbers():
    pick = random.Random(4)
    groups = ["hot"] * 6 + ["a", "b", None, ""]
    return [(i, pick.choice(groups), pick.randrange(-50, 50), pick.randrange(100)) for i in range(3000)]


def test_running_totals_within_hot_and_null_groups(spark, numbers):
    df = spark.createDataFrame(numbers, "id long, g string, v long, w long").repartition(7)
    got = {r.id: (r.before_v, r.before_w) for r in running_totals(df, [F.col("w"), F.col("id")], ["v", "w"], ["g"]).collect()}
    assert len(got) == len(numbers)
    for g in {n[1] for n in numbers}:
        rows = sorted((n for n in numbers if n[1] == g), key=lambda n: (n[3], n[0]))
        sums = itertools.accumulate(((n[2], n[3]) for n in rows), lambda s, n: (s[0] + n[0], s[1] + n[1]), initial=(0, 0))
        assert [got[n[0]] for n in rows] == list(sums)[:-1]


def test_running_totals_of_a_whole_table_and_of_an_empty_one(spark, numbers):
    df = spark.createDataFrame(numbers, "id long, g string, v long, w long").repartition(5)
    got = {r.id: r.before_v for r in running_totals(df, [F.col("id").desc()], ["v"]).collect()}
    total = 0
    for i, _, v, _ in reversed(numbers):
        assert got[i] == total
        total += v
    assert running_totals(df.limit(0), [F.col("id")], ["v"]).collect() == []


def test_running_maximum(spark, numbers):
    df = spark.createDataFrame(numbers, "id long, g string, v long, w long").repartition(5)
    got = {r.id: r.before_v for r in running_maximum(df, F.col("id"), "v").collect()}
    expected = [None, *itertools.accumulate((n[2] for n in numbers), max)][:-1]
    assert [got[i] for i in range(len(numbers))] == expected


@pytest.mark.parametrize("buckets", [2, 7, 1024])
def test_nth_smallest(spark, numbers, buckets):
    values = [n[2] * 10**12 + n[3] for n in numbers] + [-(2**62), 2**61]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long")
    for n in (1, 2, 1500, len(values), len(values) + 9) if buckets == 1024 else (1500,):
        assert nth_smallest(df, F.col("v"), n, buckets) == sorted(values)[min(n, len(values)) - 1]
    assert nth_smallest(df.filter("v IS NULL"), F.col("v"), 1) is None


def test_exact_auc_equals_the_pairs_and_needs_no_job_to_plan(spark):
    pick = random.Random(9)
    rows = [(float(pick.random() < 0.2), round(pick.gauss(0, 1), 1) + 0.0) for _ in range(700)]
    rows += [(None, 0.3), (1.0, None), (0.0, float("nan"))]
    df = spark.createDataFrame(rows, "label double, score double").repartition(6)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("auc", "auc")
    try:
        plan = exact_auc(df, "score")
        assert not tracker.getJobIdsForGroup("auc")
        got = plan.collect()[0].auc
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    known = [r for r in rows if None not in r and r[1] == r[1]]
    pos, neg = ([s for label, s in known if label == x] for x in (1.0, 0.0))
    want = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / len(pos) / len(neg)
    assert got == pytest.approx(want, abs=1e-12)
    assert roc_auc(spark.createDataFrame(known, df.schema), "score", exact=True) == pytest.approx(want)
    assert exact_auc(df.filter("label = 1"), "score").collect()[0].auc is None
    assert exact_auc(df.limit(0), "score").collect()[0].auc is None
