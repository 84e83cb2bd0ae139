import os

import pytest

from sparkmon import session


def test_session_is_pinned_to_utc_and_adaptive(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_shared_folder_is_the_configured_one(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == folder
    a, b = session.fresh_dir(spark, "x"), session.fresh_dir(spark, "x")
    assert a != b and a.startswith(folder)


def test_shared_folder_must_be_named_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "spark://host:7077"

    class Cluster:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster())


def test_staged_table_keeps_rows_and_schema(spark):
    df = spark.range(100).selectExpr("id", "CAST(NULL AS STRING) AS s")
    staged = session.stage(df, "t")
    assert staged.dtypes == df.dtypes and staged.count() == 100


def test_broadcast_follows_the_staged_size(spark):
    staged = session.stage(spark.range(10), "t")
    assert session.is_small(staged)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not session.is_small(staged)
        assert session.broadcast_if_small(staged) is staged
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_staged_folders_can_be_removed(spark):
    staged = session.stage(spark.range(3), "gone")
    path = staged.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    session.remove_staged(spark)
    assert not os.path.exists(path)


def test_scratch_folders_go_with_their_block(spark):
    with session.scratch(spark):
        kept = session.stage(spark.range(3), "kept", outlives=True)
        with session.scratch(spark):
            inner = session.fresh_dir(spark, "inner", outlives=True)
            os.makedirs(inner)
        gone = session.stage(spark.range(4), "gone")
        path = gone.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert os.path.exists(path) and os.path.exists(inner)
    assert not os.path.exists(path) and not os.path.exists(inner)
    assert kept.count() == 3


def test_scratch_folders_go_after_a_failure(spark):
    with pytest.raises(ValueError):
        with session.scratch(spark):
            path = session.fresh_dir(spark, "failed")
            os.makedirs(path)
            raise ValueError
    assert not os.path.exists(path)
