"""Windows that a running or finished stream still holds open, read from its state."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmon import constants as K
from sparkmon.sources import files


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Metrics so far of the windows that the watermark has not closed, from the last finished micro-batch.

    The state keeps the number of events and, per sensor, the sum and the number of its valid values, in the order
    of the aggregates of :func:`sparkmon.operators.windows.window_metrics`. It is read as a table and not
    changed: a restarted stream goes on with it. ``spark`` needs the state store provider of the stream.
    """
    state = spark.read.format("statestore").load(checkpoint)
    parts = [T.StructField("events", T.LongType())]
    for sensor in K.SENSORS:
        parts += [T.StructField(f"sum_{sensor}", T.DoubleType()), T.StructField(f"n_{sensor}", T.LongType())]
    held = state.select("key.*", F.col("value").cast(T.StructType(parts)).alias("held"))
    window, site, machine_type = held.columns[:3]
    means = [
        F.round(F.try_divide(f"held.sum_{s}", F.col(f"held.n_{s}").cast("double")), 2).alias(f"avg_{s}")
        for s in K.SENSORS
    ]
    return held.select(
        F.col(f"`{window}`.start").alias("window_start"),
        F.col(f"`{window}`.end").alias("window_end"),
        F.col(f"`{site}`").alias("site"),
        F.col(f"`{machine_type}`").alias("machine_type"),
        F.col("held.events").alias("events"),
        *means,
    )


def all_windows(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """Finished windows with ``closed`` true, and those still open with what they hold so far.

    A window leaves the state in the micro-batch that writes it, so each is there once when no batch is running.
    """
    finished = files.read_window_metrics(spark, path).withColumn("closed", F.lit(True))
    return finished.unionByName(open_windows(spark, checkpoint).withColumn("closed", F.lit(False)))
