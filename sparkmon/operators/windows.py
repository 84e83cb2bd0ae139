"""Tumbling-window metrics; the same function serves batch and stream."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmon import constants as K
from sparkmon.functions.sensors import valid


def window_metrics(
    events: DataFrame, window: str = K.WINDOW, watermark: str | None = None
) -> DataFrame:
    """Events and average sensor levels per window, site and machine type."""
    if watermark is not None:
        events = events.withWatermark("event_time", watermark)
    return (
        events.groupBy(F.window("event_time", window).alias("window"), "site", "machine_type")
        .agg(
            F.count(F.lit(1)).alias("events"),
            *[F.round(F.avg(valid(s)), 2).alias(f"avg_{s}") for s in K.SENSORS],
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "site",
            "machine_type",
            "events",
            *[f"avg_{s}" for s in K.SENSORS],
        )
    )
