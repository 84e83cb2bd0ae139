"""Feature reference, mean-shift drift and out-of-spec counts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmon import constants as K
from sparkmon.functions.sensors import out_of_spec, valid


def _stack(columns: dict[str, str], names: list[str]) -> Column:
    """One output row per sensor from wide ``<prefix><sensor>`` columns."""
    rows = [
        F.struct(
            F.lit(s).alias("sensor"),
            *[F.col(f"{prefix}{s}").alias(name) for name, prefix in columns.items()],
        )
        for s in names
    ]
    return F.inline(F.array(*rows))


def feature_reference(events: DataFrame) -> DataFrame:
    """Mean and sample standard deviation per sensor: always one row per sensor."""
    wide = events.agg(
        *[F.avg(valid(s)).alias(f"mean_{s}") for s in K.SENSORS],
        *[F.stddev_samp(valid(s)).alias(f"std_{s}") for s in K.SENSORS],
    )
    return wide.select(_stack({"mean": "mean_", "std": "std_"}, K.SENSORS))


def batch_statistics(events: DataFrame, batch: list[str], alert: Column | None = None) -> DataFrame:
    """One pass over the readings: event and alert counts, mean and out-of-spec per sensor.

    Sensors stay wide while the readings are aggregated and are unpivoted only afterwards, so the
    shuffle carries one partial row per batch and task.
    """
    alert = F.lit(False) if alert is None else alert
    return events.groupBy(*batch).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(alert).alias("n_alerts"),
        *[F.avg(valid(s)).alias(f"mean_{s}") for s in K.SENSORS],
        *[F.count_if(out_of_spec(s)).alias(f"oos_{s}") for s in K.SENSORS],
    )


def moments(
    events: DataFrame, keys: list[str], alert: Column | None = None, further: list[Column] | None = None
) -> DataFrame:
    """Counts, sums and sums of squares of shifted readings per key, which combine to any coarser key."""
    alert = F.lit(False) if alert is None else alert
    shifted = {s: valid(s) - F.lit(K.SENSOR_SPECS[s]["mean"]) for s in K.SENSORS}
    return events.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(alert).alias("n_alerts"),
        *[F.count(valid(s)).alias(f"n_{s}") for s in K.SENSORS],
        *[F.sum(shifted[s]).alias(f"sum_{s}") for s in K.SENSORS],
        *[F.sum(shifted[s] * shifted[s]).alias(f"sq_{s}") for s in K.SENSORS],
        *[F.count_if(out_of_spec(s)).alias(f"oos_{s}") for s in K.SENSORS],
        *(further or []),
    )


def _mean(s: str) -> Column:
    return F.lit(K.SENSOR_SPECS[s]["mean"]) + F.try_divide(F.sum(f"sum_{s}"), F.sum(f"n_{s}"))


def combined_statistics(parts: DataFrame, batch: list[str]) -> DataFrame:
    """What :func:`batch_statistics` gives, from :func:`moments` of a finer key."""
    return parts.groupBy(*batch).agg(
        F.sum("n_events").alias("n_events"),
        F.sum("n_alerts").alias("n_alerts"),
        *[_mean(s).alias(f"mean_{s}") for s in K.SENSORS],
        *[F.sum(f"oos_{s}").alias(f"oos_{s}") for s in K.SENSORS],
    )


def combined_reference(parts: DataFrame) -> DataFrame:
    """What :func:`feature_reference` gives, from :func:`moments`."""

    def deviation(s: str) -> Column:
        n, total, squares = (F.sum(f"{p}_{s}") for p in ("n", "sum", "sq"))
        return F.sqrt(F.greatest(F.lit(0.0), F.try_divide(squares - total * total / n, n - 1)))

    wide = parts.agg(
        *[_mean(s).alias(f"mean_{s}") for s in K.SENSORS],
        *[deviation(s).alias(f"std_{s}") for s in K.SENSORS],
    )
    return wide.select(_stack({"mean": "mean_", "std": "std_"}, K.SENSORS))


def drift_detail(
    statistics: DataFrame,
    reference: DataFrame,
    batch: list[str],
    z_threshold: float = K.DRIFT_Z_THRESHOLD,
) -> DataFrame:
    """Shift of each sensor's batch mean in reference standard deviations.

    ``reference`` is brought to one row per sensor, which bounds the broadcast.
    """
    reference = (
        reference.filter(F.col("sensor").isin(K.SENSORS))
        .groupBy("sensor")
        .agg(F.max("mean").alias("mean"), F.max("std").alias("std"))
    )
    long = statistics.select(
        *batch,
        "n_events",
        "n_alerts",
        _stack({"raw_mean": "mean_", "out_of_spec": "oos_"}, K.SENSORS),
    )
    joined = long.join(F.broadcast(reference), "sensor")
    scale = F.when(F.coalesce("std", F.lit(0.0)) == 0, 1.0).otherwise(F.col("std"))
    z = F.abs(F.col("raw_mean") - F.col("mean")) / scale
    return joined.select(
        *batch,
        "n_events",
        "n_alerts",
        "sensor",
        F.round("raw_mean", 3).alias("batch_mean"),
        F.round("mean", 3).alias("ref_mean"),
        F.round(z, 3).alias("drift_z"),
        F.coalesce(z > z_threshold, F.lit(False)).alias("drifted"),
        "out_of_spec",
    )


def drift_summary(detail: DataFrame, batch: list[str]) -> DataFrame:
    """Drifted sensors, largest rounded shift and out-of-spec readings per batch."""
    return detail.groupBy(*batch).agg(
        F.count_if("drifted").alias("n_drifted_sensors"),
        F.max("drift_z").alias("max_drift_z"),
        F.sum("out_of_spec").alias("total_out_of_spec"),
        F.max("n_events").alias("n_events"),
        F.max("n_alerts").alias("n_alerts"),
    )


def out_of_spec_counts(events: DataFrame) -> DataFrame:
    """Readings outside the spec band per sensor."""
    wide = events.agg(*[F.count_if(out_of_spec(s)).alias(f"oos_{s}") for s in K.SENSORS])
    return wide.select(_stack({"out_of_spec": "oos_"}, K.SENSORS))
