"""Fault signatures from a table with validity in time, matched without exploding readings."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmon import constants as K
from sparkmon.session import broadcast_if_small, stage

MASKS = 1 << len(K.SENSORS)


def elevation_mask() -> Column:
    """One bit per sensor whose ``z_<sensor>`` is set."""
    bits = " + ".join(f"CASE WHEN z_{s} IS NOT NULL THEN {1 << i} ELSE 0 END" for i, s in enumerate(K.SENSORS))
    return F.expr(bits)


def compile_signatures(signatures: DataFrame) -> DataFrame:
    """Inverted lookup ``day, mask, entries``: the signatures that share a sensor with a set of elevated sensors.

    ``signatures`` has a row ``fault, ordinal, sensor, weight, valid_from, valid_until`` per sensor of a signature;
    it holds from ``valid_from`` until before ``valid_until``, both of which have to be set. There is a row per day and
    set of sensors that any signature applies to, so its size depends on the signatures and not on the readings.
    """
    weights = [
        F.coalesce(F.sum(F.when(F.col("sensor") == s, F.col("weight"))), F.lit(0.0)).alias(f"w_{s}") for s in K.SENSORS
    ]
    held = signatures.filter("valid_from < valid_until AND sensor IS NOT NULL AND weight IS NOT NULL")
    wide = held.groupBy("fault", "ordinal", "valid_from", "valid_until").agg(*weights)
    mask = F.expr(" + ".join(f"CASE WHEN w_{s} <> 0 THEN {1 << i} ELSE 0 END" for i, s in enumerate(K.SENSORS)))
    days = F.expr("explode(sequence(to_date(valid_from), to_date(valid_until - INTERVAL 1 MICROSECOND)))")
    entry = F.struct("ordinal", "fault", "valid_from", "valid_until", *[f"w_{s}" for s in K.SENSORS])
    per_day = wide.withColumn("own", mask).select("own", entry.alias("entry"), days.alias("day"))
    meets = F.expr(f"explode(filter(sequence(1, {MASKS - 1}), m -> (m & own) <> 0))")
    return per_day.select("day", meets.alias("mask"), "entry").groupBy("day", "mask").agg(
        F.collect_list("entry").alias("entries")
    )


def match_signatures(elevated: DataFrame, signatures: DataFrame) -> DataFrame:
    """Adds ``fault``: the valid signature with the highest weighted sum of elevated z, lowest ordinal on ties.

    ``elevated`` are readings with ``z_<sensor>`` columns. Each reading meets at most one row of the compiled
    lookup, by a broadcast if its staged size allows it. Without a valid signature of a positive score the fault is
    the neutral one. Scores are compared after rounding to six decimals.
    """
    lookup = stage(compile_signatures(signatures), "signatures").withColumnsRenamed({"day": "sig_day", "mask": "sig_mask"})
    score = " + ".join(f"coalesce(z_{s}, 0D) * e.w_{s}" for s in K.SENSORS)
    best = F.expr(
        "array_max(transform(filter(entries, e -> event_time >= e.valid_from AND event_time < e.valid_until), "
        f"e -> named_struct('score', round({score}, 6), 'tie', -e.ordinal, 'fault', e.fault)))"
    )
    here = (F.to_date("event_time") == F.col("sig_day")) & (elevation_mask() == F.col("sig_mask"))
    return (
        elevated.join(broadcast_if_small(lookup), here, "left")
        .withColumn("best", best)
        .withColumn("fault", F.when(F.col("best.score") > 0, F.col("best.fault")).otherwise(K.NO_FAULT))
        .drop("best", "entries", "sig_day", "sig_mask")
    )
