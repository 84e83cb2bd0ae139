"""Per-reading column expressions: z-scores, elevation, fault match, severity, symptom.

Everything here is a narrow projection; no reading is exploded or shuffled to be classified. The
expressions are SQL text, which costs one call per column when a micro-batch plan is built.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmon import constants as K


def valid_sql(column: str) -> str:
    """NaN as NULL, so that aggregates skip it and comparisons with it are not true."""
    return f"nanvl({column}, CAST(NULL AS DOUBLE))"


def valid(column: str) -> Column:
    return F.expr(valid_sql(column))


def zscore_sql(sensor: str) -> str:
    spec = K.SENSOR_SPECS[sensor]
    return f"(({valid_sql(sensor)} - {spec['mean']}D) / {spec['std']}D)"


def out_of_spec(sensor: str) -> Column:
    """Strictly outside the spec band; the bounds themselves are in spec."""
    spec, value = K.SENSOR_SPECS[sensor], valid_sql(sensor)
    return F.expr(f"{value} < {spec['lo']}D OR {value} > {spec['hi']}D")


def with_elevation(events: DataFrame, z_min: float = K.ELEVATED_Z) -> DataFrame:
    """Adds ``z_<sensor>``: the rounded z where the unrounded z reaches ``z_min``, else NULL."""
    return events.selectExpr(
        "*",
        *[
            f"CASE WHEN {zscore_sql(s)} >= {float(z_min)}D THEN round({zscore_sql(s)}, 2) END AS z_{s}"
            for s in K.SENSORS
        ],
    )


def elevated_sensors() -> Column:
    """``array<struct<z, tie, sensor>>``, most elevated first, ties in sensor order.

    Descending order puts the entries of normal sensors, which are NULL, last; the slice ends
    before them.
    """
    entries = ", ".join(
        f"CASE WHEN z_{s} IS NOT NULL THEN named_struct('z', z_{s}, 'tie', {-i}, 'sensor', '{s}') END"
        for i, s in enumerate(K.SENSORS)
    )
    count = " + ".join(f"CAST(z_{s} IS NOT NULL AS INT)" for s in K.SENSORS)
    return F.expr(f"slice(sort_array(array({entries}), false), 1, {count})")


def signature_weights(signature: dict[str, float]) -> dict[str, float]:
    """A fault's shifts in standard deviations, at unit length."""
    shifts = {s: shift / K.SENSOR_SPECS[s]["std"] for s, shift in signature.items()}
    length = math.sqrt(sum(v * v for v in shifts.values()))
    return {s: v / length for s, v in shifts.items()}


def fault(scoring: str = "sum") -> Column:
    """Fault whose signature fits the elevated z best; first declared on ties.

    ``sum`` adds up the elevated z of the signature's sensors. ``cosine`` weighs them by the signature at
    unit length, which orders faults by the angle to the reading and so can name a fault whose sensors
    are a subset of another's. The neutral entry precedes all faults in tie order, so a fault needs a
    positive score.
    """
    if scoring not in ("sum", "cosine"):
        raise ValueError(f"unknown scoring {scoring!r}")
    candidates = [f"named_struct('score', 0D, 'tie', 1, 'fault', '{K.NO_FAULT}')"]
    for i, (name, signature) in enumerate(K.FAULTS.items()):
        weights = signature_weights(signature) if scoring == "cosine" else dict.fromkeys(signature, 1.0)
        score = " + ".join(f"coalesce(z_{s}, 0D) * {w!r}D" for s, w in weights.items())
        candidates.append(f"named_struct('score', {score}, 'tie', {-i}, 'fault', '{name}')")
    return F.expr(f"greatest({', '.join(candidates)}).fault")


def probability_sql(column: str = "anomaly_prob") -> str:
    """A missing probability counts as zero."""
    return f"coalesce({valid_sql(column)}, 0D)"


def severity(column: str = "anomaly_prob") -> Column:
    prob = probability_sql(column)
    return F.expr(
        f"CASE WHEN {prob} >= {K.CRITICAL_PROB} THEN 'critical' "
        f"WHEN {prob} >= {K.WARNING_PROB} THEN 'warning' ELSE 'watch' END"
    )


def words(name: Column) -> Column:
    return F.replace(name, F.lit("_"), F.lit(" "))


def symptom(elevated: str, top: int = K.TOP_SYMPTOMS) -> Column:
    """Text of the most elevated sensors, such as ``power kw +2.0σ, acoustic db +1.25σ``.

    From ten million on, the text of a double has an exponent; the decimal type has none.
    """
    parts = []
    for i in range(top):
        z = f"get({elevated}, {i}).z"
        large = f"regexp_replace(CAST(CAST({z} AS DECIMAL(38, 2)) AS STRING), '0$', '')"
        text = f"CASE WHEN {z} < 1e7 THEN CAST({z} AS STRING) ELSE {large} END"
        parts.append(f"concat(replace(get({elevated}, {i}).sensor, '_', ' '), ' +', {text}, 'σ')")
    return F.expr(f"coalesce(nullif(concat_ws(', ', {', '.join(parts)}), ''), '{K.NO_SYMPTOM}')")


def query_text() -> Column:
    """Words of the machine type and of every elevated sensor, in sensor order.

    Bag-of-words retrieval ignores word order, so the fixed order keeps the number of distinct
    queries at (machine types) x 2^sensors however many readings there are.
    """
    keywords = ", ".join(
        f"CASE WHEN z_{s} IS NOT NULL THEN '{K.SENSOR_KEYWORDS.get(s, s)}' END" for s in K.SENSORS
    )
    return F.expr(f"concat_ws(' ', replace(machine_type, '_', ' '), {keywords})")
