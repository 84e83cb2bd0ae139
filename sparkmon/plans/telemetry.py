"""Deterministic telemetry view over the ``events`` table, used where no sensor table exists."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmon import constants as K

# Hash factors of the noise term (event, user) and the ramp after day 18.
NOISE = {
    "temperature_c": (7919, 13),
    "vibration_mm_s": (104729, 17),
    "spindle_load_pct": (6101, 19),
    "power_kw": (4409, 23),
    "acoustic_db": (2203, 29),
}
SEVERITY_NOISE = (3571, 41)
RAMP = {"temperature_c": 14.0, "vibration_mm_s": 2.5}
RAMP_DAY = 18
UNIFORM_WIDTH = 1.7320508
SURROGATE_OFFSET = 4.0

# The expressions below are common to Spark SQL and other engines; ``e0`` keeps them in double.
LABEL = "CASE WHEN event_type = 'error' AND event_id % 10 < 3 THEN 1 ELSE 0 END"
FAULT_INDEX = "(event_id + user_id) % 4"


def number(value: float) -> str:
    return f"{value!r}e0"


def _noise(factors: tuple[int, int]) -> str:
    return f"(((event_id*{factors[0]} + user_id*{factors[1]}) % 2001) - 1000) / 1000e0"


def sensor_sql(name: str, clip: bool = True) -> str:
    """Reading of one sensor: uniform noise, fault shift, drift ramp, optional clipping."""
    spec = K.SENSOR_SPECS[name]
    width = f"{number(spec['std'])}*{number(UNIFORM_WIDTH)}"
    terms = [number(spec["mean"]), f"{width}*{_noise(NOISE[name])}"]
    for i, signature in enumerate(K.FAULTS.values()):
        if name in signature:
            shift = f"{number(signature[name])}*(1e0 + 0.4e0*{_noise(SEVERITY_NOISE)})"
            terms.append(f"CASE WHEN label = 1 AND fk = {i} THEN {shift} ELSE 0e0 END")
    if name in RAMP:
        terms.append(f"{number(RAMP[name])}*greatest(0e0, (day(ts) - {RAMP_DAY})/12e0)")
    value = " + ".join(terms)
    if clip:
        value = f"least(greatest({value}, {number(spec['lo'])}), {number(spec['hi'])})"
    return f"{value} AS {name}"


def identity_sql() -> list[str]:
    site = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(K.SITES[:-1]))
    kind = " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(K.MACHINE_TYPES[:-1]))
    return [
        "CAST(event_id AS VARCHAR(20)) AS event_id",
        "ts AS event_time",
        f"CASE user_id % {len(K.SITES)} {site} ELSE '{K.SITES[-1]}' END AS site",
        f"CASE user_id % {len(K.MACHINE_TYPES)} {kind} ELSE '{K.MACHINE_TYPES[-1]}' END AS machine_type",
        "concat('M-', CAST(user_id AS VARCHAR(20))) AS machine_id",
    ]


def telemetry(events: DataFrame, clip: bool = True) -> DataFrame:
    """Sensor readings derived from each row of ``events``; a pure projection."""
    return events.selectExpr("*", f"{LABEL} AS label", f"{FAULT_INDEX} AS fk").selectExpr(
        *identity_sql(),
        *[sensor_sql(s, clip) for s in K.SENSORS],
        "label",
        "CASE WHEN label = 1 THEN fk END AS fault_k",
    )


def fault_type(fault_k: str = "fault_k") -> Column:
    """Name of the fault with the given position; NULL for healthy readings."""
    names = ", ".join(f"'{f}'" for f in K.FAULTS)
    return F.expr(f"get(array({names}), CAST({fault_k} AS INT))")


def as_events(view: DataFrame) -> DataFrame:
    """The view in the column order of the event schema."""
    return view.select(
        "event_id",
        "event_time",
        "site",
        "machine_id",
        "machine_type",
        *K.SENSORS,
        "label",
        fault_type().alias("fault_type"),
    )


def surrogate_sql() -> str:
    """Logistic function of the sum of elevated z-scores."""
    parts = []
    for s, spec in K.SENSOR_SPECS.items():
        z = f"(({s} - {number(spec['mean'])})/{number(spec['std'])})"
        parts.append(f"CASE WHEN {z} >= {number(K.ELEVATED_Z)} THEN {z} ELSE 0e0 END")
    return f"1e0/(1e0 + exp(-(({' + '.join(parts)}) - {number(SURROGATE_OFFSET)})))"


def surrogate_probability(view: DataFrame) -> DataFrame:
    """``anomaly_prob`` as a stand-in for a fitted model."""
    return view.selectExpr("*", f"{surrogate_sql()} AS anomaly_prob")
