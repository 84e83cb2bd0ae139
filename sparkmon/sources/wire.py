"""JSON wire format: encode, decode and quarantine."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmon.operators.scoring import is_scorable
from sparkmon.schema import WIRE_SCHEMA


def iso_time(column: str | Column) -> Column:
    """Zone-less ISO-8601 text with microseconds only where there are any."""
    full = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.regexp_replace(full, r"\.0{6}$", "")


def wire_columns(events: DataFrame) -> DataFrame:
    """The wire fields in schema order, with the event time as text."""
    return events.select(
        *[
            iso_time("event_time").alias("event_time")
            if f.name == "event_time"
            else F.col(f.name).cast(f.dataType)
            for f in WIRE_SCHEMA
        ]
    )


def encode(events: DataFrame, column: str = "value") -> DataFrame:
    """One JSON object per event, NULL fields included."""
    fields = F.struct(*[f.name for f in WIRE_SCHEMA])
    return wire_columns(events).select(
        F.col("event_id").alias("key"),
        F.to_json(fields, {"ignoreNullFields": "false"}).alias(column),
    )


def parse_time(rows: DataFrame) -> DataFrame:
    """Event time as a timestamp; text that is no time becomes NULL."""
    return rows.withColumn("event_time", F.try_to_timestamp(F.col("event_time")))


def decode(raw: DataFrame, column: str = "value") -> DataFrame:
    """Text or binary JSON to typed events; malformed input becomes a row of NULLs.

    Flattening with ``inline`` keeps later filters above the parse. A filter on ``e.*`` fields
    would be pushed below the projection and parse the text once per field.
    """
    parsed = F.from_json(F.col(column).cast("string"), WIRE_SCHEMA)
    return parse_time(raw.select(F.inline(F.array(parsed))))


def is_valid() -> Column:
    """Rows that can be windowed and scored."""
    return F.col("event_id").isNotNull() & F.col("event_time").isNotNull() & is_scorable()


def quarantined_rows(events: DataFrame) -> DataFrame:
    """Rows that cannot be used, with the reason."""
    return events.filter(~is_valid()).withColumn(
        "reason",
        F.when(F.col("event_id").isNull(), "unreadable")
        .when(F.col("event_time").isNull(), "event time")
        .otherwise("sensor value"),
    )
