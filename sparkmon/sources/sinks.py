"""File sinks. A micro-batch is published by a commit log, so a replay changes nothing."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmon import constants as K
from sparkmon.sources.commits import Commit, fresh_folder, publish
from sparkmon.sources.wire import wire_columns


def write_attempt(df: DataFrame, path: str, batch_id: int, fmt: str = "json") -> str:
    """Write the output of one micro-batch to a fresh folder, which no reader takes before it is published."""
    folder = fresh_folder(path, batch_id)
    writer = df.write.format(fmt)
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false")
    writer.save(folder)
    return folder


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "json") -> None:
    """Replace the output of one micro-batch in one step, also when a replay yields no rows."""
    publish(df.sparkSession, path, Commit(batch_id, write_attempt(df, path, batch_id, fmt)))


def alert_log_rows(alerts: DataFrame) -> DataFrame:
    """Alerts with the event time as text."""
    return alerts.withColumn("event_time", F.col("event_time").cast("string"))


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines with NULL fields kept."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_event_files(
    events: DataFrame, path: str, events_per_file: int = K.EVENTS_PER_FILE
) -> int:
    """JSON-lines files in event order with at most ``events_per_file`` rows; returns their number.

    Rows are range-partitioned by time and id, so equal times spread over tasks too.
    """
    order = ["event_time", "event_id"]
    (
        wire_columns(events)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.option("maxRecordsPerFile", events_per_file)
        .option("ignoreNullFields", "false")
        .json(path)
    )
    written = events.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.json")
    return written.load(path).select("path").count()
