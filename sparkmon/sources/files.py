"""File sources with fixed schemas."""

from datetime import datetime
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmon import constants as K
from sparkmon import schema
from sparkmon.sources.commits import exists, read_committed
from sparkmon.sources.wire import parse_time

CORPUS_SCHEMA = "name string, text string"


def stream_json(
    spark: SparkSession, path: str, max_files: int | None = K.MAX_FILES_PER_TRIGGER
) -> DataFrame:
    """Typed event stream of a folder of JSON-lines files."""
    reader = spark.readStream.schema(schema.WIRE_SCHEMA)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return parse_time(reader.json(path))


def stream_events(
    spark: SparkSession, path: str, max_files: int | None = K.MAX_FILES_PER_TRIGGER
) -> DataFrame:
    """Stream of a typed event log that another query writes; only its committed files are read."""
    reader = spark.readStream.schema(read_json_schema(spark))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The typed event log as a table."""
    return _if_present(spark, path, "parquet", read_json_schema(spark))


def read_json_schema(spark: SparkSession) -> T.StructType:
    """Schema of parsed events."""
    return parse_time(spark.createDataFrame([], schema.WIRE_SCHEMA)).schema


def read_json(spark: SparkSession, path: str) -> DataFrame:
    return parse_time(spark.read.schema(schema.WIRE_SCHEMA).json(path))


def _if_present(
    spark: SparkSession, path: str, fmt: str, declared: T.StructType
) -> DataFrame:
    """Scan of a sink, empty while nothing has been written."""
    if not exists(spark, path):
        return spark.createDataFrame([], declared)
    return spark.read.schema(declared).format(fmt).load(path)


def read_alerts(spark: SparkSession, path: str, until: datetime | None = None) -> DataFrame:
    """Alert log with the event time parsed; with ``until`` without the batches that begin later."""
    return parse_time(read_committed(spark, path, "json", schema.ALERT_SCHEMA, until))


def read_drift_log(spark: SparkSession, path: str) -> DataFrame:
    return read_committed(spark, path, "json", schema.DRIFT_SUMMARY_SCHEMA)


def read_drift_detail(spark: SparkSession, path: str) -> DataFrame:
    return read_committed(spark, path, "json", schema.DRIFT_DETAIL_SCHEMA)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """Scores of a stream with the model version that made them."""
    return read_committed(spark, path, "parquet", schema.SCORE_SCHEMA)


def read_late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Readings that came after their window had been closed."""
    return parse_time(read_committed(spark, path, "json", schema.LATE_SCHEMA))


def read_window_metrics(spark: SparkSession, path: str) -> DataFrame:
    return _if_present(spark, path, "parquet", schema.WINDOW_METRICS_SCHEMA)


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.REFERENCE_SCHEMA).json(path)


def read_incidents(spark: SparkSession, path: str) -> DataFrame:
    return _if_present(spark, path, "json", schema.INCIDENT_SCHEMA)


def read_corpus(spark: SparkSession, path: str, glob: str = "*.md") -> DataFrame:
    """One row per guide file: name without suffix, whole text."""
    return (
        spark.read.option("pathGlobFilter", glob)
        .text(path, wholetext=True)
        .select(
            F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "").alias("name"),
            F.col("value").alias("text"),
        )
    )


def packaged_texts() -> list[tuple[str, str]]:
    folder = resources.files("sparkmon") / "guides"
    files = sorted((f for f in folder.iterdir() if f.name.endswith(".md")), key=lambda f: f.name)
    return [(f.name.removesuffix(".md"), f.read_text(encoding="utf-8")) for f in files]


def packaged_guides(spark: SparkSession) -> DataFrame:
    """The guides shipped with the package, for use without a shared corpus folder."""
    return spark.createDataFrame(packaged_texts(), CORPUS_SCHEMA)
