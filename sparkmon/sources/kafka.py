"""Kafka source and sink. They need Spark's Kafka connector on the class path."""

from pyspark.sql import DataFrame, SparkSession

from sparkmon.sources.wire import decode, encode


def read_kafka(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest"
) -> DataFrame:
    """Typed event stream of a topic."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .load()
    )
    return decode(raw)


def write_kafka(events: DataFrame, servers: str, topic: str) -> None:
    """Publish events, keyed by event id so that a hot machine does not fill one partition."""
    (
        encode(events)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )
