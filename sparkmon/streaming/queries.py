"""The two streaming queries: window metrics, and scoring with alerts and drift."""

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkmon import constants as K
from sparkmon.functions.sensors import valid_sql
from sparkmon.operators.drift import batch_statistics, drift_detail, drift_summary
from sparkmon.operators.incidents import alerts
from sparkmon.operators.scoring import versioned_scores
from sparkmon.operators.windows import window_metrics
from sparkmon.schema import IDENTITY, SCORE_SCHEMA
from sparkmon.sources.commits import Commit, commits, publish
from sparkmon.sources.sinks import alert_log_rows, write_attempt, write_batch
from sparkmon.sources.wire import is_valid, quarantined_rows

Scorer = Callable[[DataFrame], DataFrame]


def start_window_metrics(
    events: DataFrame,
    path: str,
    checkpoint: str,
    window: str = K.WINDOW,
    watermark: str = K.WATERMARK,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append each window to Parquet once the watermark has passed its end."""
    return (
        window_metrics(events, window, watermark)
        .writeStream.queryName("window_metrics")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def score_rows(batch: DataFrame, score: Scorer) -> DataFrame:
    """Readings with ``anomaly_prob``, NULL where a reading cannot be scored.

    The model sees the nominal level in place of a missing sensor value, so that one narrow pass
    serves all rows; the reading itself and the missing probability are restored afterwards.
    """
    held = batch.select(*IDENTITY, F.struct(*K.SENSORS).alias("reading"), is_valid().alias("valid"))
    filled = held.withColumns(
        {
            s: F.expr(f"coalesce({valid_sql(f'reading.{s}')}, {K.SENSOR_SPECS[s]['mean']}D)")
            for s in K.SENSORS
        }
    )
    return score(filled).select(
        *IDENTITY, "reading.*", F.when(F.col("valid"), F.col("anomaly_prob")).alias("anomaly_prob")
    )


def closed_before(spark: SparkSession, out: str, batch_id: int, watermark: str) -> Column:
    """Time up to which windows were closed when a micro-batch began, from the commits of those before it."""
    last = [c.last for c in commits(spark, f"{out}/late") if c.batch_id < batch_id and c.last is not None]
    if not last:
        return F.lit(None).cast("timestamp")
    return F.timestamp_micros(F.lit(max(last)).cast("long")) - F.expr(f"INTERVAL {watermark}")


def process_batch(
    batch: DataFrame,
    batch_id: int,
    score: Scorer,
    reference: DataFrame,
    out: str,
    threshold: float = K.ALERT_PROB_THRESHOLD,
    window: str = K.WINDOW,
    watermark: str = K.WATERMARK,
    before_publish: Callable[[int], None] | None = None,
) -> None:
    """Score one micro-batch and publish its alerts, drift, late and quarantined readings.

    The batch is read and scored once and kept, spilling to disk, for the passes that follow. All outputs are
    written before the first is published; ``before_publish`` is called in between. Readings that cannot be
    scored still count as events and in their valid sensors. A reading is late if its window was closed
    when the batch began; it is scored like the others and kept in a log of its own as well.
    """
    spark = batch.sparkSession
    scored = score_rows(batch, score).persist(StorageLevel.MEMORY_AND_DISK)
    detail = None
    hit = F.col("anomaly_prob") >= threshold
    time = F.unix_micros(F.col("event_time").cast("timestamp"))
    try:
        seen = scored.agg(
            F.count(F.lit(1)).alias("n"),
            F.min(time).alias("first"),
            F.max(time).alias("last"),
            F.min(F.when(hit, time)).alias("first_alert"),
            F.max(F.when(hit, time)).alias("last_alert"),
        ).first()
        if seen.n == 0:
            return
        written = []

        def write(name: str, rows: DataFrame, *times: int | None) -> None:
            path = f"{out}/{name}"
            written.append((path, Commit(batch_id, write_attempt(rows, path, batch_id), *times)))

        write("alerts", alert_log_rows(alerts(scored, threshold)), seen.first_alert, seen.last_alert)
        key = ["batch_id"]
        statistics = batch_statistics(
            scored.withColumn("batch_id", F.lit(batch_id).cast("long")), key, hit
        )
        detail = drift_detail(statistics, reference, key).persist(StorageLevel.MEMORY_AND_DISK)
        write("drift_detail", detail.drop("batch_id", "n_events", "n_alerts"), seen.first, seen.last)
        write("drift", drift_summary(detail, key).drop("batch_id"), seen.first, seen.last)
        write("quarantine", alert_log_rows(quarantined_rows(scored)).drop("anomaly_prob"), seen.first, seen.last)
        closed = closed_before(spark, out, batch_id, watermark)
        late = scored.filter(F.window(F.col("event_time").cast("timestamp"), window)["end"] <= closed).drop("anomaly_prob")
        write("late", alert_log_rows(late), seen.first, seen.last)
        if before_publish is not None:
            before_publish(batch_id)
        for path, commit in written:
            publish(spark, path, commit)
    finally:
        scored.unpersist()
        if detail is not None:
            detail.unpersist()


def start_scoring(
    events: DataFrame,
    score: Scorer,
    reference: DataFrame,
    out: str,
    checkpoint: str,
    threshold: float = K.ALERT_PROB_THRESHOLD,
    trigger: dict | None = None,
    before_publish: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Alerts, drift, late and quarantined readings per micro-batch."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, batch_id, score, reference, out, threshold, before_publish=before_publish)

    return (
        events.writeStream.queryName("scoring")
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_model_scores(
    events: DataFrame, registry: str, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Score each micro-batch with the model version that is published when it begins.

    A new version takes over at the next batch, without a restart. ``path`` gets ``event_id``, ``anomaly_prob`` and
    ``model_version`` as a committed log; readings that cannot be scored are left out.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        scores = versioned_scores(batch, registry).select(*SCORE_SCHEMA.names[:-1])
        write_batch(scores, path, batch_id, "parquet")

    return (
        events.writeStream.queryName("model_scores")
        .foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def start_ingest(
    events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append parsed events to a typed log that other queries read, so that the source is parsed once."""
    return (
        events.writeStream.queryName("ingest")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def late_rows_dropped(query: StreamingQuery) -> int:
    """Rows that came after the watermark, over the progress the query still holds.

    Spark keeps the last hundred entries; the log of late rows that :func:`process_batch` writes has them all.
    """
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
