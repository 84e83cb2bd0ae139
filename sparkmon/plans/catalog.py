"""Named plans over the given tables; each takes ``(spark, table_dir)`` and returns a DataFrame."""

from collections.abc import Callable
from datetime import date

from pyspark import StorageLevel
from pyspark.errors import StreamingQueryException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkmon import constants as K
from sparkmon.functions import sensors
from sparkmon.functions.text import guide_action
from sparkmon.operators import drift as drift_ops
from sparkmon.operators import evaluate, incidents, monitor, scoring
from sparkmon.operators.ranking import running_maximum
from sparkmon.operators.retrieval import retrieve_best, term_weights
from sparkmon.operators.signatures import match_signatures
from sparkmon.operators.text_index import build_index, merge_indexes
from sparkmon.operators.windows import window_metrics
from sparkmon.plans.run import run_files
from sparkmon.plans.telemetry import as_events, surrogate_probability, telemetry
from sparkmon.plans.train import train
from sparkmon.session import fresh_dir, stage
from sparkmon.sources import files, sinks, wire
from sparkmon.streaming.open_windows import all_windows
from sparkmon.streaming.queries import (
    late_rows_dropped,
    start_model_scores,
    start_scoring,
    start_window_metrics,
)

Plan = Callable[[SparkSession, str], DataFrame]

#: The drift reference and the rows a classifier may be fitted on end before these times.
REFERENCE_END = date(2024, 1, 16)
TRAIN_END = date(2024, 1, 19)
EPOCH = date(1970, 1, 1)
#: Parts in which the events arrive at the streams; each is one micro-batch of a restarted query.
STREAM_PARTS = 3
#: Rows per JSON file the streams are fed with. Listing, opening and committing cost a file as much as a hundred
#: thousand rows, so files of ``K.EVENTS_PER_FILE`` rows would cost more than the rows in them.
DELIVERED_PER_FILE = 500_000
CURSOR = 500
TOP_N = 50
DAY = ["batch_id"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def view(spark: SparkSession, folder: str, clip: bool = True) -> DataFrame:
    return telemetry(table(spark, folder, "events"), clip)


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return surrogate_probability(view(spark, folder))


def alerts(spark: SparkSession, folder: str) -> DataFrame:
    return incidents.alerts(scored(spark, folder))


def staged_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """The alerts, written once for plans that read them several times."""
    return stage(alerts(spark, folder), "alerts")


def before(events: DataFrame, end: date) -> DataFrame:
    return events.filter(F.col("event_time") < F.to_timestamp_ntz(F.lit(f"{end} 00:00:00")))


def day(column: str = "event_time") -> Column:
    """Whole days since the epoch."""
    return F.unix_date(F.to_date(column)).cast("long")


def is_alert() -> Column:
    return F.col("anomaly_prob") >= K.ALERT_PROB_THRESHOLD


def drift_of(parts: DataFrame) -> DataFrame:
    """Drift per day from moments that have a ``batch_id`` among their keys."""
    reference = drift_ops.combined_reference(parts.filter(F.col("batch_id") < (REFERENCE_END - EPOCH).days))
    return drift_ops.drift_detail(drift_ops.combined_statistics(parts, DAY), reference, DAY)


def hourly_moments(spark: SparkSession, folder: str) -> DataFrame:
    """All that the cursor views need of the events, in one staged row or two per hour."""
    hour = F.window("event_time", "1 hour")["start"]
    rows = scored(spark, folder).withColumn("window_start", hour)
    rows = rows.withColumn("at_start", F.col("event_time") == F.col("window_start"))
    parts = drift_ops.moments(rows, ["window_start", "at_start"], is_alert())
    return stage(parts.withColumn("batch_id", day("window_start")), "hours")


def window_metrics_1m(spark: SparkSession, folder: str) -> DataFrame:
    return window_metrics(view(spark, folder), "1 minute")


def window_metrics_1h(spark: SparkSession, folder: str) -> DataFrame:
    return window_metrics(view(spark, folder), "1 hour")


def feature_reference(spark: SparkSession, folder: str) -> DataFrame:
    return drift_ops.feature_reference(before(view(spark, folder), REFERENCE_END))


def rounded_reference(spark: SparkSession, folder: str) -> DataFrame:
    return feature_reference(spark, folder).select(
        "sensor", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std")
    )


def drift_detail(spark: SparkSession, folder: str) -> DataFrame:
    rows = scored(spark, folder).withColumn("batch_id", day())
    return drift_of(stage(drift_ops.moments(rows, DAY, is_alert()), "days"))


def drift_summary(spark: SparkSession, folder: str) -> DataFrame:
    return drift_ops.drift_summary(drift_detail(spark, folder), DAY)


def out_of_spec(spark: SparkSession, folder: str) -> DataFrame:
    return drift_ops.out_of_spec_counts(view(spark, folder, clip=False))


def elevated_sensors(spark: SparkSession, folder: str) -> DataFrame:
    return incidents.elevated_rows(view(spark, folder))


def fault_match(spark: SparkSession, folder: str) -> DataFrame:
    return sensors.with_elevation(view(spark, folder)).select(
        "event_id", sensors.fault().alias("fault")
    )


def fault_match_cosine(spark: SparkSession, folder: str) -> DataFrame:
    return sensors.with_elevation(view(spark, folder)).select(
        "event_id", sensors.fault("cosine").alias("fault")
    )


def learned_signatures(spark: SparkSession, folder: str) -> DataFrame:
    """A signature per site, machine type and day with known faults: their mean elevated z, for a week from that day."""
    rows = sensors.with_elevation(view(spark, folder).filter("label = 1"))
    keys = ["site", "machine_type", "day"]
    means = rows.withColumn("day", F.to_date("event_time")).groupBy(*keys).agg(
        *[F.round(F.avg(f"z_{s}"), 4).alias(s) for s in K.SENSORS]
    )
    fault = F.concat_ws(" ", "machine_type", "site", F.col("day").cast("string"))
    named = means.withColumns(
        {
            "fault": fault,
            # Sites and types differ in their initials, which order signatures of a day.
            "ordinal": F.unix_date("day") * 100000 + F.ascii("machine_type") * 200 + F.ascii("site"),
            "valid_from": F.col("day").cast("timestamp_ntz"),
            "valid_until": F.expr("CAST(day AS TIMESTAMP_NTZ) + INTERVAL 7 DAYS"),
        }
    )
    return named.unpivot(["fault", "ordinal", "valid_from", "valid_until"], K.SENSORS, "sensor", "weight")


def fault_match_table(spark: SparkSession, folder: str) -> DataFrame:
    """Faults of all readings by signatures that the data themselves have taught."""
    readings = sensors.with_elevation(view(spark, folder))
    return match_signatures(readings, learned_signatures(spark, folder)).select("event_id", "fault")


def symptom_severity(spark: SparkSession, folder: str) -> DataFrame:
    return incidents.classify(scored(spark, folder)).select(
        "event_id", "symptom", "severity", "query_text"
    )


def alert_rows(spark: SparkSession, folder: str) -> DataFrame:
    return alerts(spark, folder).withColumn("anomaly_prob", F.round("anomaly_prob", 6))


def tfidf_terms(spark: SparkSession, folder: str) -> DataFrame:
    terms = term_weights(table(spark, folder, "documents"), "text")
    return terms.withColumn("idf", F.round("idf", 6))


def tfidf_top1(spark: SparkSession, folder: str) -> DataFrame:
    corpus = table(spark, folder, "documents")
    queries = table(spark, folder, "benchmark").select("item_id", F.col("text").alias("query"))
    best = retrieve_best(corpus, "doc_id", "text", queries, "item_id", "query")
    return best.withColumn("score", F.round("score", 6))


def tfidf_index_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Terms of an index that was merged from the indexes of documents with even and with odd ids."""
    corpus = table(spark, folder, "documents")
    halves = [
        build_index(corpus.filter(F.pmod("doc_id", F.lit(2)) == half), "doc_id", "text", fresh_dir(spark, "index"))
        for half in range(2)
    ]
    merged = merge_indexes(halves, fresh_dir(spark, "index"))
    return merged.terms.select("token", "df", F.round("idf", 6).alias("idf"), F.round("bound", 6).alias("bound"))


def sectioned_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents laid out as guides; every third one is left without sections."""
    heading = F.concat(F.lit("# "), F.col("source"), F.lit("\n\n## Symptoms\n"), F.col("text"))
    action = F.concat(F.lit("\n\n## Recommended Action\n  "), F.col("text"), F.lit("\n"))
    sectioned = F.concat(heading, action)
    return table(spark, folder, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 3 == 0, F.col("text")).otherwise(sectioned).alias("text"),
    )


def section_action(spark: SparkSession, folder: str) -> DataFrame:
    return sectioned_documents(spark, folder).select(
        "doc_id", guide_action("text").alias("recommended_action")
    )


def incident_reports(spark: SparkSession, folder: str) -> DataFrame:
    return incidents.incidents(staged_alerts(spark, folder), files.packaged_guides(spark))


def rounded_incidents(spark: SparkSession, folder: str) -> DataFrame:
    return incident_reports(spark, folder).withColumn("alert_prob", F.round("alert_prob", 6))


def incidents_topn(spark: SparkSession, folder: str) -> DataFrame:
    best = stage(incidents.top_alerts(alerts(spark, folder), TOP_N), "top-alerts")
    top = incidents.incidents(best, files.packaged_guides(spark))
    return top.withColumn("alert_prob", F.round("alert_prob", 6))


def incidents_by_cause(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.count_by(incident_reports(spark, folder), "likely_cause")


def incidents_by_severity(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.count_by(incident_reports(spark, folder), "severity")


def throughput_by_site(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.throughput_by_site(window_metrics_1h(spark, folder))


def alerts_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.count_by(alerts(spark, folder), "machine_type")


def position(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.cursor_position(window_metrics_1h(spark, folder), CURSOR)


def hourly_position(hours: DataFrame) -> DataFrame:
    windows = hours.select("window_start", F.col("n_events").alias("events"))
    return monitor.cursor_position(windows, CURSOR)


def kpi_at_cursor(spark: SparkSession, folder: str) -> DataFrame:
    hours = hourly_moments(spark, folder)
    where = hourly_position(hours)
    now = where.select("now").scalar()
    start = F.col("window_start")
    visible = now.isNull() | (start < now) | ((start == now) & F.col("at_start"))
    n_alerts = hours.select(F.coalesce(F.sum(F.when(visible, F.col("n_alerts"))), F.lit(0))).scalar()
    log = stage(drift_ops.drift_summary(drift_of(hours), DAY), "drift-log")
    return monitor.kpi_at_cursor(n_alerts, log, where)


def throughput_at_cursor(spark: SparkSession, folder: str) -> DataFrame:
    """Events per site and minute up to the cursor, which counts minutes here."""
    windows = stage(window_metrics_1m(spark, folder).select("site", "window_start", "events"), "minutes")
    where = monitor.cursor_position(windows, CURSOR)
    return monitor.throughput_by_site(monitor.at_cursor(windows, "window_start", where))


def alerts_by_type_at_cursor(spark: SparkSession, folder: str) -> DataFrame:
    seen = monitor.at_cursor(alerts(spark, folder), "event_time", position(spark, folder))
    return monitor.count_by(seen, "machine_type")


def top_incidents(spark: SparkSession, folder: str) -> DataFrame:
    raised = staged_alerts(spark, folder)
    visible = monitor.at_cursor(raised, "event_time", position(spark, folder))
    best = stage(monitor.top_alerts_seen(raised, visible), "top-alerts")
    shown = monitor.with_preview(incidents.incidents(best, files.packaged_guides(spark)))
    return shown.withColumn("alert_prob", F.round("alert_prob", 6))


def drift_prefix(spark: SparkSession, folder: str) -> DataFrame:
    hours = hourly_moments(spark, folder)
    log = stage(drift_ops.drift_summary(drift_of(hours), DAY), "drift-log")
    return monitor.drift_prefix(log, hourly_position(hours))


def summary_text(row: DataFrame) -> DataFrame:
    """A run summary with its maps and its array as text, for comparison as plain values."""

    def text(column: str) -> Column:
        pairs = F.array_sort(F.map_entries(column))
        return F.array_join(
            F.transform(pairs, lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ","
        )

    maps = ["incidents_by_cause", "incidents_by_severity"]
    return row.withColumns({m: text(m) for m in maps}).withColumn(
        "sites", F.array_join("sites", ",")
    )


def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Two passes over the events: one for the alerts, one for everything else."""
    raised = staged_alerts(spark, folder)
    rows = scored(spark, folder).withColumn("batch_id", day())
    keys = ["batch_id", "site", "machine_id"]
    labels = [F.count("label").alias("labelled"), F.sum("label").alias("anomalies")]
    parts = stage(drift_ops.moments(rows, keys, is_alert(), labels), "machine-days")
    machines = parts.groupBy("site", "machine_id").agg(
        F.sum("n_events").alias("n"), F.sum("labelled").alias("labelled"), F.sum("anomalies").alias("anomalies")
    )
    reports = incidents.incidents(raised, files.packaged_guides(spark))
    row = monitor.run_summary(
        machines,
        parts.select(F.coalesce(F.sum("n_alerts"), F.lit(0))).scalar(),
        stage(monitor.incident_totals(reports), "incident-totals"),
        stage(drift_ops.drift_summary(drift_of(parts), DAY), "drift-log"),
    )
    return summary_text(row)


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Surrogate scores with the decision at the alert threshold."""
    flag = (F.col("anomaly_prob") >= K.ALERT_PROB_THRESHOLD).cast("double")
    return scored(spark, folder).select("label", "anomaly_prob", flag.alias("prediction"))


def confusion(spark: SparkSession, folder: str) -> DataFrame:
    ratios = {c: F.round(c, 6) for c in ("precision", "recall", "f1", "accuracy")}
    return evaluate.confusion(predictions(spark, folder)).withColumns(ratios)


def auc_exact(spark: SparkSession, folder: str) -> DataFrame:
    ranked = predictions(spark, folder).select(
        F.col("label").cast("double").alias("label"),
        F.round("anomaly_prob", 9).alias("anomaly_prob"),
    )
    return evaluate.exact_auc(ranked, "anomaly_prob").select(F.round("auc", 6).alias("auc"))


def json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    decoded = wire.decode(wire.encode(as_events(view(spark, folder))))
    return decoded.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected wire rows by reason, after damaging a fixed share of the encoded events."""
    key = F.col("key").cast("long")
    damaged = (
        F.when(key % 97 == 0, F.lit("{broken"))
        .when(key % 89 == 0, F.regexp_replace("value", '"event_time":"[^"]*"', '"event_time":"soon"'))
        .when(key % 83 == 0, F.regexp_replace("value", '"power_kw":[^,]*', '"power_kw":null'))
        .otherwise(F.col("value"))
    )
    sent = wire.encode(as_events(view(spark, folder))).select(damaged.alias("value"))
    return monitor.count_by(wire.quarantined_rows(wire.decode(sent)), "reason")


def event_files(spark: SparkSession, folder: str) -> DataFrame:
    """Events read back from JSON-lines files, counted per machine type.

    With it whether the files keep to their row limit and follow one another in time.
    """
    path = fresh_dir(spark, "event-files")
    sinks.write_event_files(as_events(view(spark, folder)), path)
    rows = files.read_json(spark, path).withColumn("file", F.col("_metadata.file_name"))
    per_file = stage(
        rows.groupBy("file").agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("event_time").alias("first"),
            F.max("event_time").alias("last"),
        ),
        "file-ranges",
    )
    bounded = per_file.select(F.max("rows") <= K.EVENTS_PER_FILE).scalar()
    # A file may begin at the time at which an earlier one ends, and no sooner.
    by_name = running_maximum(per_file.withColumn("last", F.unix_micros(F.col("last").cast("timestamp"))), F.col("file"), "last")
    late = F.col("before_last") > F.unix_micros(F.col("first").cast("timestamp"))
    ordered = by_name.select(F.coalesce(F.max(late), F.lit(False)) == F.lit(False)).scalar()
    return monitor.count_by(rows, "machine_type").withColumns(
        {"within_limit": bounded, "in_order": ordered}
    )


def stream_parts(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The events in ``STREAM_PARTS`` consecutive stretches of days, as they would arrive."""
    events = as_events(view(spark, folder))
    ends = events.agg(F.min(day()).alias("low"), F.max(day()).alias("high")).first()
    if ends.low is None:
        return [events]
    width = (ends.high - ends.low) // STREAM_PARTS + 1
    part = F.floor((day() - ends.low) / width)
    return [events.filter(part == number) for number in range(STREAM_PARTS)]


def late_event(events: DataFrame) -> DataFrame:
    """The first event once more under another id, to arrive behind the watermark."""
    first = events.orderBy("event_time", "event_id").limit(1)
    return first.withColumn("event_id", F.lit("late"))


def deliver(parts: list[DataFrame], root: str, start: Callable[[DataFrame], StreamingQuery]) -> StreamingQuery:
    """Write one part after the other as JSON files; the query restarts from its checkpoint each time."""
    for number, part in enumerate(parts):
        sinks.write_event_files(part, f"{root}/in/part-{number}", DELIVERED_PER_FILE)
        query = start(files.stream_json(part.sparkSession, f"{root}/in/*", max_files=None))
        query.awaitTermination()
    return query


def window_stream(spark: SparkSession, folder: str) -> tuple[str, StreamingQuery]:
    root = fresh_dir(spark, "stream-windows")
    parts = stream_parts(spark, folder)
    parts[-1] = parts[-1].unionByName(late_event(parts[0]))
    query = deliver(parts, root, lambda e: start_window_metrics(e, f"{root}/data", f"{root}/checkpoint"))
    return root, query


def stream_window_metrics(spark: SparkSession, folder: str) -> DataFrame:
    root, _ = window_stream(spark, folder)
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    return files.read_window_metrics(spark, f"{root}/data").withColumns(times)


def stream_window_metrics_closed(spark: SparkSession, folder: str) -> DataFrame:
    """All windows at the end of the source: those the watermark closed, and the others from the stream's state."""
    root, _ = window_stream(spark, folder)
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    return all_windows(spark, f"{root}/data", f"{root}/checkpoint").withColumns(times)


def stream_late(spark: SparkSession, folder: str) -> DataFrame:
    """Events in finished windows, and rows dropped behind the watermark."""
    root, query = window_stream(spark, folder)
    dropped = late_rows_dropped(query)
    return files.read_window_metrics(spark, f"{root}/data").agg(
        F.sum("events").alias("events"), F.lit(dropped).cast("long").alias("late_rows")
    )


def run_scoring_stream(spark: SparkSession, folder: str, with_late_row: bool = False) -> str:
    root = fresh_dir(spark, "stream-scoring")
    reference = stage(feature_reference(spark, folder), "reference")
    parts = stream_parts(spark, folder)
    if with_late_row:
        parts[-1] = parts[-1].unionByName(late_event(parts[0]))
    deliver(
        parts,
        root,
        lambda e: start_scoring(e, surrogate_probability, reference, root, f"{root}/checkpoint"),
    )
    return root


def logged_alerts(alert_log: DataFrame) -> DataFrame:
    return alert_log.withColumn("anomaly_prob", F.round("anomaly_prob", 6)).withColumn(
        "event_time", F.col("event_time").cast("timestamp_ntz")
    )


def stream_alerts(spark: SparkSession, folder: str) -> DataFrame:
    root = run_scoring_stream(spark, folder)
    return logged_alerts(files.read_alerts(spark, f"{root}/alerts"))


def stream_alerts_replayed(spark: SparkSession, folder: str) -> DataFrame:
    """The alerts of a stream whose every micro-batch dies once between writing and publishing."""
    root = fresh_dir(spark, "stream-replayed")
    reference = stage(feature_reference(spark, folder), "reference")
    died: set[int] = set()

    def die_once(batch_id: int) -> None:
        if batch_id not in died:
            died.add(batch_id)
            raise InterruptedError(f"micro-batch {batch_id} is cut off")

    def start(events: DataFrame) -> StreamingQuery:
        for _ in range(2):
            query = start_scoring(
                events, surrogate_probability, reference, root, f"{root}/checkpoint", before_publish=die_once
            )
            try:
                query.awaitTermination()
                break
            except StreamingQueryException:
                continue  # the checkpoint still has the batch open, so the next start replays it
        return query

    deliver(stream_parts(spark, folder), root, start)
    return logged_alerts(files.read_alerts(spark, f"{root}/alerts"))


def stream_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The readings that came after their window had been closed."""
    root = run_scoring_stream(spark, folder, with_late_row=True)
    late = files.read_late_rows(spark, f"{root}/late")
    return late.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


def logged_alerts_at_cursor(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts by machine type up to the cursor, from the stream's log; batches that begin later are not read."""
    root = run_scoring_stream(spark, folder)
    where = stage(position(spark, folder), "cursor")
    now = where.first().now
    seen = files.read_alerts(spark, f"{root}/alerts", until=now)
    seen = seen.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    return monitor.count_by(monitor.at_cursor(seen, "event_time", where), "machine_type")


def stream_drift(spark: SparkSession, folder: str) -> DataFrame:
    root = run_scoring_stream(spark, folder)
    return files.read_drift_log(spark, f"{root}/drift")


def end_to_end_summary(spark: SparkSession, folder: str) -> DataFrame:
    """JSON files through both streams with the surrogate score, then incidents and the summary.

    The files arrive in ``STREAM_PARTS`` micro-batches, which grow with the events; their number does not.
    """
    root = fresh_dir(spark, "end-to-end")
    written = sinks.write_event_files(as_events(view(spark, folder)), f"{root}/in", DELIVERED_PER_FILE)
    row = run_files(
        spark,
        f"{root}/in",
        surrogate_probability,
        stage(feature_reference(spark, folder), "reference"),
        files.packaged_guides(spark),
        f"{root}/run",
        max_files=max(1, -(-written // STREAM_PARTS)),
    )
    return summary_text(row).drop("drift_batches", "max_drift_z_end", "drifted_at_end")


def training_split(spark: SparkSession, folder: str) -> scoring.Split:
    """The labelled rows a model is fitted on, and every other row.

    Only rows before ``TRAIN_END`` on the training side of the hash are fitted on; all others are
    scored.
    """
    events = view(spark, folder)
    split = scoring.hash_split(before(events, TRAIN_END))
    sides = scoring.hash_split(events)
    late = sides.train.filter(F.col("event_time") >= F.to_timestamp_ntz(F.lit(f"{TRAIN_END} 00:00:00")))
    return scoring.Split(split.train, sides.test.unionByName(late))


def feature_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The standardised features of every event, fitted on the training rows."""
    split = training_split(spark, folder)
    columns = [c for c in scoring.INPUT_COLUMNS if c != "label"]
    shared = scoring.fit_features(split.train.select(columns))
    rows = view(spark, folder).select(columns)
    values = vector_to_array(F.col("features"))
    width = shared.transform(split.train.select(columns).limit(1)).first()["features"].size
    return shared.transform(rows).select(
        "event_id", *[F.round(values[i], 6).alias(f"f{i}") for i in range(width)]
    )


def gbt_predictions(spark: SparkSession, folder: str) -> DataFrame:
    split = training_split(spark, folder)
    training = scoring.spread(split.train).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = scoring.fit(training)
    finally:
        training.unpersist()
    return scoring.score(model, split.test)


def gbt_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Every row outside the training set, and whether its score is a probability."""
    scores = gbt_predictions(spark, folder)
    return scores.select("event_id", "label", F.col("anomaly_prob").between(0.0, 1.0).alias("in_range"))


def gbt_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Rows scored with one boosted model, and whether it is as good as the data allow."""
    known = F.col("event_time") < F.to_timestamp_ntz(F.lit(f"{TRAIN_END} 00:00:00"))
    scores = gbt_predictions(spark, folder).select("label", "prediction", "anomaly_prob", known.alias("known"))
    scores = stage(scores, "scores")
    # Later rows drift away from what the model has seen, so the floors hold for its own period.
    auc = evaluate.roc_auc(scores.filter("known"), "anomaly_prob")
    right = F.when(F.col("known"), (F.col("label") == F.col("prediction")).cast("double"))
    return scores.agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.sum("label").cast("long").alias("positives"),
        (F.avg(right) > 0.9).alias("accurate"),
        F.lit(auc > 0.9).alias("ranks_well"),
    )


def gbt_cv_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Tuned training: rows fitted on, the folds, and whether the tuned model meets its floors."""
    metrics = train(before(view(spark, folder), TRAIN_END)).metrics
    return metrics.select(
        "model",
        "cv_folds",
        "n_train",
        F.col("best_max_depth").isin(K.GBT_DEPTHS).alias("depth_in_grid"),
        (F.col("auc") > 0.9).alias("ranks_well"),
    )


def model_reload(spark: SparkSession, folder: str) -> DataFrame:
    """Scores that differ after a model was saved and loaded again, over all events."""
    path = fresh_dir(spark, "model")
    events = view(spark, folder)
    training = scoring.spread(training_split(spark, folder).train).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = scoring.fit(training, scoring.classifier(maxIter=2))
    finally:
        training.unpersist()
    scoring.save_model(model, path)
    kept = scoring.score(model, events).select("event_id", "anomaly_prob")
    loaded = scoring.score(scoring.load_model(path), events).select(
        "event_id", F.col("anomaly_prob").alias("again")
    )
    return kept.join(loaded, "event_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("anomaly_prob") != F.col("again")).alias("differing")
    )


def stream_model_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Readings per micro-batch and model version, and how many scores are not those of that version.

    A second version is published after the first part of the events has been scored.
    """
    root = fresh_dir(spark, "stream-model")
    registry = f"{root}/models"
    training = scoring.spread(training_split(spark, folder).train).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        models = {v: scoring.fit(training, scoring.classifier(maxIter=v)) for v in (1, 2)}
    finally:
        training.unpersist()
    started = []

    def start(events: DataFrame) -> StreamingQuery:
        if len(started) < len(models):
            version = len(started) + 1
            scoring.publish_model(models[version], registry, version)
        started.append(events)
        return start_model_scores(events, registry, f"{root}/scores", f"{root}/checkpoint")

    deliver(stream_parts(spark, folder), root, start)
    logged = files.read_scores(spark, f"{root}/scores")
    events = view(spark, folder)
    for version, model in models.items():
        again = scoring.score(model, events).select("event_id", F.col("anomaly_prob").alias(f"by_{version}"))
        logged = logged.join(again, "event_id")
    own = F.when(F.col("model_version") == 1, F.col("by_1")).otherwise(F.col("by_2"))
    return logged.groupBy("batch_id", "model_version").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("anomaly_prob") != own).alias("differing")
    )


PLANS: dict[str, Plan] = {
    "window_metrics_1m": window_metrics_1m,
    "window_metrics_1h": window_metrics_1h,
    "feature_reference": rounded_reference,
    "drift_detail": drift_detail,
    "drift_summary": drift_summary,
    "out_of_spec": out_of_spec,
    "elevated_sensors": elevated_sensors,
    "fault_match": fault_match,
    "fault_match_cosine": fault_match_cosine,
    "fault_match_table": fault_match_table,
    "symptom_severity": symptom_severity,
    "alerts": alert_rows,
    "tfidf_terms": tfidf_terms,
    "tfidf_top1": tfidf_top1,
    "tfidf_index_merge": tfidf_index_merge,
    "section_action": section_action,
    "incidents": rounded_incidents,
    "incidents_topn": incidents_topn,
    "incidents_by_cause": incidents_by_cause,
    "incidents_by_severity": incidents_by_severity,
    "throughput_by_site": throughput_by_site,
    "alerts_by_type": alerts_by_type,
    "throughput_at_cursor": throughput_at_cursor,
    "alerts_by_type_at_cursor": alerts_by_type_at_cursor,
    "kpi_at_cursor": kpi_at_cursor,
    "top_incidents": top_incidents,
    "drift_prefix": drift_prefix,
    "run_summary": run_summary,
    "confusion": confusion,
    "auc_exact": auc_exact,
    "json_roundtrip": json_roundtrip,
    "quarantine": quarantine,
    "event_files": event_files,
    "stream_window_metrics": stream_window_metrics,
    "stream_window_metrics_closed": stream_window_metrics_closed,
    "stream_late": stream_late,
    "stream_alerts": stream_alerts,
    "stream_alerts_replayed": stream_alerts_replayed,
    "stream_late_rows": stream_late_rows,
    "logged_alerts_at_cursor": logged_alerts_at_cursor,
    "stream_drift": stream_drift,
    "end_to_end_summary": end_to_end_summary,
    "feature_vectors": feature_vectors,
    "gbt_quality": gbt_quality,
    "model_reload": model_reload,
    "stream_model_scores": stream_model_scores,
    "gbt_scores": gbt_scores,
    "gbt_cv_metrics": gbt_cv_metrics,
}
