"""Roll-ups over the stored windows, alerts, drift log and incidents."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkmon import constants as K
from sparkmon.functions.text import preview
from sparkmon.operators.ranking import nth_smallest
from sparkmon.session import stage


def count_by(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), F.col(column))
    )


def throughput_by_site(windows: DataFrame) -> DataFrame:
    return windows.groupBy("site", "window_start").agg(F.sum("events").alias("events"))


def cursor_position(windows: DataFrame, cursor: int | None = None) -> DataFrame:
    """One row: the n-th distinct window start, the number of windows and the events up to it.

    ``windows`` is first combined to one staged row per window start, whatever the number of readings. The
    n-th of them is found by histograms over their range, so no task has to sort or number them.
    """
    starts = stage(windows.groupBy("window_start").agg(F.sum("events").alias("events")), "starts")
    visible = starts
    if cursor is not None:
        start = F.unix_micros(F.col("window_start").cast("timestamp"))
        now = nth_smallest(starts, start, cursor)
        visible = starts.filter(start <= F.lit(now).cast("long"))
    seen = visible.agg(
        F.max("window_start").alias("now"),
        F.count(F.lit(1)).alias("cursor"),
        F.coalesce(F.sum("events"), F.lit(0)).alias("events_seen"),
    )
    total = starts.select(F.count(F.lit(1))).scalar()
    return stage(seen.select("now", total.alias("n_windows"), "cursor", "events_seen"), "position")


def at_cursor(df: DataFrame, time_column: str, position: DataFrame) -> DataFrame:
    """Rows whose time is not after the cursor; all of them while there is no window yet."""
    now = position.select("now").scalar()
    return df.filter(now.isNull() | (F.col(time_column) <= now))


def drift_prefix(drift_log: DataFrame, position: DataFrame) -> DataFrame:
    """The first ``max(1, round(n * cursor / windows))`` batches of the drift log, found like the n-th window."""
    share = F.coalesce(F.try_divide("cursor", "n_windows"), F.lit(1.0))
    rows = drift_log.select(F.count(F.lit(1))).scalar()
    wanted = position.select(F.greatest(F.lit(1), F.bround(rows * share)).cast("int").alias("n"))
    last = nth_smallest(drift_log, F.col("batch_id"), wanted.first().n)
    return drift_log.filter(F.col("batch_id") <= F.lit(last).cast("long"))


def alerts_seen(alerts: DataFrame, position: DataFrame) -> Column:
    """Number of alerts at the cursor."""
    return at_cursor(alerts, "event_time", position).select(F.count(F.lit(1))).scalar()


def kpi_at_cursor(n_alerts: Column, drift_log: DataFrame, position: DataFrame) -> DataFrame:
    """Events seen, alerts, alert rate and drifted sensors at the cursor, in one row."""
    prefix = drift_prefix(drift_log, position)
    drifted = prefix.select(F.coalesce(F.max_by("n_drifted_sensors", "batch_id"), F.lit(0))).scalar()
    return position.select(
        "now", "n_windows", "events_seen", n_alerts.alias("n_alerts"), drifted.alias("drifted_sensors")
    ).withColumn("alert_rate_pct", percentage(F.col("n_alerts"), F.col("events_seen")))


def percentage(part: Column, whole: Column) -> Column:
    return F.coalesce(F.round(F.try_divide(part, whole) * 100, 2), F.lit(0.0))


def top_alerts_seen(
    alerts: DataFrame, visible_alerts: DataFrame, n: int = K.TOP_INCIDENTS
) -> DataFrame:
    """The ``n`` most probable alerts of machines with a visible alert.

    Only a machine's own ``n`` best can be among the ``n`` best of all, and that cut is applied
    within each task before the shuffle, so a machine with many alerts stays cheap.
    """
    order = [F.col("anomaly_prob").desc(), F.col("event_id")]
    per_machine = Window.partitionBy("machine_id").orderBy(*order)
    best = (
        alerts.withColumn("rank", F.row_number().over(per_machine))
        .filter(F.col("rank") <= n)
        .drop("rank")
    )
    machines = visible_alerts.select("machine_id").distinct()
    return best.join(machines, "machine_id", "left_semi").orderBy(*order).limit(n)


def with_preview(incidents: DataFrame) -> DataFrame:
    """Incidents, most probable first, with the start of the action."""
    return incidents.orderBy(F.col("alert_prob").desc(), F.col("event_id")).withColumn(
        "action_preview", preview("recommended_action")
    )


def machine_totals(events: DataFrame) -> DataFrame:
    """Events, labels present and anomalies per machine, all that a run summary needs of them."""
    return events.groupBy("site", "machine_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("label").alias("labelled"),
        F.sum("label").alias("anomalies"),
    )


def incident_totals(incidents: DataFrame) -> DataFrame:
    return incidents.groupBy("likely_cause", "severity").agg(F.count(F.lit(1)).alias("n"))


def run_summary(
    machines: DataFrame, n_alerts: Column, incident_counts: DataFrame, drift_log: DataFrame
) -> DataFrame:
    """One row that describes a whole run, from :func:`machine_totals` and :func:`incident_totals`."""
    total = machines.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_events"),
        F.sum("labelled").alias("labelled"),
        F.sum("anomalies").alias("anomalies"),
        F.array_sort(F.collect_set("site")).alias("sites"),
        F.count_distinct("machine_id").alias("machines"),
    )
    log = drift_log.agg(
        F.count(F.lit(1)).alias("batches"),
        F.coalesce(F.max_by("n_drifted_sensors", "batch_id"), F.lit(0)).alias("drifted"),
    )
    tail = drift_log.orderBy(F.col("batch_id").desc()).limit(K.TAIL_BATCHES)

    def counts(column: str) -> Column:
        per_value = incident_counts.groupBy(column).agg(F.sum("n").alias("n"))
        entries = F.array_sort(F.collect_list(F.struct(column, "n")))
        return per_value.select(F.map_from_entries(entries)).scalar()

    def only(df: DataFrame, column: Column) -> Column:
        return df.select(column).scalar()

    return (
        total.withColumn("n_alerts", n_alerts)
        .withColumn(
            "n_incidents", only(incident_counts, F.coalesce(F.sum("n"), F.lit(0)))
        )
        .select(
            "n_events",
            "n_alerts",
            percentage(F.col("n_alerts"), F.col("n_events")).alias("alert_rate_pct"),
            percentage(F.col("anomalies"), F.col("labelled")).alias("true_anomaly_rate_pct"),
            "n_incidents",
            counts("likely_cause").alias("incidents_by_cause"),
            counts("severity").alias("incidents_by_severity"),
            "sites",
            "machines",
            only(log, F.col("batches")).alias("drift_batches"),
            F.round(only(tail, F.coalesce(F.max("max_drift_z"), F.lit(0.0))), 2).alias(
                "max_drift_z_end"
            ),
            only(log, F.col("drifted")).alias("drifted_at_end"),
        )
    )
