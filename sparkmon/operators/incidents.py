"""Alerts to incident reports whose action is quoted from a maintenance guide."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmon import constants as K
from sparkmon.functions import sensors
from sparkmon.functions.text import guide_action
from sparkmon.operators.retrieval import cosine_scores
from sparkmon.session import broadcast_if_small, stage


def alerts(scored: DataFrame, threshold: float = K.ALERT_PROB_THRESHOLD) -> DataFrame:
    """Readings at or above the alert threshold."""
    return scored.filter(F.col("anomaly_prob") >= threshold).select(
        "event_id",
        "event_time",
        "site",
        "machine_id",
        "machine_type",
        *K.SENSORS,
        "anomaly_prob",
    )


def top_alerts(alert_rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` most probable alerts."""
    return alert_rows.orderBy(
        F.coalesce("anomaly_prob", F.lit(0.0)).desc(), F.col("event_id")
    ).limit(n)


def elevated_rows(events: DataFrame, z_min: float = K.ELEVATED_Z) -> DataFrame:
    """One row per elevated sensor of a reading, with its rank in the reading."""
    elevated = F.posexplode(sensors.elevated_sensors()).alias("pos", "entry")
    return sensors.with_elevation(events, z_min).select("event_id", elevated).select(
        "event_id",
        (F.col("pos") + 1).alias("position"),
        F.col("entry.sensor").alias("sensor"),
        F.col("entry.z").alias("z"),
    )


def classify(alert_rows: DataFrame) -> DataFrame:
    """Fault, severity, symptom and retrieval query of every alert, without a shuffle."""
    return (
        sensors.with_elevation(alert_rows)
        .select(
            *alert_rows.columns,
            sensors.elevated_sensors().alias("elevated"),
            sensors.fault().alias("fault"),
            sensors.severity().alias("severity"),
            sensors.query_text().alias("query_text"),
        )
        .withColumn("symptom", sensors.symptom("elevated"))
    )


def grounding(
    queries: DataFrame, guides: DataFrame, stop_words: list[str] | None = None
) -> DataFrame:
    """Guide, cause, action and similarity per distinct ``(query_text, fault)``.

    The guide of a matched fault is used with its own similarity; an inconclusive match takes the
    most similar guide and adopts it as the cause.
    """
    texts = queries.select("query_text", F.col("query_text").alias("words")).distinct()
    scores = cosine_scores(
        guides, "name", "text", texts, "query_text", "words", stop_words, small_corpus=True
    )
    mapping = F.create_map(*[F.lit(x) for pair in K.FAULT_GUIDES.items() for x in pair])
    asked = queries.withColumn("forced", F.try_element_at(mapping, F.col("fault")))
    key = ["query_text", "fault", "forced"]
    # Guides without a shared token score zero: the forced one, and the first one as a last resort.
    names = guides.select("name")
    similar = asked.join(scores, "query_text").select(*key, "name", "score")
    forced = asked.join(names, F.col("forced") == F.col("name")).withColumn("score", F.lit(0.0))
    first = asked.select(
        *key, names.select(F.min("name")).scalar().alias("name"), F.lit(0.0).alias("score")
    )
    order = F.struct(
        F.coalesce(F.col("name") != F.col("forced"), F.lit(True)).alias("other"),
        (-F.col("score")).alias("negated"),
        "name",
    )
    chosen = (
        similar.unionByName(forced)
        .unionByName(first)
        .groupBy(*key)
        .agg(F.min(order).alias("best"))
        .select(*key, "best.name", (-F.col("best.negated")).alias("score"))
    )
    actions = guides.select("name", guide_action("text").alias("recommended_action"))
    return chosen.join(actions, "name").select(
        "query_text",
        "fault",
        sensors.words(
            F.when(F.col("forced").isNull(), F.col("name")).otherwise(F.col("fault"))
        ).alias("likely_cause"),
        "recommended_action",
        F.concat("name", F.lit(".md")).alias("source"),
        F.round("score", 3).alias("retrieval_score"),
    )


def incidents(
    alert_rows: DataFrame,
    guides: DataFrame,
    top_n: int | None = None,
    stop_words: list[str] | None = None,
) -> DataFrame:
    """One report per alert.

    Retrieval runs on the distinct queries only, at most (machine types) x 2^sensors of them. The
    staged answers are joined back by broadcast if their size allows it.
    """
    if top_n:
        alert_rows = top_alerts(alert_rows, top_n)
    classified = classify(alert_rows)
    queries = stage(classified.select("query_text", "fault").distinct(), "queries")
    answers = stage(grounding(queries, guides, stop_words), "grounding")
    prob = F.expr(sensors.probability_sql())
    return classified.join(broadcast_if_small(answers), ["query_text", "fault"]).select(
        "event_id",
        "machine_id",
        "site",
        "machine_type",
        prob.alias("alert_prob"),
        F.round(prob, 3).alias("anomaly_prob"),
        "severity",
        "symptom",
        "likely_cause",
        "recommended_action",
        "source",
        "retrieval_score",
    )
