"""End-to-end run: stream the events, then report incidents and summarise."""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkmon import constants as K
from sparkmon.operators.incidents import incidents
from sparkmon.operators.monitor import incident_totals, machine_totals, run_summary
from sparkmon.operators.scoring import score
from sparkmon.sources import files
from sparkmon.sources.files import stream_events
from sparkmon.sources.sinks import write_json
from sparkmon.streaming.queries import Scorer, start_ingest, start_scoring, start_window_metrics


@dataclass(frozen=True)
class Layout:
    """Where a run keeps its outputs; use a new root for a run that starts from nothing."""

    root: str

    @property
    def windows(self) -> str:
        return f"{self.root}/window_metrics"

    @property
    def events(self) -> str:
        return f"{self.root}/events"

    @property
    def scoring(self) -> str:
        return f"{self.root}/scoring"

    @property
    def alerts(self) -> str:
        return f"{self.scoring}/alerts"

    @property
    def drift(self) -> str:
        return f"{self.scoring}/drift"

    @property
    def drift_detail(self) -> str:
        return f"{self.scoring}/drift_detail"

    @property
    def quarantine(self) -> str:
        return f"{self.scoring}/quarantine"

    @property
    def late(self) -> str:
        return f"{self.scoring}/late"

    @property
    def incidents(self) -> str:
        return f"{self.root}/incidents"

    @property
    def summary(self) -> str:
        return f"{self.root}/summary"

    def checkpoint(self, query: str) -> str:
        return f"{self.root}/checkpoints/{query}"


def model_scorer(model: PipelineModel) -> Scorer:
    return lambda events: score(model, events)


def start_streams(
    events: DataFrame,
    scorer: Scorer,
    reference: DataFrame,
    layout: Layout,
    window: str = K.WINDOW,
    watermark: str = K.WATERMARK,
    threshold: float = K.ALERT_PROB_THRESHOLD,
    trigger: dict | None = None,
    wait: bool = True,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Both queries over one parsed stream; ``wait=False`` returns the running handles."""
    handles = (
        start_window_metrics(
            events, layout.windows, layout.checkpoint("windows"), window, watermark, trigger
        ),
        start_scoring(
            events,
            scorer,
            reference,
            layout.scoring,
            layout.checkpoint("scoring"),
            threshold,
            trigger,
        ),
    )
    if wait:
        for handle in handles:
            handle.awaitTermination()
    return handles


def start_logged_streams(
    events: DataFrame,
    scorer: Scorer,
    reference: DataFrame,
    layout: Layout,
    max_files: int = K.MAX_FILES_PER_TRIGGER,
    trigger: dict | None = None,
    **options,
) -> tuple[StreamingQuery, StreamingQuery, StreamingQuery]:
    """Both queries over a typed log that a third one writes from ``events``, so the source is read and parsed once.

    Returns the handles of log, windows and scoring. Without a ``trigger`` what is there is drained: first into the
    log, then from it. With one, all three run on side by side; ``options`` go to :func:`start_streams`.
    """
    spark = events.sparkSession
    ingest = start_ingest(events, layout.events, layout.checkpoint("events"), trigger)
    if trigger is None:
        ingest.awaitTermination()
    else:
        folder = spark._jvm.org.apache.hadoop.fs.Path(layout.events)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    logged = stream_events(spark, layout.events, max_files)
    return ingest, *start_streams(logged, scorer, reference, layout, trigger=trigger, **options)


def report(
    spark: SparkSession,
    events: DataFrame,
    guides: DataFrame,
    layout: Layout,
    top_n: int | None = None,
) -> DataFrame:
    """Write incidents and summary of a finished stream; returns the summary row."""
    alerts = files.read_alerts(spark, layout.alerts)
    ranked = incidents(alerts, guides, top_n).orderBy(F.col("alert_prob").desc(), F.col("event_id"))
    write_json(ranked, layout.incidents)
    summary = run_summary(
        machine_totals(events),
        alerts.select(F.count(F.lit(1))).scalar(),
        incident_totals(files.read_incidents(spark, layout.incidents)),
        files.read_drift_log(spark, layout.drift),
    )
    write_json(summary, layout.summary)
    return spark.read.schema(summary.schema).json(layout.summary)


def run_files(
    spark: SparkSession,
    events_path: str,
    scorer: Scorer,
    reference: DataFrame,
    guides: DataFrame,
    root: str,
    max_files: int = K.MAX_FILES_PER_TRIGGER,
    top_n: int | None = None,
) -> DataFrame:
    """Drain a folder of JSON event files through both queries, by way of one typed log, and report on it."""
    layout = Layout(root)
    stream = files.stream_json(spark, events_path, max_files)
    start_logged_streams(stream, scorer, reference, layout, max_files)
    return report(spark, files.read_events(spark, layout.events), guides, layout, top_n)
