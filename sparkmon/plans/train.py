"""Training plan: split, tune, evaluate, and the drift reference of the training rows."""

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmon import constants as K
from sparkmon.operators import evaluate, scoring
from sparkmon.operators.drift import feature_reference
from sparkmon.session import stage
from sparkmon.sources.sinks import write_json


@dataclass(frozen=True)
class Trained:
    model: PipelineModel
    metrics: DataFrame
    reference: DataFrame

    def save(self, path: str) -> None:
        """Model, metrics and drift reference below one folder."""
        scoring.save_model(self.model, f"{path}/model")
        write_json(self.metrics, f"{path}/metrics")
        write_json(self.reference, f"{path}/reference")


def train(
    events: DataFrame,
    depths: list[int] | None = None,
    folds: int = K.CV_FOLDS,
    name: str | None = None,
    version: int | None = None,
    iterations: int = K.GBT_ITERATIONS,
) -> Trained:
    """Tune on the training side of a hash split and evaluate on the other side."""
    rows = events.filter(scoring.is_scorable()).select(scoring.INPUT_COLUMNS)
    split = scoring.hash_split(rows)
    training = scoring.spread(split.train).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tuned = scoring.cross_validate(
            training, depths, folds, gbt=scoring.classifier(maxIter=iterations)
        )
        model = tuned.bestModel
        reference = stage(feature_reference(training), "reference")
        n_train = training.count()
    finally:
        training.unpersist()
    predictions = scoring.score(model, scoring.spread(split.test)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        auc = evaluate.roc_auc(predictions)
        quality = evaluate.confusion(predictions).select(
            F.lit(K.MODEL_NAME).alias("model"),
            F.round(F.lit(auc), 4).alias("auc"),
            F.round("precision", 3).alias("precision"),
            F.round("recall", 3).alias("recall"),
            F.round("f1", 3).alias("f1"),
            F.lit(model.stages[-1].getMaxDepth()).alias("best_max_depth"),
            F.lit(folds).alias("cv_folds"),
            F.lit(name).cast("string").alias("registry_model"),
            F.lit(version).cast("int").alias("registry_version"),
            F.lit(n_train).cast("long").alias("n_train"),
        )
        return Trained(model, stage(quality, "metrics"), reference)
    finally:
        predictions.unpersist()
