"""Feature pipeline, gradient-boosted classifier, split, tuning and scoring."""

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmon import constants as K
from sparkmon.functions.sensors import valid_sql
from sparkmon.operators.evaluate import evaluator
from sparkmon.session import shared_dir
from sparkmon.sources.commits import Commit, commits, fresh_folder, publish

INPUT_COLUMNS = ["event_id", *K.CATEGORICAL, *K.SENSORS, "label"]


@dataclass(frozen=True)
class Split:
    train: DataFrame
    test: DataFrame


def hash_split(
    df: DataFrame, key: str = "event_id", fraction: float = K.TRAIN_FRACTION, seed: int = K.SEED
) -> Split:
    """Split by a hash of the key: the same rows on each side whatever the partitioning.

    The hash is MD5, which other engines have too, so the sides can be compared with theirs.
    """
    cut = round(fraction * 1000)
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    bucket = F.conv(F.substring(digest, 1, 6), 16, 10).cast("long") % 1000
    return Split(df.filter(bucket < cut), df.filter(bucket >= cut))


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt evenly over all cores, however few files or row groups they come from.

    For rows that are persisted and read by every step of a fit.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(cores, rows.rdd.getNumPartitions()))


def is_scorable() -> Column:
    """Rows the feature assembler accepts: no sensor is NULL or NaN."""
    return F.expr(" AND ".join(f"{valid_sql(s)} IS NOT NULL" for s in K.SENSORS))


def classifier(**params) -> GBTClassifier:
    return GBTClassifier(
        featuresCol="features",
        labelCol="label",
        seed=K.SEED,
        maxIter=params.pop("maxIter", K.GBT_ITERATIONS),
        maxBins=params.pop("maxBins", K.GBT_BINS),
        **params,
    )


def feature_stages() -> list:
    """Sensors and one-hot categories, standardised; unseen categories are kept as their own level.

    One indexer serves all categorical columns, so their levels are counted in one pass.
    """
    levels = [f"{c}_level" for c in K.CATEGORICAL]
    flags = [f"{c}_flags" for c in K.CATEGORICAL]
    return [
        StringIndexer(inputCols=K.CATEGORICAL, outputCols=levels, handleInvalid="keep"),
        OneHotEncoder(inputCols=levels, outputCols=flags),
        VectorAssembler(inputCols=[*K.SENSORS, *flags], outputCol="assembled"),
        StandardScaler(inputCol="assembled", outputCol="features", withMean=True, withStd=True),
    ]


def pipeline(gbt: GBTClassifier | None = None) -> Pipeline:
    return Pipeline(stages=[*feature_stages(), gbt or classifier()])


def fit_features(train: DataFrame) -> PipelineModel:
    """The stages before the classifier alone."""
    return Pipeline(stages=feature_stages()).fit(train.filter(is_scorable()))


def fit(train: DataFrame, gbt: GBTClassifier | None = None) -> PipelineModel:
    shared_dir(train.sparkSession)
    return pipeline(gbt).fit(train.filter(is_scorable()).select(INPUT_COLUMNS))


def cross_validate(
    train: DataFrame,
    depths: list[int] | None = None,
    folds: int = K.CV_FOLDS,
    parallelism: int = K.CV_PARALLELISM,
    gbt: GBTClassifier | None = None,
) -> CrossValidatorModel:
    """Choose the tree depth by k-fold AUC.

    The grid is keyed by the parameter of this classifier instance, so each depth takes effect.
    Long boosting lineages are cut in the shared checkpoint folder. The folds reread ``train``, so
    callers keep it persisted.
    """
    shared_dir(train.sparkSession)
    gbt = gbt or classifier()
    grid = ParamGridBuilder().addGrid(gbt.maxDepth, depths or K.GBT_DEPTHS).build()
    tuner = CrossValidator(
        estimator=pipeline(gbt),
        estimatorParamMaps=grid,
        evaluator=evaluator(),
        numFolds=folds,
        seed=K.SEED,
        parallelism=parallelism,
    )
    return tuner.fit(train.select(INPUT_COLUMNS))


def score(model: PipelineModel, events: DataFrame) -> DataFrame:
    """Adds ``prediction`` and ``anomaly_prob``; works on batch and streaming input.

    Rows that lack a sensor value cannot be assembled and are left out.
    """
    scored = model.transform(events.filter(is_scorable())).withColumn(
        "anomaly_prob", vector_to_array("probability")[1]
    )
    return scored.select(*events.columns, "rawPrediction", "prediction", "anomaly_prob")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


_LOADED: dict[tuple[str, int], PipelineModel] = {}


def publish_model(model: PipelineModel, registry: str, version: int) -> None:
    """Save a model below a registry folder and make it its version; readers never see a part of it."""
    spark = SparkSession.active()
    folder = fresh_folder(registry, version)
    model.write().save(folder)
    publish(spark, registry, Commit(version, folder))


def latest_model(spark: SparkSession, registry: str) -> tuple[int, PipelineModel]:
    """The highest published version and its model, loaded once per process."""
    found = commits(spark, registry)
    if not found:
        raise FileNotFoundError(f"no model is published in {registry}")
    latest = found[-1]
    key = (f"{registry}/{latest.folder}", latest.batch_id)
    if key not in _LOADED:
        # Versions that have been replaced are not asked for again.
        for old in [k for k in _LOADED if k[0].startswith(f"{registry}/")]:
            del _LOADED[old]
        _LOADED[key] = load_model(key[0])
    return latest.batch_id, _LOADED[key]


def versioned_scores(events: DataFrame, registry: str) -> DataFrame:
    """Scores by the version that is the latest when this is called, with ``model_version``."""
    version, model = latest_model(events.sparkSession, registry)
    return score(model, events).withColumn("model_version", F.lit(version))
