"""Confusion counts, precision / recall / F1 / accuracy and ROC AUC."""

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkmon.operators.ranking import PART, in_ranges


def confusion(predictions: DataFrame) -> DataFrame:
    """The four cells in one pass, with the ratios derived from them."""

    def cell(label: int, prediction: int) -> Column:
        return F.count_if((F.col("label") == label) & (F.col("prediction") == prediction))

    def ratio(numerator: Column, denominator: Column) -> Column:
        return F.when(denominator != 0, numerator / denominator).otherwise(0.0)

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    counts = predictions.agg(
        cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(0, 0).alias("tn")
    )
    precision, recall = F.col("precision"), F.col("recall")
    return (
        counts.withColumn("precision", ratio(tp, tp + fp))
        .withColumn("recall", ratio(tp, tp + fn))
        .withColumn("f1", ratio(2 * precision * recall, precision + recall))
        .withColumn("accuracy", F.try_divide(tp + tn, tp + fp + fn + tn))
    )


def roc_auc(
    predictions: DataFrame, score: str = "rawPrediction", exact: bool = False
) -> float:
    """Area under the ROC curve; ``exact`` keeps every distinct score as its own threshold.

    The evaluator merges equal scores, range-sorts the rest and adds up per-partition counts, so
    no partition ever sees the whole ranking.
    """
    return evaluator(score, exact).evaluate(predictions)


def exact_auc(predictions: DataFrame, score: str = "rawPrediction") -> DataFrame:
    """One row ``auc``: the share of pairs of a positive and a negative that the score puts in order, ties half.

    A plan without an action. Rows are counted per score and dealt by ranges of it; each range counts the pairs
    within it, and the negatives of the ranges below are added for its positives as a whole, from one row
    per range. Rows without score or label are left out; without both labels the result is null.
    """
    per_score = (
        predictions.filter(F.col(score).isNotNull() & ~F.isnan(score) & F.col("label").isNotNull())
        .groupBy(score)
        .agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"))
    )
    below = Window.partitionBy(PART).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        in_ranges(per_score, [F.col(score)])
        .withColumn("below", F.coalesce(F.sum("neg").over(below), F.lit(0)))
        .groupBy(PART)
        .agg(
            F.sum("pos").alias("pos"),
            F.sum("neg").alias("neg"),
            F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)).alias("pairs"),
        )
    )
    # One row per range, of which there are as many as shuffle partitions.
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    lower = ranges.withColumn("lower", F.coalesce(F.sum("neg").over(earlier), F.lit(0)))
    ordered = F.sum(F.col("pairs") + F.col("pos") * F.col("lower"))
    return lower.agg(F.try_divide(F.try_divide(ordered, F.sum("pos")), F.sum("neg")).alias("auc"))


def evaluator(score: str = "rawPrediction", exact: bool = False) -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(
        rawPredictionCol=score,
        labelCol="label",
        metricName="areaUnderROC",
        numBins=0 if exact else 1000,
    )
