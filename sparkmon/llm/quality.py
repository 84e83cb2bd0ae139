"""Quality by ordinal regression on graded ratings.

One weight per hashed term and an ordered threshold per grade give the probability of each grade or
better, the expected grade, and a decision by the probability of a chosen grade.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmon.llm.learning import fit_ordinal, fitted, ordinal_tails, scorer
from sparkmon.llm.toxicity import held_out

GRADED = (
    "doc_id long, held_out boolean, expected_grade double, tail_probability double, selected boolean"
)


def graded(labels: DataFrame) -> DataFrame:
    """``doc_id, label`` with grade 0 for low quality, 1 for good but toxic, 2 for good and clean."""
    good, toxic = F.col("quality").cast("int"), F.col("toxic").cast("int")
    return labels.select("doc_id", (good * (2 - toxic)).alias("label"))


def _grade(least: int, floor: float):
    def run(model, places, starts):
        tails = ordinal_tails(model, places, starts)
        tail = tails[:, min(least, tails.shape[1]) - 1]
        return [tails.sum(axis=1), tail, tail >= floor]

    return run


def _without_model(rows: int):
    return [np.zeros(rows), np.zeros(rows), np.zeros(rows, bool)]


def quality(documents: DataFrame, grades: DataFrame, least: int = 1, floor: float = 0.5) -> DataFrame:
    """Expected grade, probability of ``least`` or better, and whether that reaches ``floor``.

    ``grades`` has ``doc_id, label`` with whole grades from 0; those of the held-out fold are not
    learned. Empty and null texts get the grade of a text without terms. Without grades nothing is
    selected. Repeated rows each get a result; a null id stays null; further columns are ignored.
    """
    model = fitted(documents, grades.filter(~held_out()), fit_ordinal, shapes=True)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    names = ["expected_grade", "tail_probability", "selected"]
    run = scorer(shared, True, ["doc_id", "held_out"], _grade(least, floor), _without_model, names)
    return texts.mapInArrow(run, GRADED)
