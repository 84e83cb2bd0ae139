"""Toxicity by a factorization machine over hashed terms.

Besides a weight per term the model has a vector per term, and the products of the vectors of two
present terms count too, so an insult together with a mention can weigh more than both alone.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmon.llm.learning import fit_machine, fitted, machine_scores, scorer, sigmoid

FOLDS = 5
SCORED = "doc_id long, held_out boolean, text_hash long, score double, predicted int"


def held_out(doc_id: str = "doc_id"):
    """Rows whose labels are never learned: crc32 of the id as text is divisible by five."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0


def _scores(model, places, starts):
    score = sigmoid(machine_scores(model, places, starts))
    return [score, (score >= 0.5).astype(np.int32)]


def _without_model(rows: int):
    return [np.zeros(rows), np.zeros(rows, np.int32)]


def toxicity(documents: DataFrame, labels: DataFrame, whole: bool = False) -> DataFrame:
    """Every document's probability of being toxic, fitted on labels outside the held-out fold.

    Empty and null texts get the score of a text without any term. Without labels every score is 0. Rows
    that repeat an id each get their own score; a null id stays null and is not held out; further
    columns are ignored. With ``whole`` the judged rows come along, as ``row`` (all columns but the text) and
    ``text``, so that nobody has to join the scores to the texts.
    """
    usable = labels.filter(~held_out()).select("doc_id", F.col("toxic").alias("label"))
    model = fitted(documents, usable, fit_machine, shapes=False)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    row = F.struct(*[F.col(c) for c in documents.columns if c != "text"]).alias("row")
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        F.col("text").cast("string").alias("text"),
        *([row] if whole else []),
    )
    carried = ["doc_id", "held_out", "text_hash"] + (["row", "text"] if whole else [])
    run = scorer(shared, False, carried, _scores, _without_model, ["score", "predicted"])
    scored = T.StructType.fromDDL(SCORED)
    return texts.mapInArrow(run, T.StructType([*scored.fields[:3], *[texts.schema[c] for c in carried[3:]], *scored.fields[3:]]))
