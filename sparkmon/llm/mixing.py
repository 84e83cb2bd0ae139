"""Mixing sources to target weights by weighted sampling without replacement in whole epochs.

Every document draws an exponential key whose rate is its quality weight; the documents of a source in
ascending order of their keys are a weighted sample of any length (Efraimidis and Spirakis). A source
gives as many whole epochs as its target holds, then the documents of the smallest keys up to the rest.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmon.operators.ranking import running_totals
from sparkmon.session import broadcast_if_small, stage

WEIGHTS = (5, 2, 1)
REPEATS = 3
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"
HIGH, LOW = 2.0, 0.5


def exponential_key(identity: str, weight: str, seed: str = SEED) -> Column:
    """``-ln(u) / weight`` with ``u`` between 0 and 1 from 52 bits of a hash, so reruns agree."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(identity).cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.md5(named.cast("binary")), 1, 13), 16, 10).cast("long")
    return -F.ln((bits + 0.5) / float(1 << 52)) / F.col(weight)


def rating_weights(labels: DataFrame) -> DataFrame:
    """``doc_id, quality_weight`` of rated documents: doubled where rated good, halved where rated poor.

    Several ratings of a document are averaged; one with a null rating, or with as many good as poor ones,
    weighs 1, like documents without a rating.
    """
    rated = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("rating"))
    weight = F.when(F.col("rating") > 0.5, HIGH).when(F.col("rating") < 0.5, LOW).otherwise(1.0)
    return rated.select("doc_id", weight.alias("quality_weight"))


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``source, source_size, target`` for staged ``source, source_size`` with one row per source.

    Sources in order of their code points, null last, take the weights in turn. The targets share the sum of
    all sizes by weight; none exceeds ``repeats`` times its source, and what it gives up is shared among the
    others alike. So a target is the lower of that bound and ``level * weight``. With the sources in
    order of bound by weight, the level is the highest quotient of what the bounds before leave over and of the
    weights from there on: it rises as long as bounds are met and falls after. Sources of size 0 have the target 0.
    """
    one = sources.withColumn("one", F.lit(1).cast("long"))
    placed = running_totals(one, [F.col("source").asc_nulls_last()], ["one"])
    weight = F.get(F.array(*map(F.lit, weights)), (F.col("before_one") % len(weights)).cast("int"))
    weighed = placed.select(
        "source",
        "source_size",
        weight.cast("long").alias("weight"),
        (F.col("source_size") * repeats).alias("bound"),
    )
    order = [F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last()]
    ranked = stage(running_totals(weighed, order, ["bound", "weight"]), "ranked-sources")
    whole = ranked.select(F.sum("source_size")).scalar()
    all_weights = ranked.select(F.sum("weight")).scalar()
    level = ranked.select(
        F.max((whole - F.col("before_bound")) / (all_weights - F.col("before_weight")))
    ).scalar()
    target = F.least(F.col("bound").cast("double"), level * F.col("weight"))
    return ranked.select("source", "source_size", target.alias("target"))


def mix(
    documents: DataFrame,
    quality: DataFrame | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """Per document how many of its words the mix takes, repeats counted, in ``taken``.

    A document is taken whole, ``taken / size`` times. The last document of a source is the one with which the
    source comes nearest to its target, so it misses it by at most half of that document.

    ``quality`` has one row ``doc_id, quality_weight`` per document it knows; a higher weight makes a document
    likelier to be in the part of an epoch. Without a row, or with a null, NaN or non-positive weight, a
    document weighs 1. Null texts have size 0 and are taken 0 times, a null source is a source of its own, and
    every row counts, also repeated ones and those with a null ``doc_id``; equal rows may change places.
    An empty table gives no rows; further columns are ignored. Texts are read once and never move.
    """
    sized = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    sized = stage(sized, "sizes")
    if quality is None:
        sized = sized.withColumn("quality_weight", F.lit(1.0))
    else:
        given = stage(quality.select("doc_id", F.col("quality_weight").cast("double")), "quality")
        weight = F.when((F.col("quality_weight") > 0) & ~F.isnan("quality_weight"), F.col("quality_weight"))
        sized = sized.join(broadcast_if_small(given), "doc_id", "left").select(
            "doc_id", "source", "size", F.coalesce(weight, F.lit(1.0)).alias("quality_weight")
        )
    sized = sized.withColumn("sample_key", exponential_key("doc_id", "quality_weight", seed))
    sources = stage(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    targets = stage(source_targets(sources, weights, repeats), "targets")
    ordered = running_totals(sized, [F.col("sample_key"), F.col("doc_id"), F.col("size")], ["size"], ["source"])
    named = targets.withColumnRenamed("source", "target_source")
    joined = ordered.join(
        broadcast_if_small(named), F.col("source").eqNullSafe(F.col("target_source"))
    )
    epochs = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0))
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    fits = F.col("before_size") + F.col("size") / 2 <= F.col("rest")
    return (
        joined.withColumn("epochs", epochs)
        .withColumn("rest", rest)
        .select(
            "doc_id",
            "source",
            "quality_weight",
            "size",
            "source_size",
            "target",
            (F.col("size") * (F.col("epochs") + fits.cast("long"))).alias("taken"),
        )
    )
