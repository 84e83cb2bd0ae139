"""Running totals over a whole table in a given order, without one task that sees all rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkmon.session import broadcast_if_small, stage

PART = "range_part"


def in_ranges(df: DataFrame, order: list[Column]) -> DataFrame:
    """Rows dealt to tasks by ranges of ``order``, with the number of their range.

    Rows that are equal in ``order`` share a range. The number is only meaningful within one pass over the
    result: what refers to it twice has to stage it, since bounds are sampled anew otherwise.
    """
    return df.repartitionByRange(*order).withColumn(PART, F.spark_partition_id())


def running_totals(
    df: DataFrame, order: list[Column], values: list[str], groups: list[str] | None = None
) -> DataFrame:
    """Adds ``before_<value>``: the sum over the earlier rows of the same group in ``order``.

    Rows are dealt by ranges of group and order, so a group that holds most rows spreads over many
    tasks. Each range is summed on its own; the totals of the ranges before it, one row per range and
    group, are joined back. ``order`` should tell rows apart: equal rows are taken in any order.
    """
    groups = groups or []
    placed = stage(in_ranges(df, [*map(F.col, groups), *order]), "ranges")
    totals = placed.groupBy(*groups, PART).agg(*[F.sum(v).alias(v) for v in values])
    earlier = Window.partitionBy(*groups).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(g).alias(f"offset_{g}") for g in [*groups, PART]],
        *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"offset_{v}") for v in values],
    )
    offsets = broadcast_if_small(stage(offsets, "range-offsets"))
    within = Window.partitionBy(*groups, PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumns({f"before_{v}": F.coalesce(F.sum(v).over(within), F.lit(0)) for v in values})
    same = [F.col(g).eqNullSafe(F.col(f"offset_{g}")) for g in [*groups, PART]]
    joined = local.join(offsets, same)
    return joined.select(
        *df.columns, *[(F.col(f"before_{v}") + F.col(f"offset_{v}")).alias(f"before_{v}") for v in values]
    )


def running_maximum(df: DataFrame, order: Column, value: str) -> DataFrame:
    """Adds ``before_<value>``: the highest value among the earlier rows in ``order``, null for the first.

    As in :func:`running_totals`, each range is run through on its own and takes the highest value of the
    ranges before it from a table of one row per range.
    """
    placed = stage(in_ranges(df, [order]), "ranges")
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    highest = placed.groupBy(PART).agg(F.max(value).alias("highest"))
    offsets = highest.select(F.col(PART).alias("offset_part"), F.max("highest").over(earlier).alias("highest"))
    within = Window.partitionBy(PART).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("local", F.max(value).over(within))
    joined = local.join(broadcast_if_small(stage(offsets, "range-offsets")), F.col(PART) == F.col("offset_part"))
    return joined.select(*df.columns, F.greatest("local", "highest").alias(f"before_{value}"))


def nth_smallest(df: DataFrame, value: Column, n: int, buckets: int = 1024) -> int | None:
    """The ``n``-th smallest of the whole numbers in ``value``, counted with repeats; the largest if there are fewer.

    A histogram of equal steps over the range tells in which step the number lies, and that step is divided
    again until all its values are equal. Each pass returns at most ``buckets`` rows to one task and one
    row to the driver; two passes do for a million steps. None for a table without values.
    """
    rows = df.select(value.cast("long").alias("v")).filter("v IS NOT NULL")
    ends = rows.agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("v").alias("n")).first()
    if ends.n == 0:
        return None
    low, high, rank = ends.low, ends.high, min(max(n, 1), ends.n)
    up_to = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    while low < high:
        width = (high - low) // buckets + 1
        step = F.expr(f"(v - ({low}L)) DIV {width}L").alias("step")
        counted = rows.filter(F.col("v").between(low, high)).groupBy(step).agg(
            F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
        )
        reached = counted.withColumn("up_to", F.sum("n").over(up_to)).filter(F.col("up_to") >= rank)
        found = reached.orderBy("step").first()
        low, high, rank = found.low, found.high, rank - (found.up_to - found.n)
    return low
