"""Running totals over a whole table, without bringing it into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyworks.session import computed

_PART, _AMOUNT = "__part", "__amount"


def running_total(df: DataFrame, order: Sequence[str], amount: Column, name: str) -> tuple[DataFrame, int]:
    """Add ``name``, the sum of a whole-number amount over all rows before a row, and give the sum over all rows.

    Tasks hold ranges of the order, NULL first. Each adds up its own range; the
    totals of the ranges, one number per task, are put in order and added to
    what is inside. Rows with equal order values have some order among them.
    """
    spread = df.withColumn(_AMOUNT, amount.cast("bigint")).repartitionByRange(*order)
    # Ranges come from a sample, so they are fixed before they are read twice.
    kept = computed(spread.withColumn(_PART, F.spark_partition_id()))
    totals = kept.groupBy(_PART).agg(F.sum(_AMOUNT).alias("total")).orderBy(_PART).collect()
    ahead, starts = 0, []
    for part, total in totals:
        starts.append((part, ahead))
        ahead += total or 0
    offsets = df.sparkSession.createDataFrame(starts, f"{_PART} int, __ahead bigint")
    inside = Window.partitionBy(_PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = kept.withColumn(name, F.coalesce(F.sum(_AMOUNT).over(inside), F.lit(0)))
    # One row per task of the shuffle.
    joined = summed.join(F.broadcast(offsets), _PART).withColumn(name, F.col(name) + F.col("__ahead"))
    return joined.drop(_PART, _AMOUNT, "__ahead"), ahead
