"""Missed periods per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Window, functions as F

# So many periods of a key are the bits of one long.
WORD_PERIODS = 62


def missed_periods(df: DataFrame, keys: Sequence[str], period: str, periods: int = 12) -> DataFrame:
    """How many of the periods 1..periods have no row, and the longest run of such periods.

    The seen periods of a key are the bits of a few numbers, so the aggregate keeps
    eight bytes per key and 62 periods, ignores repeated periods and combines
    before the shuffle. Gaps before the first and after the last row count. A NULL
    or foreign period is ignored, but its key still appears.
    """
    if periods < 1:
        raise ValueError(f"periods must be at least 1, not {periods}")
    position = F.col(period).cast("bigint")
    parts, counts, texts = [], [], []
    for k, low in enumerate(range(0, periods, WORD_PERIODS)):
        size = min(WORD_PERIODS, periods - low)
        inside = F.expr(f"shiftleft(1L, cast({period} - {low} AS int) - 1)")
        bit = F.when(position.between(low + 1, low + size), inside)
        parts.append(F.coalesce(F.bit_or(bit), F.lit(0).cast("bigint")).alias(f"seen{k}"))
        counts.append(F.bit_count(f"seen{k}"))
        texts.append(F.reverse(F.lpad(F.bin(f"seen{k}"), size, "0")))
    gaps = F.split(F.concat(*texts), "1")
    return df.groupBy(*keys).agg(*parts).select(
        *keys,
        (F.lit(periods) - reduce(add, counts)).cast("bigint").alias("missed"),
        F.array_max(F.transform(gaps, F.length)).cast("bigint").alias("longest_gap"),
    )


def missed_in_series(df: DataFrame, keys: Sequence[str], period: str, periods: int) -> DataFrame:
    """What ``missed_periods`` gives, for any number of periods with rows of a fixed width.

    The seen periods are the bits of one long for each key and block of 62 periods, which
    combine before the shuffle. A block sums up to its first and last period, its count and
    its longest inner run; a run over several blocks is found between the last period of
    one and the first of the next. Blocks without a row take no room, and a key has at
    most ``periods / 62`` of them, however many rows it has. A NULL or foreign period is
    ignored, but its key still appears.
    """
    if periods < 1:
        raise ValueError(f"periods must be at least 1, not {periods}")
    position = F.col(period).cast("bigint") - 1
    known = F.when(position.between(0, periods - 1), position)
    block = F.floor(known / WORD_PERIODS).cast("bigint")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(known, F.lit(WORD_PERIODS)).cast("int"))
    bits = df.groupBy(*keys, block.alias("__block")).agg(F.bit_or(bit).alias("__bits"))
    # Bits from the highest one down to the lowest one.
    shown = F.bin("__bits")
    inner = F.array_max(F.transform(F.split(F.rtrim(shown, F.lit("0")), "1"), F.length))
    blocks = bits.select(
        *keys,
        "__block",
        F.bit_count("__bits").alias("__n"),
        inner.alias("__inner"),
        (F.col("__block") * WORD_PERIODS + F.length(shown) - F.length(F.rtrim(shown, F.lit("0"))) + 1).alias("__first"),
        (F.col("__block") * WORD_PERIODS + F.length(shown)).alias("__last"),
    )
    ordered = Window.partitionBy(*keys).orderBy(F.col("__block").asc_nulls_first())
    before = F.coalesce(F.lag("__last").over(ordered), F.lit(0))
    gaps = blocks.withColumn("__gap", F.col("__first") - before - 1)
    end = F.lit(periods) - F.coalesce(F.max("__last"), F.lit(0))
    return gaps.groupBy(*keys).agg(
        (F.lit(periods) - F.coalesce(F.sum("__n"), F.lit(0))).cast("bigint").alias("missed"),
        # The greatest of several passes over NULL.
        F.greatest(F.max("__gap"), F.max("__inner"), end).cast("bigint").alias("longest_gap"),
    )
