"""Sums, counts and means per key. All combine on the map side before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyworks.functions.values import exact_sum, finite_sum, inexact


def sum_of(value: Column, scale: int | None = None) -> Column:
    """Sum as an aggregate expression. With a scale it is exact, hence the same for every partitioning."""
    return F.sum(value) if scale is None else exact_sum(value, scale)


def keyed_sum(
    df: DataFrame, keys: Sequence[str], value: Column, name: str = "total", scale: int | None = None
) -> DataFrame:
    return df.groupBy(*keys).agg(sum_of(value, scale).alias(name))


def keyed_count(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def mean_of(value: Column, scale: int | None = None) -> Column:
    """Mean as an aggregate expression; NaN when there is no value.

    A scale makes its sum exact, unless a value is NaN, infinite or beyond a
    decimal: then it is the plain mean, in which such a value shows.
    """
    if scale is None:
        mean = F.avg(value)
    else:
        exact = F.try_divide(finite_sum(value, scale).cast("double"), F.count(value))
        mean = F.when(F.count_if(inexact(value, scale)) > 0, F.avg(value)).otherwise(exact)
    return F.coalesce(mean, F.lit(float("nan")))


def keyed_mean(
    df: DataFrame, keys: Sequence[str], value: Column, name: str = "mean", scale: int | None = None
) -> DataFrame:
    return df.groupBy(*keys).agg(mean_of(value, scale).alias(name))


def global_mean(df: DataFrame, value: Column, name: str = "mean", scale: int | None = None) -> DataFrame:
    return df.agg(mean_of(value, scale).alias(name))


def combined_pair(df: DataFrame, keys: Sequence[str], label: str, name: str = "n") -> DataFrame:
    """One label and the row count per key; the smallest label, as the first is not defined."""
    return df.groupBy(*keys).agg(F.min(label).alias(label), F.count(F.lit(1)).alias(name))


def above(df: DataFrame, column: str, threshold: int) -> DataFrame:
    """Rows whose aggregate is over the threshold."""
    return df.where(F.col(column) > threshold)


def at_least(df: DataFrame, column: str, threshold: int) -> DataFrame:
    return df.where(F.col(column) >= threshold)
