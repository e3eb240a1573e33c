"""Co-grouping: for every key, one list of values per input."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from tallyworks.operators.skew import heavy_keys, small_side
from tallyworks.session import computed

# Lists come in blocks of so many values, in sorted order.
MAX_LIST = 1_000_000


def cogroup(
    sides: Mapping[str, DataFrame],
    key: str,
    max_list: int = MAX_LIST,
    short: tuple[str, ...] = (),
) -> DataFrame:
    """Full outer co-group of named inputs.

    Each input is a DataFrame with the key and one value column. The result has
    the key, ``part`` and one sorted list per name, empty where the input has no
    row for the key. Part p holds the values at the places ``p * max_list`` to
    ``(p + 1) * max_list - 1`` of each sorted list, for every key: the lists of a key
    in order of its parts are its whole sorted lists. A key with up to ``max_list``
    values in each input has part 0 only. ``short`` names the inputs that have few
    rows per key by construction, such as one sum per key, whose list lengths need
    no look.

    The inputs are stacked, each with its value in its own column, and grouped
    once: one shuffle and no join, and keys of any input and NULL keys stay in.
    """
    stacked = _stack(sides, key)
    hot = _hot_keys(sides, key, max_list, short)
    if hot is None:
        return _lists(stacked, key, sides).select(key, F.lit(0).cast("bigint").alias("part"), *sides)
    same = F.col(key).eqNullSafe(F.col("hot_key"))
    cold = _lists(stacked.join(hot, same, "left_anti"), key, sides)
    cold = cold.select(key, F.lit(0).cast("bigint").alias("part"), *sides)
    return cold.unionByName(_split_lists(stacked.join(hot, same).drop("hot_key"), key, sides, max_list))


def _stack(sides: Mapping[str, DataFrame], key: str) -> DataFrame:
    """All inputs in one: the key and a value column per input, NULL in the rows of the others."""
    values = {}
    for name, df in sides.items():
        rest = [c for c in df.columns if c != key]
        if len(rest) != 1:
            raise ValueError(f"a co-group input has the key and one value column, not {df.columns}")
        values[name] = rest[0]
    kinds = {name: df.schema[values[name]].dataType for name, df in sides.items()}
    parts = []
    for name, df in sides.items():
        own = F.col(values[name])
        parts.append(df.select(key, *[(own if n == name else F.lit(None).cast(kinds[n])).alias(n) for n in sides]))
    return reduce(DataFrame.unionByName, parts)


def _lists(stacked: DataFrame, key: str, sides: Mapping[str, DataFrame]) -> DataFrame:
    return stacked.groupBy(key).agg(*[F.sort_array(F.collect_list(n)).alias(n) for n in sides])


def _hot_keys(sides: Mapping[str, DataFrame], key: str, max_list: int, short: tuple[str, ...]) -> DataFrame | None:
    """Keys with a list that takes more than one part."""
    looked_at = []
    for name, df in sides.items():
        if name not in short:
            (value,) = [c for c in df.columns if c != key]
            looked_at.append(df.where(F.col(value).isNotNull()).select(key, F.lit(name).alias("side")))
    if not looked_at:
        return None
    heavy = heavy_keys(reduce(DataFrame.unionByName, looked_at), [key, "side"], max_list)
    return None if heavy is None else small_side(heavy.select(F.col(key).alias("hot_key")).distinct())


def _split_lists(stacked: DataFrame, key: str, sides: Mapping[str, DataFrame], max_list: int) -> DataFrame:
    """Lists of hot keys in parts.

    Copies of one value collapse to a count before they move. All values are put in
    order over ranges; the place of a value follows from the values before it
    in its range and from the sizes of the ranges before. No group holds a whole key.
    """
    present = stacked.where(reduce(lambda a, b: a | b, [F.col(n).isNotNull() for n in sides]))
    side = F.coalesce(*[F.when(F.col(n).isNotNull(), F.lit(n)) for n in sides])
    copies = present.groupBy(key, *sides).agg(F.count(F.lit(1)).alias("copies")).withColumn("side", side)
    count = int(stacked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = computed(copies.repartitionByRange(count, key, "side", *sides).withColumn("range", F.spark_partition_id()))
    own = [key, "side"]
    sizes = ranged.groupBy(*own, "range").agg(F.sum("copies").alias("size"))
    before = Window.partitionBy(*own).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col(key).alias("start_key"),
        F.col("side").alias("start_side"),
        F.col("range").alias("start_range"),
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"),
    )
    inside = Window.partitionBy(*own, "range").orderBy(*sides).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("ahead", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    same = F.col(key).eqNullSafe(F.col("start_key")) & (F.col("side") == F.col("start_side"))
    placed = placed.join(starts, same & (F.col("range") == F.col("start_range")))
    first = F.col("start") + F.col("ahead")
    last = first + F.col("copies") - 1
    placed = placed.select(key, *sides, first.alias("first"), last.alias("last"))
    parts = F.sequence(F.floor(F.col("first") / max_list), F.floor(F.col("last") / max_list))
    runs = placed.withColumn("part", F.explode(parts))
    low = F.greatest(F.col("first"), F.col("part") * max_list)
    high = F.least(F.col("last"), (F.col("part") + 1) * max_list - 1)
    length = (high - low + 1).cast("int")
    repeated = [F.when(F.col(n).isNotNull(), F.array_repeat(n, length)).alias(n) for n in sides]
    merged = [F.sort_array(F.flatten(F.collect_list(n))).alias(n) for n in sides]
    return runs.select(key, "part", *repeated).groupBy(key, "part").agg(*merged)
