"""Row routing, exclusion, union, ordering and word counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyworks.functions.text import WORD_PATTERN, words
from tallyworks.operators.keyed import above, keyed_count


def exclude(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the id list.

    Spark sends a list to every executor only if its bytes, as planned or as measured
    by adaptive execution, are below ``spark.sql.autoBroadcastJoinThreshold``; a
    longer one is joined by shuffle.
    """
    return df.join(ids.select(key), key, "left_anti")


# Longs of a filter of ids, a megabyte in all, and its bits for each id.
FILTER_WORDS, FILTER_HASHES = 1 << 17, 2


def _places(key: str, words: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(k), key), F.lit(words * 64)) for k in range(FILTER_HASHES)]


def id_filter(ids: DataFrame, key: str, words: int = FILTER_WORDS) -> DataFrame:
    """One row with the array ``bits`` in which every id has set its bits: a Bloom filter as an aggregate.

    Each task sends at most one number for each word of the filter, and the filter has the
    same size for any list.
    """
    place = F.explode(F.array(*_places(key, words)))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("place") % 64).cast("int"))
    found = ids.select(place.alias("place")).select(F.floor(F.col("place") / 64).alias("word"), bit.alias("bits"))
    empty = ids.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    whole = found.union(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    return whole.agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).getField("bits").alias("bits"))


def exclude_long(df: DataFrame, ids: DataFrame, key: str, words: int = FILTER_WORDS) -> DataFrame:
    """What ``exclude`` gives, for a list too long to send, without moving most rows that stay.

    Rows that a filter of the list rules out stay where they are; only the others are
    joined with the list by shuffle. A longer list lets more rows through the filter, about
    one in 23 at a million ids, and changes no result. The rows are read twice.
    """
    if not isinstance(df.schema[key].dataType, type(ids.schema[key].dataType)):
        raise TypeError(f"{key} has another type in the list")
    if isinstance(df.schema[key].dataType, (T.FloatType, T.DoubleType, T.MapType)):
        raise TypeError("equal keys must have equal hashes")
    bits = id_filter(ids, key, words).scalar()
    perhaps = F.col(key).isNotNull()
    for place in _places(key, words):
        word = F.get(bits, F.floor(place / 64).cast("int"))
        perhaps = perhaps & (F.getbit(word, (place % 64).cast("int")) == 1)
    return df.where(~perhaps).unionByName(exclude(df.where(perhaps), ids, key))


def route(df: DataFrame, rules: Mapping[str, Column], tag: str = "tag") -> DataFrame:
    """Every row once per rule it meets, with the name of the rule.

    Write the result with ``partitionBy(tag)`` to get one output per tag from
    one pass, or filter on the tag.
    """
    tags = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    return df.withColumn(tag, F.explode(tags))


def route_distinct(df: DataFrame, column: str, rules: Mapping[str, Column], tag: str = "tag") -> DataFrame:
    """Distinct values per tag. A value always gets the same tags, so one distinct before routing is enough."""
    return route(df.select(column).distinct(), rules, tag)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def by_points(df: DataFrame, points: str, key: str) -> DataFrame:
    """All rows, highest points first. The key breaks ties, so equal points do not share one range."""
    return df.orderBy(F.desc(points), F.asc(key))


def top_by_points(df: DataFrame, points: str, key: str, k: int) -> DataFrame:
    """The k rows with the highest points; each task keeps only k rows."""
    return by_points(df, points, key).limit(k)


def word_counts(df: DataFrame, text: str, more_than: int = 5, pattern: str = WORD_PATTERN) -> DataFrame:
    """Words with their counts, for words that occur more than ``more_than`` times."""
    found = df.select(F.explode(words(F.col(text), pattern)).alias("word"))
    return above(keyed_count(found, ["word"]), "n", more_than)
