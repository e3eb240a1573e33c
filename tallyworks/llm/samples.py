"""Bounded samples of rows by hash, the same however the rows lie."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_hash(df: DataFrame, columns: list[str], rows: int) -> DataFrame:
    """At most so many rows, those with small hashes of the columns; of rows with one hash, one counts.

    The bound on the hash follows from the number of rows, so that no more than about the sample moves. A table of
    fewer rows is taken whole, but for rows with one hash. A sample can be some rows short.
    """
    hashed = df.withColumn("__hash", F.xxhash64(*columns))
    total = df.count()
    if total > rows:
        hashed = hashed.filter(F.col("__hash") <= F.lit(int(-(2**63) + 2**64 * 0.95 * rows / total)))
    return hashed.dropDuplicates(["__hash"]).orderBy("__hash").limit(rows).drop("__hash")
