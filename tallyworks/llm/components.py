"""Connected components by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.session import work_folder


def stored(df: DataFrame, label: str, rows_a_file: int = 0) -> DataFrame:
    """The rows as a table in the shared folder, written once; with a number, files have no more rows, so that tasks can share them."""
    place = work_folder(df.sparkSession, label)
    df.write.option("maxRecordsPerFile", rows_a_file).parquet(place)
    return df.sparkSession.read.parquet(place)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    others = down.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, start: str, end: str) -> DataFrame:
    """For each node of an undirected edge list of numbers: node, and component, the smallest node that it reaches.

    Each round halves long chains; every node then hangs on the smallest of its component. Rounds end in written tables.
    """
    now = edges.select(F.col(start).alias("u"), F.col(end).alias("v")).filter("u <> v").distinct()
    print_of = (F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    before = None
    while True:
        now = stored(_small_star(_large_star(now)), "stars")
        after = tuple(now.agg(*print_of).first())
        if after == before or not after[0]:
            break
        before = after
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
