"""Rows by key that a stream carries from batch to batch, kept as a log of segments.

Each batch writes one segment with the rows of the keys that it touched, so what it
writes follows from the batch and not from the number of keys. The newest segment that
has a key holds its row. When the last MERGED segments have an oldest one that is not
larger than the others together, they become one. Segments so shrink from old to new,
their number grows with the logarithm of the rows, and so do the times a row is rewritten.

The list of segments after batch b is a small file of its own, written last. A batch
that runs again reads the list of the batch before it and overwrites what it wrote.
Segments and lists that no batch can ask for any more are removed.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tallyworks.session import read_note, remove_folder, write_note

# Folders of a segment, by a hash of the key; a batch reads the folders that its keys fall into.
BUCKETS = 8
# So many segments of like size become one.
MERGED = 4

_BUCKET, _AGE = "__bucket", "__age"


class KeyedLog:
    """A table with one row per key below ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.path, self.schema = spark, path, schema
        self.keys, self.buckets = list(keys), buckets
        self.values = [name for name in schema.fieldNames() if name not in self.keys]

    def segments(self, batch: int) -> list[tuple[str, int]]:
        """Names and row counts of the segments after a batch, oldest first."""
        if batch < 0:
            return []
        found = read_note(self.spark, f"{self.path}/lists/{batch}")
        return [(name, rows) for name, rows in json.loads(found)]

    def rows(self, batch: int, touched: DataFrame | None = None) -> DataFrame:
        """The rows after a batch, of all keys or of the keys in ``touched``."""
        return self._newest([name for name, _ in self.segments(batch)], touched)

    def write(self, batch: int, rows: DataFrame) -> None:
        """Put the rows of touched keys, one per key, on top of the table after the batch before."""
        before = self.segments(batch - 1)
        after = list(before)
        fresh = (f"{batch}", self._store(rows, f"{batch}"))
        if fresh[1]:
            after.append(fresh)
        last = 0
        while len(after) - last >= MERGED and after[-last - MERGED][1] <= sum(size for _, size in after[len(after) - last - MERGED + 1 :]):
            last += MERGED
        if last:
            merged = f"{batch}-merged"
            rows_left = self._store(self._newest([name for name, _ in after[-last:]]), merged)
            after[-last:] = [(merged, rows_left)]
        write_note(self.spark, f"{self.path}/lists/{batch}", json.dumps(after))
        self._remove_old(batch, before, after)

    def _remove_old(self, batch: int, before: list, after: list) -> None:
        """What only the list of two batches ago names; that of the batch before is asked for if this one runs again."""
        named = {name for name, _ in [*before, *after]}
        for name in (f"{batch}", f"{batch}-merged"):  # empty, merged at once, or left by a run that failed
            if name not in named:
                remove_folder(self.spark, self._place(name))
        if batch < 2 or read_note(self.spark, f"{self.path}/lists/{batch - 2}") is None:
            return
        for name, _ in self.segments(batch - 2):
            if name not in named:
                remove_folder(self.spark, self._place(name))
        remove_folder(self.spark, f"{self.path}/lists/{batch - 2}")

    def _place(self, name: str) -> str:
        return f"{self.path}/segments/{name}"

    def _bucketed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(_BUCKET, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _store(self, rows: DataFrame, name: str) -> int:
        """Write a segment and give the number of its rows."""
        columns = [F.col(field.name).cast(field.dataType) for field in self.schema]
        dealt = self._bucketed(rows.select(*columns)).repartition(_BUCKET)
        counted = Observation()
        dealt = dealt.observe(counted, F.count(F.lit(1)).alias("rows"))
        dealt.write.mode("overwrite").partitionBy(_BUCKET).parquet(self._place(name))
        return counted.get["rows"]

    def _newest(self, names: Sequence[str], touched: DataFrame | None = None) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], self.schema)
        reader = self.spark.read.schema(T.StructType([*self.schema, T.StructField(_BUCKET, T.IntegerType())]))
        parts = [reader.parquet(self._place(name)).withColumn(_AGE, F.lit(age)) for age, name in enumerate(names)]
        found = reduce(DataFrame.unionByName, parts)
        if touched is not None:
            wanted = self._bucketed(touched.select(*self.keys).distinct()).alias("wanted")
            same = F.col(f"held.{_BUCKET}") == F.col(f"wanted.{_BUCKET}")
            for key in self.keys:
                same &= F.col(f"held.`{key}`").eqNullSafe(F.col(f"wanted.`{key}`"))
            found = found.alias("held").join(wanted, same, "left_semi")
        newest = found.groupBy(*self.keys).agg(F.max_by(F.struct(*self.values), _AGE).alias("row"))
        return newest.select(*self.keys, *[F.col(f"row.`{name}`").alias(name) for name in self.values]).select(*self.schema.fieldNames())
