"""Aggregates of one's own: create a state, add values to it, merge states, extract the result.

Values are added in Arrow batches before the shuffle, so a key moves one state per task,
however many rows it has. What Spark has built in, such as sums and means, stays with
``operators.keyed``.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

# Most keys whose states a task holds; beyond it they go to the shuffle and the task begins anew.
MOST_KEYS = 100_000

_VALUE = "__value"


class OwnAggregate(ABC):
    """One aggregate. A state is a tuple with the fields of ``state``."""

    state: T.StructType
    result: T.DataType

    @abstractmethod
    def create(self) -> tuple:
        """The state of no values."""

    @abstractmethod
    def add(self, state: tuple, values: np.ndarray) -> tuple:
        """The state with values of one key, none of them NULL."""

    @abstractmethod
    def merge(self, one: tuple, other: tuple) -> tuple:
        """The state of the values of both; the order must not matter."""

    @abstractmethod
    def extract(self, state: tuple):
        """The result of a state, or None."""


def aggregate_own(df: DataFrame, keys: Sequence[str], value: Column, own: OwnAggregate, name: str) -> DataFrame:
    """The result per key, or without keys one row for the whole table, also of an empty one.

    NULL values count for nothing; a key with no others gets the result of no values.
    """
    keys = list(keys)
    key_fields = [df.schema[key] for key in keys]
    parts = T.StructType([*key_fields, *own.state.fields])
    rows = df.select(*keys, value.alias(_VALUE))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        for batch in batches:
            for key, values in _by_key(batch, keys):
                held[key] = own.add(held[key] if key in held else own.create(), values)
            if len(held) > MOST_KEYS:
                yield _batch(held, parts)
                held = {}
        if held:
            yield _batch(held, parts)

    def merge(table: pa.Table) -> pa.Table:
        columns = [column.to_pylist() for column in table.columns]
        state = own.create()
        for found in zip(*columns[len(keys) :]):
            state = own.merge(state, found)
        values = [column[:1] for column in columns[: len(keys)]] + [[own.extract(state)]]
        return pa.table([pa.array(v, f.type) for v, f in zip(values, _arrow(result))], names=result.names)

    result = T.StructType([*key_fields, T.StructField(name, own.result)])
    states = rows.mapInArrow(partial, parts)
    if not keys:
        # The state of no values makes a row even if there are none.
        one = df.sparkSession.range(1, numPartitions=1)
        states = states.unionByName(one.mapInArrow(lambda _: iter([_batch({(): own.create()}, parts)]), parts))
    return states.groupBy(*keys).applyInArrow(merge, result)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _batch(held: dict[tuple, tuple], schema: T.StructType) -> pa.RecordBatch:
    columns = zip(*[(*key, *state) for key, state in held.items()])
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _arrow(schema))], schema.names)


def _by_key(batch: pa.RecordBatch, keys: list[str]) -> Iterator[tuple[tuple, np.ndarray]]:
    """Each key of a batch with its values."""
    code = np.zeros(batch.num_rows, dtype=np.int64)
    for key in keys:
        own = batch.column(key).dictionary_encode(null_encoding="encode").indices.to_numpy()
        _, code = np.unique(code * (int(own.max(initial=0)) + 1) + own, return_inverse=True)
    order = np.argsort(code, kind="stable")
    starts = np.flatnonzero(np.append(True, np.diff(code[order]) > 0)) if len(order) else order
    firsts = batch.select(keys).take(pa.array(order[starts])).to_pylist() if keys else [{}] * len(starts)
    for found, rows in zip(firsts, np.split(order, starts[1:])):
        values = batch.column(_VALUE).take(pa.array(rows)).drop_null()
        yield tuple(found.values()), values.to_numpy(zero_copy_only=False)


class Mean(OwnAggregate):
    """The mean of whole numbers, exact up to the last division; NaN of no values."""

    state = T.StructType().add("total", "decimal(38,0)").add("n", "long")
    result = T.DoubleType()

    def create(self):
        return 0, 0

    def add(self, state, values):
        return state[0] + sum(values.tolist()), state[1] + len(values)

    def merge(self, one, other):
        return int(one[0]) + int(other[0]), one[1] + other[1]

    def extract(self, state):
        return float(state[0]) / state[1] if state[1] else float("nan")


class Variance(OwnAggregate):
    """The sample variance of whole numbers, exact up to the last division; None of fewer than two values."""

    state = T.StructType().add("total", "decimal(38,0)").add("squares", "decimal(38,0)").add("n", "long")
    result = T.DoubleType()

    def create(self):
        return 0, 0, 0

    def add(self, state, values):
        found = values.tolist()
        return state[0] + sum(found), state[1] + sum(v * v for v in found), state[2] + len(found)

    def merge(self, one, other):
        return int(one[0]) + int(other[0]), int(one[1]) + int(other[1]), one[2] + other[2]

    def extract(self, state):
        total, squares, n = state
        return float(n * squares - total * total) / float(n * (n - 1)) if n > 1 else None
