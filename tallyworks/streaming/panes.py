"""Count-triggered panes on streams.

Each micro-batch runs the distributed operators of ``operators.panes``, so a key
with a large part of the batch is still cut into slots and not handed to one
task as a stateful processor would do. What a key carries over is one small row
in a log below the checkpoint folder (``streaming.state``): a batch reads and
writes the rows of the keys that it holds and no others. Results
go to one folder per batch. A batch that is run again after a failure finds the
same input and the same state and overwrites its own results, so every pane is
written once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tallyworks.functions import text
from tallyworks.operators.panes import SLOT_ROWS, fired_scores, firing_rows, number_arrivals, pane_sums
from tallyworks.streaming.control import triggered
from tallyworks.streaming.state import KeyedLog

# Writes an intermediate result that is used more than once, and reads it back.
Keep = Callable[[DataFrame, str], DataFrame]
# The carried rows of the keys of a DataFrame.
Carried = Callable[[DataFrame], DataFrame]
# Takes the batch, gives the results and the rows to carry on, one for each of its keys.
Step = Callable[[DataFrame, Carried, Keep], tuple[DataFrame, DataFrame]]


def batch_writer(
    step: Step, state_schema: T.StructType, keys: Sequence[str], out: str, checkpoint: str, line: Column | None = None
) -> Callable[[DataFrame, int], None]:
    """The function that takes each micro-batch: it writes the results and the carried rows."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        log = KeyedLog(spark, f"{checkpoint}/carried", state_schema, keys)

        def keep(df: DataFrame, name: str) -> DataFrame:
            df.write.mode("overwrite").parquet(f"{checkpoint}/kept/{name}")
            return spark.read.schema(df.schema).parquet(f"{checkpoint}/kept/{name}")

        def carried_rows(touched: DataFrame) -> DataFrame:
            found = log.rows(batch_id - 1, touched)
            return keep(found, "before") if log.segments(batch_id - 1) else found

        # Counting, numbering and adding up all read the batch.
        batch = batch.persist()
        try:
            results, carried = step(batch, carried_rows, keep)
            if line is not None:
                results = results.select(text.encode(line).alias("value"))
            results.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
            log.write(batch_id, carried)
        finally:
            batch.unpersist()

    return on_batch


def run_steps(
    stream: DataFrame,
    step: Step,
    state_schema: T.StructType,
    keys: Sequence[str],
    out: str,
    checkpoint: str,
    continuous: str | None = None,
    line: Column | None = None,
) -> StreamingQuery:
    """Start a query that passes every micro-batch and the carried rows of its keys through ``step``.

    With a line the results are published as encoded text messages in ``value``.
    """
    on_batch = batch_writer(step, state_schema, keys, out, checkpoint, line)
    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return triggered(writer, continuous).start()


def _state_schema(stream: DataFrame, keys: Sequence[str], value: Column | None = None) -> T.StructType:
    """Per key the rows seen and, with a value, a total wide enough for its sums."""
    schema = T.StructType([T.StructField(k, stream.schema[k].dataType) for k in keys])
    schema = schema.add("seen", T.LongType())
    if value is None:
        return schema
    kind = stream.select(value.alias("value")).schema["value"].dataType
    if isinstance(kind, T.DecimalType):
        kind = T.DecimalType(38, kind.scale)
    elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        kind = T.LongType()
    return schema.add("total", kind)


def start_discarding(
    stream: DataFrame,
    keys: Sequence[str],
    seq: str,
    value: Column,
    n: int,
    out: str,
    checkpoint: str,
    slot_rows: int = SLOT_ROWS,
    continuous: str | None = None,
    line: Column | None = None,
) -> StreamingQuery:
    """Sum of every n rows of a key. The open pane of a key is carried over with its rows and total."""
    schema = _state_schema(stream, keys, value)
    wide = schema["total"].dataType

    def step(batch: DataFrame, carried_rows: Carried, keep: Keep) -> tuple[DataFrame, DataFrame]:
        state = carried_rows(batch)
        numbered = number_arrivals(batch, keys, seq, value, before=state, slot_rows=slot_rows)
        new = pane_sums(numbered, keys, n).withColumn("total", F.col("total").cast(wide))
        open_panes = state.select(
            *keys, F.expr(f"seen div {n}").alias("pane"), F.expr(f"seen % {n}").alias("n"), "total"
        )
        sums = new.unionByName(open_panes).groupBy(*keys, "pane")
        panes = keep(sums.agg(F.sum("n").alias("n"), F.sum("total").cast(wide).alias("total")), "panes")
        unfinished = F.when(F.col("n") < n, F.col("total"))
        carried = panes.groupBy(*keys).agg(
            F.max(F.col("pane") * n + F.col("n")).alias("seen"),
            F.coalesce(F.sum(unfinished), F.lit(0)).cast(wide).alias("total"),
        )
        return panes.where(F.col("n") == n), carried

    return run_steps(stream, step, schema, keys, out, checkpoint, continuous, line)


def start_accumulating(
    stream: DataFrame,
    keys: Sequence[str],
    seq: str,
    value: Column,
    n: int,
    out: str,
    checkpoint: str,
    slot_rows: int = SLOT_ROWS,
    continuous: str | None = None,
    line: Column | None = None,
) -> StreamingQuery:
    """Running count and total of a key after every n rows."""
    schema = _state_schema(stream, keys, value)
    wide = schema["total"].dataType

    def step(batch: DataFrame, carried_rows: Carried, keep: Keep) -> tuple[DataFrame, DataFrame]:
        state = carried_rows(batch)
        numbered = number_arrivals(batch, keys, seq, value, before=state, slot_rows=slot_rows)
        fired = firing_rows(numbered, keys, n).withColumn("total", F.col("total").cast(wide))
        new = batch.select(*keys, F.lit(1).cast("bigint").alias("seen"), value.cast(wide).alias("total"))
        sums = new.unionByName(state).groupBy(*keys)
        return fired, sums.agg(F.sum("seen").alias("seen"), F.sum("total").cast(wide).alias("total"))

    return run_steps(stream, step, schema, keys, out, checkpoint, continuous, line)


def start_scores(
    stream: DataFrame,
    keys: Sequence[str],
    n: int,
    out: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    continuous: str | None = None,
    line: Column | None = None,
) -> StreamingQuery:
    """Running count of a key after every n rows. Only counts per key move, no rows.

    ``prepare`` turns each batch into rows with the keys and ``added``, the number
    of rows that a row stands for.
    """
    schema = _state_schema(stream if prepare is None else prepare(stream), keys)

    def step(batch: DataFrame, carried_rows: Carried, keep: Keep) -> tuple[DataFrame, DataFrame]:
        rows = batch.withColumn("added", F.lit(1).cast("bigint")) if prepare is None else prepare(batch)
        fresh = keep(rows.groupBy(*keys).agg(F.sum("added").alias("added")), "added")
        state = carried_rows(fresh)
        sides = fresh.withColumn("seen_before", F.lit(0).cast("bigint")).unionByName(
            state.withColumn("added", F.lit(0).cast("bigint")).withColumnRenamed("seen", "seen_before")
        )
        counts = sides.groupBy(*keys).agg(
            F.sum("seen_before").alias("seen_before"), F.sum(F.col("added") + F.col("seen_before")).alias("seen")
        )
        kept = keep(counts, "counts")
        return fired_scores(kept, keys, n), kept.select(*keys, "seen")

    return run_steps(stream, step, schema, keys, out, checkpoint, continuous, line)


def read_results(spark, out: str, schema: T.StructType) -> DataFrame:
    """All results written so far."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(out)
