"""Count-triggered panes: a key fires after every n of its rows, in arrival order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyworks.operators.skew import GROUP_ROWS, heavy_keys
from tallyworks.session import computed

# A key with more rows than this is cut into slots of about so many.
SLOT_ROWS = GROUP_ROWS
# Scores of one key that are written by one task.
BLOCK_PANES = 1_000_000

PANE_KEY = "pane_key"
# The slot of a key that is not cut: a number that no slot of a hot key has.
WHOLE_KEY = -(2**63)


def number_arrivals(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    value: Column | None = None,
    before: DataFrame | None = None,
    slot_rows: int = SLOT_ROWS,
) -> DataFrame:
    """Add ``position``, the place of a row in its key's arrival order, from 1 on.

    ``seq`` is the arrival number: unique, with any gaps. With
    a value also ``amount``, the value, and ``running``, its running total.
    ``before`` has one row per key with ``seen`` and ``total`` of earlier input,
    on which both build.

    Keys with more than ``slot_rows`` rows are cut into slots by rank: ranges of
    ``seq`` with about that many rows each, however ``seq`` is spread. The rows and
    totals of earlier slots come from an aggregate with map-side combine. Without
    such keys this is one window over the key.
    """
    rows = df.withColumn("amount", F.lit(0).cast("bigint") if value is None else value)
    heavy = heavy_keys(rows, keys, slot_rows)
    if heavy is None and before is None:
        return _numbered(rows, keys, seq)
    # A struct around the keys makes NULL keys meet in joins.
    rows = rows.withColumn(PANE_KEY, F.struct(*keys))
    offsets = None if before is None else before.select(F.struct(*keys).alias(PANE_KEY), "seen", "total")
    group = [PANE_KEY]
    if heavy is not None:
        group = [PANE_KEY, "slot"]
        rows, offsets = _slotted(rows, keys, seq, heavy, offsets, slot_rows)
    built_on = _numbered(rows, group, seq).join(offsets, group, "left")
    return built_on.withColumns(
        {
            "position": F.col("position") + F.coalesce("seen", F.lit(0)),
            "running": F.col("running") + F.coalesce("total", F.lit(0)),
        }
    ).drop("slot", "seen", "total")


def _numbered(rows: DataFrame, group: Sequence[str], seq: str) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(seq)
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumns(
        {"position": F.row_number().over(order).cast("bigint"), "running": F.sum("amount").over(so_far)}
    )


def _slotted(
    rows: DataFrame, keys: Sequence[str], seq: str, heavy: DataFrame, before: DataFrame | None, slot_rows: int
) -> tuple[DataFrame, DataFrame]:
    """Rows with their slot, and the rows and totals of a key ahead of each of its slots.

    All rows of a key that is not hot are in the slot ``WHOLE_KEY``.
    """
    hot = heavy.select(F.struct(*keys).alias(PANE_KEY))
    slots = heavy.agg(F.sum("key_rows")).first()[0] // slot_rows + 1
    ranges = rows.join(hot, PANE_KEY, "left_semi").repartitionByRange(slots, PANE_KEY, seq)
    # Ranges come from a sample, so they are fixed before they are read twice.
    cut = computed(ranges.withColumn("slot", F.spark_partition_id().cast("bigint")))
    slotted = cut.unionByName(rows.join(hot, PANE_KEY, "left_anti").withColumn("slot", F.lit(WHOLE_KEY)))
    sizes = cut.groupBy(PANE_KEY, "slot").agg(F.count(F.lit(1)).alias("size"), F.sum("amount").alias("subtotal"))
    earlier = Window.partitionBy(PANE_KEY).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        PANE_KEY,
        "slot",
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("seen"),
        F.coalesce(F.sum("subtotal").over(earlier), F.lit(0)).alias("total"),
    )
    if before is not None:
        known = before.select(PANE_KEY, F.col("seen").alias("seen_before"), F.col("total").alias("total_before"))
        offsets = offsets.join(known, PANE_KEY, "left").select(
            PANE_KEY,
            "slot",
            (F.col("seen") + F.coalesce("seen_before", F.lit(0))).alias("seen"),
            (F.col("total") + F.coalesce("total_before", F.lit(0))).alias("total"),
        )
        offsets = offsets.unionByName(before.withColumn("slot", F.lit(WHOLE_KEY)))
    return slotted, offsets


def pane_sums(numbered: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Rows and total per pane of n rows, panes counted from 0; the last pane of a key may be short."""
    # Grouping by the struct, where there is one, keeps to the partitioning of the numbering.
    struct = PANE_KEY in numbered.columns
    group = [PANE_KEY] if struct else keys
    pane = F.expr(f"(position - 1) div {n}")
    sums = numbered.groupBy(*group, pane.alias("pane")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total")
    )
    names = [F.col(f"{PANE_KEY}.{k}").alias(k) for k in keys] if struct else keys
    return sums.select(*names, "pane", "n", "total")


def discarding_panes(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    value: Column,
    n: int,
    flush: bool = False,
    slot_rows: int = SLOT_ROWS,
) -> DataFrame:
    """Sum of every n rows of a key. A last pane with fewer rows is left out unless ``flush`` is set."""
    panes = pane_sums(number_arrivals(df, keys, seq, value, slot_rows=slot_rows), keys, n)
    return panes if flush else panes.where(F.col("n") == n)


def firing_rows(numbered: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The rows at which an accumulating key fires, with the count and total so far."""
    return numbered.where(F.col("position") % n == 0).select(
        *keys, F.expr(f"position div {n} - 1").alias("pane"), F.col("position").alias("n"), F.col("running").alias("total")
    )


def accumulating_panes(
    df: DataFrame, keys: Sequence[str], seq: str, value: Column, n: int, slot_rows: int = SLOT_ROWS
) -> DataFrame:
    """Running count and total of a key after every n rows."""
    return firing_rows(number_arrivals(df, keys, seq, value, slot_rows=slot_rows), keys, n)


def fired_scores(counts: DataFrame, keys: Sequence[str], n: int, block: int = BLOCK_PANES) -> DataFrame:
    """The scores a running count passes between ``seen_before`` and ``seen``, every n rows.

    A count alone decides at which scores a key fires, so no row has to be
    numbered. Most keys unfold where they were counted. A key with more than
    ``block`` firings is cut into blocks, which spread over all tasks before they
    unfold; both read the same shuffle of the counts.
    """
    first, last = F.expr(f"seen_before div {n} + 1"), F.expr(f"seen div {n}")
    firing = counts.select(*keys, first.alias("first"), last.alias("last")).where("last >= first")
    few = F.col("last") - F.col("first") < block
    partitions = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    starts = F.explode(F.sequence("first", "last", F.lit(block).cast("bigint"))).alias("first")
    blocks = firing.where(~few).select(*keys, starts, "last").repartition(partitions, *keys, "first")
    ends = F.least(F.col("first") + (block - 1), F.col("last")).alias("last")
    ranges = firing.where(few).unionByName(blocks.select(*keys, "first", ends))
    steps = F.explode(F.sequence("first", "last")).alias("step")
    return ranges.select(*keys, steps).select(*keys, (F.col("step") * n).alias("score"))


def running_scores(
    df: DataFrame, keys: Sequence[str], n: int, added: str | None = None, block: int = BLOCK_PANES
) -> DataFrame:
    """Running count of a key after every n rows: n, 2n, 3n and so on.

    ``added`` is a column with the number of rows that a row stands for.
    """
    counts = df.groupBy(*keys).agg((F.count(F.lit(1)) if added is None else F.sum(added)).alias("seen"))
    return fired_scores(counts.withColumn("seen_before", F.lit(0).cast("bigint")), keys, n, block)
