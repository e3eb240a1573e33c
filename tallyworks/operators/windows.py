"""Tumbling and session windows over bounded input. Both take timestamps with or without zone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyworks.functions.values import from_units, units
from tallyworks.operators.keyed import sum_of
from tallyworks.operators.skew import GROUP_ROWS, heavy_keys


# Slots of one key that are linked in one group.
RANGE_SLOTS = 4096


def interval(microseconds: int) -> str:
    return f"{microseconds} microseconds"


def seconds(microseconds: int) -> Column:
    return F.expr(f"INTERVAL '{microseconds / 1_000_000:.6f}' SECOND")


def tumbling_sum(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    width: str,
    value: Column,
    name: str = "total",
    scale: int | None = None,
) -> DataFrame:
    """Sum and row count per key and fixed window, windows starting at the epoch."""
    window = F.window(time, width)
    return (
        df.groupBy(*keys, window.alias("win"))
        .agg(sum_of(value, scale).alias(name), F.count(F.lit(1)).alias("n"))
        .select(*keys, F.col("win.start").alias("window_start"), F.col("win.end").alias("window_end"), name, "n")
    )


def session_mean(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    gap_us: int,
    value: Column,
    name: str = "mean",
    scale: int | None = None,
    inclusive: bool = False,
    group_rows: int = GROUP_ROWS,
    look_at: Sequence[str] | None = None,
) -> DataFrame:
    """Mean and row count per key and session.

    A session ends where the next event comes ``gap_us`` or more after the last
    one; with ``inclusive`` an event exactly one gap later still belongs to it.
    ``session_end`` is the last event plus the gap. Values are added as they are;
    with a scale they are rounded to it first, and the mean is the same for every
    partitioning.

    The built-in session window moves and sorts all rows of a key in one group.
    If a key has more than ``group_rows`` rows, sessions are linked from slots.
    ``look_at`` names some of the keys to count by instead: if no such part of the
    key has that many rows, no whole key has.
    """
    if heavy_keys(df, look_at or keys, group_rows) is None:
        return native_sessions(df, keys, time, gap_us, value, name, scale, inclusive)
    return _linked_sessions(df, keys, time, gap_us, value, name, scale, inclusive)


def native_sessions(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    gap_us: int,
    value: Column,
    name: str,
    scale: int | None,
    inclusive: bool,
) -> DataFrame:
    """Sessions by the built-in window, bounded or streaming.

    The built-in window joins events exactly one gap apart. Without ``inclusive``
    they are apart: its gap is one microsecond shorter and its end gets that
    microsecond back.
    """
    shorter = 0 if inclusive else 1
    session = F.session_window(time, interval(gap_us - shorter)).alias("session")
    merged = df.groupBy(*keys, session).agg(
        _added(value, scale).alias("total"), F.count(value).alias("counted"), F.count(F.lit(1)).alias("n")
    )
    return merged.select(
        *keys,
        F.col("session.start").alias("session_start"),
        (F.col("session.end") + seconds(shorter)).alias("session_end"),
        _mean(scale).alias(name),
        "n",
    )


def _linked_sessions(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    gap_us: int,
    value: Column,
    name: str,
    scale: int | None,
    inclusive: bool,
    range_slots: int = RANGE_SLOTS,
) -> DataFrame:
    """Sessions out of gap-wide slots of time, linked in two rounds.

    Events of one key in the same slot always share a session. They are summed
    up per slot first, with map-side combine, so a key moves at most one row per
    slot, however many events it has. Slots are linked inside ranges of
    ``range_slots`` slots of time, so that a key is spread over as many groups as
    it has ranges. Only the first and the last session of a range can go on in
    another one; these are linked in the second round.
    """
    slots = df.groupBy(*keys, F.window(time, interval(gap_us)).alias("slot")).agg(
        F.min(time).alias("first_seen"),
        F.max(time).alias("last_seen"),
        _added(value, scale).alias("total"),
        F.count(value).alias("counted"),
        F.count(F.lit(1)).alias("n"),
    )
    begin = F.unix_micros(F.col("slot.start").cast("timestamp"))
    ranged = slots.withColumn("time_range", F.floor(begin / F.lit(gap_us * range_slots)))
    inside = _linked(ranged, [*keys, "time_range"], gap_us, inclusive)
    last = F.max("session_no").over(Window.partitionBy(*keys, "time_range"))
    inside = inside.withColumn("border", (F.col("session_no") == 1) | (F.col("session_no") == last))
    columns = [*keys, "first_seen", "last_seen", "total", "counted", "n"]
    borders = _linked(inside.where("border"), keys, gap_us, inclusive)
    merged = inside.where("NOT border").select(*columns).unionByName(borders.select(*columns))
    return merged.select(
        *keys,
        F.col("first_seen").alias("session_start"),
        (F.col("last_seen") + seconds(gap_us)).alias("session_end"),
        _mean(scale).alias(name),
        "n",
    )


def _linked(parts: DataFrame, group: Sequence[str], gap_us: int, inclusive: bool) -> DataFrame:
    """The parts of sessions of a group merged where less than a gap lies between them, numbered from 1."""
    order = Window.partitionBy(*group).orderBy("first_seen")
    idle = F.col("first_seen") - F.lag("last_seen").over(order)
    breaks = idle > seconds(gap_us) if inclusive else idle >= seconds(gap_us)
    marked = parts.withColumn("starts", F.coalesce(breaks.cast("int"), F.lit(1)))
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = marked.withColumn("session_no", F.sum("starts").over(so_far))
    return numbered.groupBy(*group, "session_no").agg(
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
        F.sum("total").alias("total"),
        F.sum("counted").alias("counted"),
        F.sum("n").alias("n"),
    )


def _added(value: Column, scale: int | None) -> Column:
    return F.sum(value.cast("double") if scale is None else units(value, scale))


def _mean(scale: int | None) -> Column:
    total = F.col("total") if scale is None else from_units(F.col("total"), scale)
    return F.coalesce(F.try_divide(total, F.col("counted")), F.lit(float("nan")))
