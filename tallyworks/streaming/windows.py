"""Event-time windows on streams: each is emitted once, when the watermark has passed its end.

Timestamps must have a zone, as watermarks need it. Late rows are dropped once
the watermark is past them; ``delay`` holds the watermark back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyworks.operators.keyed import sum_of
from tallyworks.operators.windows import native_sessions

NO_DELAY = "0 seconds"


def tumbling_stream(
    stream: DataFrame,
    keys: Sequence[str],
    time: str,
    width: str,
    value: Column,
    name: str = "total",
    scale: int | None = None,
    delay: str = NO_DELAY,
) -> DataFrame:
    """Sum and row count per key and fixed window. Partial sums are built before the shuffle."""
    return (
        stream.withWatermark(time, delay)
        .groupBy(*keys, F.window(time, width).alias("win"))
        .agg(sum_of(value, scale).alias(name), F.count(F.lit(1)).alias("n"))
        .select(*keys, F.col("win.start").alias("window_start"), F.col("win.end").alias("window_end"), name, "n")
    )


def session_stream(
    stream: DataFrame,
    keys: Sequence[str],
    time: str,
    gap_us: int,
    value: Column,
    name: str = "mean",
    scale: int | None = None,
    inclusive: bool = False,
    delay: str = NO_DELAY,
) -> DataFrame:
    """Mean and row count per key and session.

    Start this stream with the setting ``control.LOCAL_SESSION_MERGE`` on.
    """
    return native_sessions(stream.withWatermark(time, delay), keys, time, gap_us, value, name, scale, inclusive)
