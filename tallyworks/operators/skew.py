"""Probes for hot keys and for small sides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallyworks.session import computed

# Most rows that may be sent to every executor. The tables broadcast here hold
# keys and counts, so this stays at some tens of megabytes.
BROADCAST_ROWS = 200_000
# Most rows of one key that are put into one group to be sorted there.
GROUP_ROWS = 1_000_000


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a join side for broadcast if it has at most ``max_rows`` rows.

    A larger side comes back without a hint, so that Spark joins by shuffle. The
    rows are counted in full: a limit would bring rows of all tasks into one.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def heavy_keys(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame | None:
    """The keys with more than ``limit`` rows and their row counts, or None.

    The count combines on the map side, so a hot key costs no more than any
    other. The result has at most ``rows / limit`` rows. It is computed once, and
    broadcast only if it is small.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows"))
    heavy = computed(counts.where(F.col("key_rows") > limit))
    found = heavy.count()
    if found == 0:
        return None
    return F.broadcast(heavy) if found <= BROADCAST_ROWS else heavy
