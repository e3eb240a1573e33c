"""Store profit, in count panes and in fixed windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyworks.operators.panes import SLOT_ROWS, discarding_panes
from tallyworks.operators.windows import tumbling_sum
from tallyworks.streaming.panes import start_discarding
from tallyworks.streaming.windows import NO_DELAY, tumbling_stream

# Fixed values of the store query.
CITIES = ("Mumbai", "Bangalore")
PANE_ROWS = 5
WINDOW = "20 seconds"


def profits(sales: DataFrame, cities: tuple[str, ...] = CITIES) -> DataFrame:
    """Sales of the cities with their profit. Works on streams, too."""
    profit = (F.col("sell_price") - F.col("buy_rate")) * F.col("pieces_sold")
    return sales.where(F.col("store_location").isin(*cities)).withColumn("profit", profit)


def profit_panes(sales: DataFrame, seq: str, n: int = PANE_ROWS, flush: bool = False, slot_rows: int = SLOT_ROWS) -> DataFrame:
    return discarding_panes(profits(sales), ["store_id"], seq, F.col("profit"), n, flush, slot_rows)


def start_profit_panes(
    sales: DataFrame,
    seq: str,
    out: str,
    checkpoint: str,
    n: int = PANE_ROWS,
    continuous: str | None = None,
    line: Column | None = None,
) -> StreamingQuery:
    return start_discarding(
        profits(sales), ["store_id"], seq, F.col("profit"), n, out, checkpoint, continuous=continuous, line=line
    )


def profit_windows(sales: DataFrame, time: str = "sold_at", width: str = WINDOW) -> DataFrame:
    return tumbling_sum(profits(sales), ["store_id"], time, width, F.col("profit"), "profit")


def profit_window_stream(
    sales: DataFrame, time: str = "sold_at", width: str = WINDOW, delay: str = NO_DELAY
) -> DataFrame:
    return tumbling_stream(profits(sales), ["store_id"], time, width, F.col("profit"), "profit", delay=delay)


def window_line() -> Column:
    return F.concat(F.lit("('"), F.col("store_id"), F.lit("', "), F.col("profit").cast("string"), F.lit(")"))


def pane_line() -> Column:
    return F.concat(F.lit("('"), F.col("store_id"), F.lit("', "), F.col("total").cast("string"), F.lit(")"))
