"""Column layouts of the inputs, by position. Columns that may not be NULL reject the row when bad."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, LONG, DOUBLE, DAY, TIME = T.StringType(), T.LongType(), T.DoubleType(), T.DateType(), T.TimestampType()


def layout(*columns: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, not required) for name, kind, required in columns])


def needing(base: T.StructType, *required: str) -> T.StructType:
    """The same columns, of which only the named ones are required."""
    return T.StructType([T.StructField(f.name, f.dataType, f.name not in required) for f in base.fields])


ATTENDANCE = layout(
    ("employee_id", TEXT, True),
    ("name", TEXT, True),
    ("dept_id", LONG, False),
    ("dept", TEXT, True),
    ("day", DAY, False),
)

LOCATION = layout(("employee_id", TEXT, True), ("phone", TEXT, False), ("city", TEXT, True))

CARD = layout(
    ("customer_id", TEXT, True),
    ("first_name", TEXT, False),
    ("last_name", TEXT, False),
    ("relationship_id", TEXT, False),
    ("card_type", TEXT, False),
    ("max_limit", DOUBLE, True),
    ("spent", DOUBLE, True),
    ("cash_withdrawn", DOUBLE, False),
    ("payment_cleared", DOUBLE, True),
    ("payment_date", DAY, False),
)

LOAN = layout(
    ("customer_id", TEXT, True),
    ("first_name", TEXT, False),
    ("last_name", TEXT, False),
    ("customer_type", TEXT, False),
    ("loan_id", TEXT, False),
    ("loan_category", TEXT, True),
    ("due_date", DAY, False),
    ("amount", LONG, False),
    ("payment_date", DAY, False),
)

STORE_SALE = layout(
    ("store_id", TEXT, True),
    ("store_location", TEXT, True),
    ("product_id", TEXT, False),
    ("product_category", TEXT, False),
    ("pieces_sold", LONG, True),
    ("buy_rate", LONG, True),
    ("sell_price", LONG, True),
)

TIMED_STORE_SALE = T.StructType([*STORE_SALE.fields, T.StructField("sold_at", TIME, False)])

KILL = layout(
    ("game_id", TEXT, True),
    ("player_id", TEXT, True),
    ("player_name", TEXT, False),
    ("team_id", TEXT, True),
    ("team_name", TEXT, False),
    ("used_weapon", TEXT, True),
    ("rank_of_weapon", LONG, True),
    ("killer_location", TEXT, True),
    ("prey_id", TEXT, False),
    ("prey_name", TEXT, False),
    ("prey_team_id", TEXT, False),
    ("prey_team_name", TEXT, False),
    ("prey_weapon_name", TEXT, False),
    ("prey_weapon_rank", LONG, True),
    ("prey_location", TEXT, True),
    ("engagement_seconds", LONG, True),
    ("kill_ts", TIME, True),
)

NUMBER = layout(("n", LONG, True))
