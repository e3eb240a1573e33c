"""Card and loan defaulters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyworks.functions import scoring
from tallyworks.functions.text import full_name, joined
from tallyworks.functions.values import late_flag
from tallyworks.operators.cogroup import cogroup
from tallyworks.operators.keyed import above, at_least, keyed_sum
from tallyworks.operators.periods import missed_periods
from tallyworks.operators.rows import top_by_points, union_all

# Fixed values of the loan rules.
LATE_PAYMENTS = 3
MISSED_IN_ALL = 4
MISSED_IN_A_ROW = 2
MONTHS = 12


def with_name(df: DataFrame) -> DataFrame:
    return df.withColumn("full_name", full_name(F.col("first_name"), F.col("last_name")))


def card_totals(cards: DataFrame, keys: list[str], count_overpaid: bool = False) -> DataFrame:
    """Defaulter points per customer, for customers with any."""
    points = scoring.card_points(
        F.col("max_limit"), F.col("spent"), F.col("payment_cleared"), count_overpaid=count_overpaid
    )
    return above(keyed_sum(cards, keys, points, "points"), "points", 0)


def card_defaulters(cards: DataFrame, keep_clear: bool = True, count_overpaid: bool = False) -> DataFrame:
    """Points and distinct names of each customer, both as lists, in one aggregate.

    Customers without points stay in with an empty list of points unless ``keep_clear`` is off.
    """
    points = scoring.card_points(
        F.col("max_limit"), F.col("spent"), F.col("payment_cleared"), count_overpaid=count_overpaid
    )
    grouped = with_name(cards).groupBy("customer_id").agg(
        F.coalesce(F.sum(points), F.lit(0)).cast("bigint").alias("points"),
        F.sort_array(F.collect_set("full_name")).alias("names"),
    )
    found = grouped if keep_clear else above(grouped, "points", 0)
    listed = F.filter(F.array("points"), lambda total: total > 0)
    return found.withColumn("points", listed)


def card_line() -> Column:
    return F.concat_ws(", ", "customer_id", joined(F.col("points")), joined(F.col("names")))


def top_defaulters(cards: DataFrame, k: int) -> DataFrame:
    """The customers with the most points."""
    return top_by_points(card_totals(cards, ["customer_id"]), "points", "customer_id", k)


def of_category(loans: DataFrame, category: str) -> DataFrame:
    """Loans of one category. Scans have stripped the text, so that the filter is on the bare column and reaches the source."""
    return loans.where(F.col("loan_category") == category)


def late_totals(payments: DataFrame, keys: list[str], due: str, paid: str, least: int = LATE_PAYMENTS) -> DataFrame:
    """Late payments per key, for keys with at least ``least``."""
    late = late_flag(F.col(due), F.col(paid)).cast("bigint")
    return at_least(keyed_sum(payments, keys, late, "late_payments"), "late_payments", least)


def medical_loan_defaulters(loans: DataFrame, least: int = LATE_PAYMENTS) -> DataFrame:
    medical = with_name(of_category(loans, "Medical Loan"))
    return late_totals(medical, ["customer_id", "full_name"], "due_date", "payment_date", least)


def missed_totals(
    payments: DataFrame,
    keys: list[str],
    period: str,
    periods: int = MONTHS,
    in_all: int = MISSED_IN_ALL,
    in_a_row: int = MISSED_IN_A_ROW,
) -> DataFrame:
    """Keys that missed ``in_all`` periods, or ``in_a_row`` periods one after the other."""
    gaps = missed_periods(payments, keys, period, periods)
    return gaps.where((F.col("missed") >= in_all) | (F.col("longest_gap") >= in_a_row))


def personal_loan_defaulters(
    loans: DataFrame, in_all: int = MISSED_IN_ALL, in_a_row: int = MISSED_IN_A_ROW
) -> DataFrame:
    """Missed months of the payment date, per customer.

    The stored variant of the rule is ``in_all=5, in_a_row=3``.
    """
    personal = with_name(of_category(loans, "Personal Loan")).withColumn("month", F.month("payment_date"))
    return missed_totals(personal, ["customer_id", "full_name"], "month", MONTHS, in_all, in_a_row)


def missed_payments(in_all: int = MISSED_IN_ALL) -> Column:
    """The number reported for a missed-period defaulter: all missed periods if many, else the longest gap."""
    return F.when(F.col("missed") >= in_all, F.col("missed")).otherwise(F.col("longest_gap"))


def loan_line() -> Column:
    return F.concat(F.col("customer_id"), F.lit(", "), F.col("full_name"), F.lit(","), F.col("late_payments"))


def both_defaulters(cards: DataFrame, loans: DataFrame) -> DataFrame:
    """Card and loan findings of every customer who is a defaulter of either kind.

    The findings are texts, ``<name>, <n> fraud_points`` and ``<name>, <n> missed``.
    """
    card = card_totals(with_name(cards), ["customer_id", "full_name"]).select(
        "customer_id", F.format_string("%s, %d fraud_points", "full_name", "points").alias("finding")
    )
    medical = medical_loan_defaulters(loans).select(
        "customer_id", F.format_string("%s, %d missed", "full_name", "late_payments").alias("finding")
    )
    personal = personal_loan_defaulters(loans).select(
        "customer_id", F.format_string("%s, %d missed", F.col("full_name"), missed_payments()).alias("finding")
    )
    sides = {"card_defaulter": card, "loan_defaulter": union_all([personal, medical])}
    # A customer has one finding per name and kind.
    return cogroup(sides, "customer_id", short=("card_defaulter", "loan_defaulter"))
