"""Numbers, dates and times out of text. Bad text gives NULL, never an error."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

from tallyworks.functions.text import is_digits, scrub_timestamp, strip

DAY_PATTERN = "d-M-yyyy"


def to_long(text: Column) -> Column:
    return strip(text).try_cast("bigint")


def to_double(text: Column) -> Column:
    return strip(text).try_cast("double")


def to_day(text: Column) -> Column:
    """A day-month-year text as a date; day and month may have one digit."""
    return F.try_to_timestamp(strip(text), F.lit(DAY_PATTERN)).cast("date")


def to_event_time(text: Column) -> Column:
    """Unix seconds, possibly with junk around the digits, as a timestamp."""
    digits = scrub_timestamp(text)
    return F.timestamp_seconds(F.when(is_digits(digits), digits.try_cast("bigint")))


# An exact sum adds the low bits of its units and the rest apart.
LOW_BITS = 20
# Values of up to so many units go through double without a loss; larger ones are added as decimals.
DOUBLE_UNITS = 2**52


def _fits_double(value: Column, scale: int) -> Column:
    return F.coalesce(F.abs(value) <= F.lit(DOUBLE_UNITS / 10**scale), F.lit(False))


def units(value: Column, scale: int = 2) -> Column:
    """The value as a whole number of its smallest unit, such as cents for scale 2.

    Sums of doubles change in the last digits with the partitioning and with
    task retries; sums of units do not, and cost no more. A value that has no such
    number, such as NaN or one beyond a long, is an error.
    """
    small = F.rint(value * F.lit(float(10**scale))).try_cast("bigint")
    large = (value.try_cast(f"decimal(38,{scale})") * F.lit(10**scale).cast("decimal(10,0)")).try_cast("bigint")
    held = F.when(_fits_double(value, scale), small).otherwise(large)
    bad = F.raise_error(F.concat(F.lit("no whole number of units: "), value.cast("string"))).cast("bigint")
    return F.when(value.isNotNull(), F.coalesce(held, bad))


def from_units(total: Column, scale: int = 2) -> Column:
    return total.cast("double") / F.lit(float(10**scale))


def inexact(value: Column, scale: int = 2) -> Column:
    """Whether an exact sum cannot hold the value: NaN, infinity and what is beyond a decimal."""
    return value.isNotNull() & ~_fits_double(value, scale) & value.try_cast(f"decimal(38,{scale})").isNull()


def finite_sum(value: Column, scale: int = 2) -> Column:
    """Sum of the values that are not inexact, as a decimal with the given scale.

    Usual values are held in two long sums, of the low bits and of the rest, so
    that they do not overflow where one long would. Sums of decimals would need an
    object per row and take about three times as long; only values beyond the
    whole numbers of a double are added in this way.
    """
    fits = _fits_double(value, scale)
    whole = F.when(fits, F.rint(value * F.lit(float(10**scale))).try_cast("bigint"))
    high = F.sum(F.shiftright(whole, LOW_BITS)).cast("decimal(20,0)")
    low = F.sum(whole.bitwiseAND(F.lit(2**LOW_BITS - 1))).cast("decimal(20,0)")
    total = (high * F.lit(2**LOW_BITS).cast("decimal(7,0)") + low) * F.lit(Decimal(1).scaleb(-scale))
    large = F.sum(F.when(~fits, value.try_cast(f"decimal(38,{scale})")))
    return F.when(large.isNull(), total).otherwise(large + F.coalesce(total, F.lit(0)))


def exact_sum(value: Column, scale: int = 2) -> Column:
    """Sum of all values as a decimal with the given scale, the same for every partitioning. NaN and infinity are errors."""
    bad = F.raise_error(F.lit("a sum of NaN, infinity or values beyond a decimal is not exact"))
    return F.when(F.count_if(inexact(value, scale)) > 0, bad.cast(f"decimal(38,{scale})")).otherwise(finite_sum(value, scale))


def late_flag(due: Column, paid: Column) -> Column:
    """1 when paid after the due date, 0 when in time or when a date is missing."""
    return F.coalesce((due < paid).cast("int"), F.lit(0))
