"""Point rules for card payments and for game kills."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values of the card rules.
MIN_CLEARED_SHARE = 0.7

# Fixed values of the kill rules: (lowest, highest) engagement seconds -> points.
ENGAGEMENT_POINTS = {(10, 20): 4, (21, 30): 3, (31, 40): 2, (41, None): 1}
LOCATION_POINTS = 3


def card_points(
    limit: Column,
    spent: Column,
    cleared: Column,
    min_share: float = MIN_CLEARED_SHARE,
    count_overpaid: bool = False,
) -> Column:
    """0, 1 or 3 points for one monthly card row.

    One point for clearing less than ``min_share`` of the spending, one for
    spending the whole limit without clearing it, one more for both.
    ``count_overpaid`` makes the second rule hold for any cleared amount other
    than the spending, so an overpayment counts too.
    """
    short = cleared < spent * F.lit(min_share)
    unpaid = (cleared != spent) if count_overpaid else (cleared < spent)
    maxed = (spent == limit) & unpaid
    one = lambda rule: F.when(rule, 1).otherwise(0)
    return (one(short) + one(maxed) + one(short & maxed)).cast("bigint")


def engagement_points(seconds: Column) -> Column:
    points = F.lit(0)
    for (low, high), value in ENGAGEMENT_POINTS.items():
        hit = seconds >= low if high is None else seconds.between(low, high)
        points = points + F.when(hit, value).otherwise(0)
    return points


def rank_points(difference: Column, rule: str = "written") -> Column:
    """Points for the rank difference of killer and prey.

    ``written``: above 6 gives 3, 3 to 6 gives 2, all else 1.
    ``stacked``: as written, but above 6 gives 4.
    ``from_six``: 6 and above gives 3, 3 to 5 gives 2, all else 1.
    """
    high, top = {"written": (7, 3), "stacked": (7, 4), "from_six": (6, 3)}[rule]
    return F.when(difference >= high, top).when(difference >= 3, 2).otherwise(1)


def weapon_points(
    seconds: Column,
    rank: Column,
    prey_rank: Column,
    place: Column,
    prey_place: Column,
    rank_rule: str = "written",
) -> Column:
    """Points of one kill: engagement time, rank difference and place."""
    elsewhere = F.when(place != prey_place, LOCATION_POINTS).otherwise(0)
    total = engagement_points(seconds) + rank_points(rank - prey_rank, rank_rule) + elsewhere
    return total.cast("bigint")
