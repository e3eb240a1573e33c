"""Attendance counts, names and places of employees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyworks.functions.text import length_between
from tallyworks.operators.cogroup import MAX_LIST, cogroup
from tallyworks.operators.keyed import combined_pair, keyed_count
from tallyworks.operators.rows import exclude, route_distinct


def attendance_count(attendance: DataFrame, dept: str = "Accounts") -> DataFrame:
    """Days per employee name of one department."""
    return keyed_count(attendance.where(F.col("dept") == dept), ["name"])


def pair_line(key: str, value: str) -> Column:
    return F.concat(F.lit("('"), F.col(key), F.lit("', "), F.col(value).cast("string"), F.lit(")"))


def names_and_places(attendance: DataFrame, location: DataFrame, max_list: int = MAX_LIST) -> DataFrame:
    """Distinct names and distinct cities per employee id."""
    names = attendance.select("employee_id", "name").distinct()
    cities = location.select("employee_id", "city").distinct()
    return cogroup({"cities": cities, "names": names}, "employee_id", max_list)


def name_rules(name: str, cutoff: int, marker: str) -> dict[str, Column]:
    length = F.length(name)
    return {
        "short": length <= cutoff,
        "long": length > cutoff,
        "marked": F.col(name).startswith(marker),
    }


def routed_names(attendance: DataFrame, cutoff: int = 4, marker: str = "A") -> DataFrame:
    """Distinct names as short, long and starting with the marker. A name can have two tags."""
    return route_distinct(attendance, "name", name_rules("name", cutoff, marker))


def attendance_without(
    attendance: DataFrame, ids: DataFrame, dept: str = "Accounts", lower: int = 3, upper: int | None = 10
) -> DataFrame:
    """Days per employee of one department, without the listed ids and with names of a given length.

    Counting comes first, so the exclusion meets one row per employee.
    """
    counted = combined_pair(attendance.where(F.col("dept") == dept), ["employee_id"], "name")
    kept = exclude(counted, ids, "employee_id")
    return kept.where(length_between(F.col("name"), lower, upper))
