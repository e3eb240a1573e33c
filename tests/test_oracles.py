"""Every registered query against its SQL, row by row."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyworks.functions.values import from_units, units
from tallyworks.operators import panes, windows
from tallyworks.plans import tables
from tallyworks.plans.oracles import ORACLES
from tests.compare import connect, spark_rows, sql_rows

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(ORACLES) == set(entry.queries()) - set(entry.TEXT_QUERIES)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, con, name):
    got = spark_rows(entry.queries()[name](spark, FOLDER))
    want = sql_rows(con, ORACLES[name])
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert len(got[1]) > 0
    assert got[1] == want[1]


def test_sorted_points_are_in_order(spark):
    found = [(-row["points"], row["customer_id"]) for row in entry.queries()["sorted_points"](spark, FOLDER).collect()]
    assert found == sorted(found)


def test_entry(spark):
    assert entry.entry(spark).columns == ["o_custkey", "n"]


HOT = {
    "pane_discarding": lambda events, value: panes.discarding_panes(events, ["user_id"], "event_id", value, 5, slot_rows=30),
    "pane_accumulating": lambda events, value: panes.accumulating_panes(events, ["user_id"], "event_id", value, 2, slot_rows=30),
}


@pytest.mark.parametrize("name", list(HOT))
def test_split_panes_equal_sql(spark, con, name):
    """Every user counts as hot here, so that all rows take the split path."""
    found = HOT[name](tables.table(spark, FOLDER, "events"), units(F.col("value")))
    got = spark_rows(found.withColumn("total", from_units(F.col("total"))))
    assert got == sql_rows(con, entry.oracle_sql()[name])


def test_linked_sessions_equal_sql(spark, con):
    events = tables.table(spark, FOLDER, "events")
    got = windows.session_mean(events, ["user_id"], "ts", tables.GAP_US, F.col("value"), group_rows=30, scale=2)
    assert spark_rows(got) == sql_rows(con, entry.oracle_sql()["session_mean"])
