"""The ready-made queries on files, with known answers."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyworks.functions.text import fields, is_digits, scrub_timestamp, strip
from tallyworks.functions.values import exact_sum, to_day, to_double, to_long, units
from tallyworks.operators import keyed, rows, windows
from tallyworks.plans import attendance, bank, game, store
from tallyworks.sources import files, layouts, sinks, topics
from tests import fixtures


def lines_of(spark, path):
    return sorted(r[0] for r in spark.read.text(path).collect())


def tuples(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def staff(spark, tmp_path_factory):
    path = fixtures.attendance(tmp_path_factory.mktemp("in"))
    found, rejects = files.scan_delimited(spark, path, layouts.ATTENDANCE)
    assert rejects.count() == 0
    return found


def test_attendance(spark, staff, tmp_path):
    counted = attendance.attendance_count(staff)
    out = str(tmp_path / "out")
    sinks.write_lines(counted, attendance.pair_line("name", "n"), out)
    assert lines_of(spark, out) == sorted(
        f"('{n}', {c})"
        for n, c in dict(
            Tomas=5, Bettina=5, Luis=5, Henrike=5, Sam=10, Noemi=5, Ulrike=5, Arvid=3
        ).items()
    )


def test_names_and_places(spark, staff, tmp_path):
    places, _ = files.scan_delimited(spark, fixtures.location(tmp_path), layouts.LOCATION)
    got = {r["employee_id"]: (r["cities"], r["names"]) for r in attendance.names_and_places(staff, places).collect()}
    assert len(got) == len(fixtures.STAFF) + 1
    assert got["E1"] == (["Lund"], ["Tomas"])
    assert got["E3"] == ([], ["Luis"])
    assert got["X9"] == (["Turku"], [])


def test_routing(spark, staff, tmp_path):
    routed = attendance.routed_names(staff)
    out = str(tmp_path / "tags")
    sinks.write_tagged(routed, out)
    tagged = {t: sorted(r[0] for r in spark.read.parquet(f"{out}/tag={t}").collect()) for t in ("short", "long", "marked")}
    assert tagged["short"] == ["Bo", "Dirk", "Luis", "Sam", "Vera"]
    assert tagged["long"] == ["Arvid", "Bettina", "Henrike", "Noemi", "Tomas", "Ulrike"]
    assert tagged["marked"] == ["Arvid"]


def test_exclusion(spark, staff, tmp_path):
    path = fixtures.write(tmp_path, "ids.txt", ["E1 ", "E5", "", "nobody"])
    ids = files.scan_ids(spark, path, "employee_id")
    assert ids.count() == 3
    got = tuples(attendance.attendance_without(staff, ids, upper=6))
    assert got == [("E3", "Luis", 5), ("E6", "Sam", 5), ("E7", "Noemi", 5), ("E8", "Ulrike", 5), ("E9", "Arvid", 3)]
    assert attendance.attendance_without(staff, ids, upper=None).count() == 7


def test_mean(spark):
    assert keyed.global_mean(files.literal(spark, range(10, 21)), F.col("value")).first()[0] == 15.0
    empty = keyed.global_mean(files.literal(spark, []), F.col("value")).first()[0]
    assert empty != empty
    assert keyed.global_mean(files.literal(spark, [], kind="double"), F.col("value"), scale=2).first()[0] != 0


def test_words(spark, tmp_path):
    path = fixtures.write(tmp_path, "play.txt", ["now, fair now", "Now, now, now! " * 3, "now, x1y2"])
    got = dict(tuples(rows.word_counts(files.scan_lines(spark, path), "value", 3)))
    assert got == {"now,": 5, "now": 4}
    assert dict(tuples(rows.word_counts(files.scan_lines(spark, path), "value", 0)))["y"] == 1


@pytest.fixture(scope="module")
def cards(spark, tmp_path_factory):
    path = fixtures.write(tmp_path_factory.mktemp("cards"), "cards.csv", fixtures.CARD_LINES)
    return files.scan_delimited(spark, path, layouts.CARD, header=True)


def test_card_defaulters(spark, cards, tmp_path):
    found, rejects = cards
    assert found.count() == 6
    bad = {r["line"].split(",")[0]: r["bad_columns"] for r in rejects.collect()}
    assert bad == {"C5": ["spent"], "C6": ["max_limit", "spent", "payment_cleared"]}
    out = str(tmp_path / "out")
    sinks.write_lines(bank.card_defaulters(found), bank.card_line(), out)
    assert lines_of(spark, out) == ["C1, 4, Nils Berg", "C2, , Ann Lee", "C3, 1, Bo Kim", "C4, , Cy Fox"]
    assert {r[0] for r in bank.card_defaulters(found, keep_clear=False).collect()} == {"C1", "C3"}
    assert dict(tuples(bank.card_totals(found, ["customer_id"], True))) == {"C1": 4, "C3": 1, "C4": 1}
    assert [tuple(r) for r in bank.top_defaulters(found, 1).collect()] == [("C1", 4)]


@pytest.fixture(scope="module")
def loans(spark, tmp_path_factory):
    path = fixtures.write(tmp_path_factory.mktemp("loans"), "loans.csv", fixtures.loan_lines())
    return files.scan_delimited(spark, path, layouts.LOAN, header=True)


def test_medical(spark, loans, tmp_path):
    found, rejects = loans
    assert [r["bad_columns"] for r in rejects.collect()] == [["payment_date"]]
    out = str(tmp_path / "out")
    sinks.write_lines(bank.medical_loan_defaulters(found), bank.loan_line(), out)
    assert lines_of(spark, out) == ["M3, Al Day,3", "M4, Al Day,3"]


def test_personal(loans):
    got = {r["customer_id"]: (r["missed"], r["longest_gap"]) for r in bank.personal_loan_defaulters(loans[0]).collect()}
    assert got == {"PSTART": (2, 2), "PMID": (2, 2), "PEND": (2, 2), "P4": (4, 1)}
    assert bank.personal_loan_defaulters(loans[0], in_all=5, in_a_row=3).count() == 0


def test_both(cards, loans):
    got = {r["customer_id"]: (r["card_defaulter"], r["loan_defaulter"]) for r in bank.both_defaulters(cards[0], loans[0]).collect()}
    assert got["C1"] == (["Nils Berg, 4 fraud_points"], [])
    assert got["M3"] == ([], ["Al Day, 3 missed"])
    assert got["PMID"] == ([], ["Al Day, 2 missed"])
    assert set(got) == {"C1", "C3", "M3", "M4", "PSTART", "PMID", "PEND", "P4"}


def kills(spark, lines):
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    return files.split_lines(df, layouts.KILL)


@pytest.mark.parametrize(
    "seconds, points", [(9, 0), (10, 4), (20, 4), (21, 3), (30, 3), (31, 2), (40, 2), (41, 1), (500, 1)]
)
def test_engagement_bounds(spark, seconds, points):
    found, _ = kills(spark, [fixtures.kill_line(seconds=seconds, rank=1, place="A", prey_place="A")])
    assert game.with_points(found).first()["points"] == points + 1


@pytest.mark.parametrize(
    "difference, written, stacked, from_six", [(2, 1, 1, 1), (3, 2, 2, 2), (5, 2, 2, 2), (6, 2, 2, 3), (7, 3, 4, 3), (-7, 1, 1, 1)]
)
def test_rank_rules(spark, difference, written, stacked, from_six):
    found, _ = kills(spark, [fixtures.kill_line(seconds=0, rank=10 + difference, prey_rank=10, place="A", prey_place="A")])
    for rule, points in (("written", written), ("stacked", stacked), ("from_six", from_six)):
        assert game.with_points(found, rule).first()["points"] == points


def test_kill_rejects(spark):
    lines = [
        fixtures.kill_line(),
        fixtures.kill_line(at="'1700000001\\r\\n'"),
        fixtures.kill_line(at="17000x"),
        fixtures.kill_line(seconds="fast"),
        "G7,W1,First",
    ]
    found, rejects = kills(spark, lines)
    assert [r["points"] for r in game.with_points(found).collect()] == [9, 9]
    bad = sorted(rejects.collect(), key=lambda r: r["line"])
    assert len(bad) == 3
    assert [["engagement_seconds"], ["kill_ts"]] == sorted(r["bad_columns"] for r in bad if len(r["bad_columns"]) == 1)


def test_weapon_sessions(spark):
    starts = [0, 4, 9, 13, 14]  # gaps 4, 5, 4, 1 seconds
    lines = [fixtures.kill_line(at=str(1700000000 + s), seconds=10 + 11 * i) for i, s in enumerate(starts)]
    found, _ = kills(spark, lines)
    got = game.weapon_sessions(found).select(F.unix_seconds("session_start") - 1700000000, "mean_points", "n").collect()
    assert sorted(tuple(r) for r in got) == [(0, 8.5, 2), (9, 19 / 3, 3)]
    line = game.weapon_sessions(found).select(game.weapon_line().alias("line")).collect()
    assert "G7,W1,Spear: 8.5" in {r[0] for r in line}


def test_scores(spark):
    players = ["A", "B", "A", "A", "C", "A", "B"]
    found, _ = kills(spark, [fixtures.kill_line(who=p, team="T1" if p in "AB" else "T2") for p in players])
    got = game.player_team_scores(found)
    assert tuples(got) == [("player", "A", 2), ("player", "A", 4), ("player", "B", 2)] + [("team", "T1", s) for s in (2, 4, 6)]
    assert {r[0] for r in got.select(game.score_line()).collect()} == {"A: 2", "A: 4", "B: 2", "T1: 2", "T1: 4", "T1: 6"}


def test_store_panes(spark, tmp_path):
    path = fixtures.write(tmp_path, "sales.csv", fixtures.sales_lines())
    found, rejects = files.scan_delimited(spark, path, layouts.STORE_SALE, header=True)
    assert rejects.count() == 0
    # One file in one partition: the row number is the arrival number.
    arrived = found.coalesce(1).withColumn("seq", F.monotonically_increasing_id())
    profit1 = [(2 + i % 3) * (i + 1) for i in range(12)]
    profit2 = [2 * (i - 1) for i in range(7)]
    full = [("STR_1", 0, 5, sum(profit1[:5])), ("STR_1", 1, 5, sum(profit1[5:10])), ("STR_2", 0, 5, sum(profit2[:5]))]
    assert tuples(store.profit_panes(arrived, "seq")) == full
    rest = [("STR_1", 2, 2, sum(profit1[10:])), ("STR_2", 1, 2, sum(profit2[5:]))]
    assert tuples(store.profit_panes(arrived, "seq", flush=True)) == sorted(full + rest)
    line = store.profit_panes(arrived, "seq").select(store.pane_line()).first()[0]
    assert line.startswith("('STR_") and line.endswith(")")


def test_store_windows(spark):
    lines = [f"{line},{1553577240 + 7 * i}" for i, line in enumerate(fixtures.sales_lines()[1:13])]
    found, _ = files.split_lines(spark.createDataFrame([(v,) for v in lines], "value string"), layouts.TIMED_STORE_SALE)
    want = {}
    for line in lines:
        store_id, city, _, _, pieces, buy, sell, at = line.split(",")
        if city in store.CITIES:
            key = (store_id, int(at) // 20 * 20)
            want[key] = want.get(key, 0) + (int(sell) - int(buy)) * int(pieces)
    got = store.profit_windows(found).select("store_id", F.unix_seconds("window_start"), "profit").collect()
    assert {(r[0], r[1]): r[2] for r in got} == want


def test_scan_of_numbers_with_mark(spark, tmp_path):
    path = fixtures.write(tmp_path, "counts.csv", ["\ufeffCounts", "1", "2", "oops", "3"])
    found, rejects = files.scan_delimited(spark, path, layouts.NUMBER, header=True)
    assert tuples(found) == [(1,), (2,), (3,)]
    assert [r["line"] for r in rejects.collect()] == ["oops"]
    messages = found.select(*topics.envelope(F.col("n"))).collect()
    assert sorted((r["value"], r["attributes"]["even"]) for r in messages) == [
        ("Send number: 1", "False"),
        ("Send number: 2", "True"),
        ("Send number: 3", "False"),
    ]


def test_scrub(spark):
    df = spark.createDataFrame([(" '155\\r\\n' \r\n",), ("15x",), ("",)], "t string")
    got = [tuple(r) for r in df.select(scrub_timestamp(F.col("t")), is_digits(scrub_timestamp(F.col("t")))).collect()]
    assert got == [("155", True), ("15x", False), ("", False)]


@pytest.mark.parametrize(
    "day, want",
    [("1-01-2019", "2019-01-01"), ("1-1-2019", "2019-01-01"), (" 30-12-2018\r\n", "2018-12-30"), ("31-02-2019", None), ("2019-01-01", None), ("", None)],
)
def test_days(spark, day, want):
    got = spark.createDataFrame([(day,)], "t string").select(to_day(F.col("t")).cast("string")).first()[0]
    assert got == want


def test_numbers_and_fields(spark):
    df = spark.createDataFrame([("\u00a0 12\t,12.5, x ,,",)], "line string")
    parts = df.select(*fields(F.col("line"), list("abcdefg")))
    assert list(parts.first()) == ["\u00a0 12\t", "12.5", " x ", "", "", None, None]
    got = parts.select(to_long(F.col("a")), to_long(F.col("b")), to_double(F.col("b")), strip(F.col("c")), to_long(F.col("d")))
    assert list(got.first()) == [12, None, 12.5, "x", None]
    piped = spark.createDataFrame([("a|b",)], "line string").select(*fields(F.col("line"), ["l", "r"], "|"))
    assert list(piped.first()) == ["a", "b"]


def test_sums_lose_nothing(spark):
    """Integers and decimals beyond the whole numbers of a double, and values that no decimal holds."""
    def sums(values, kind, scale=2):
        df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
        return df.agg(exact_sum(F.col("v"), scale)).first()[0]

    assert sums([9007199254740993, 2], "bigint") == 9007199254740995
    wide = [Decimal("123456789012345678.91"), Decimal("0.93")]
    assert sums(wide, "decimal(20,2)") == sum(wide)
    assert sums([1e20, 2.0], "double") == Decimal("100000000000000000002.00")
    with pytest.raises(Exception, match="not exact"):
        sums([float("nan"), 2.0], "double")
    means = {}
    for value in (float("nan"), float("inf"), 1e20, 1e300):
        df = spark.createDataFrame([(value,), (2.0,)], "v double")
        means[str(value)] = keyed.global_mean(df, F.col("v"), scale=2).first()[0]
    assert means["nan"] != means["nan"] and means["inf"] == float("inf")
    assert means["1e+20"] == 5e19 and means["1e+300"] == 5e299
    with pytest.raises(Exception, match="no whole number of units"):
        spark.createDataFrame([(1e30,)], "v double").select(units(F.col("v"))).collect()


def test_session_mean_rounds_only_when_asked(spark):
    df = spark.createDataFrame([("a", 0, 0.004), ("a", 1, 0.002)], "k string, t bigint, v double")
    df = df.select("k", F.timestamp_seconds("t").alias("ts"), "v")
    assert windows.session_mean(df, ["k"], "ts", 5_000_000, F.col("v")).first()["mean"] == pytest.approx(0.003)
    assert windows.session_mean(df, ["k"], "ts", 5_000_000, F.col("v"), scale=2).first()["mean"] == 0.0


def test_empty_required_text_is_a_reject_from_every_source(spark, tmp_path):
    path = fixtures.write(tmp_path, "places.txt", [",1,Lund", "E1,,Graz"])
    lines = spark.createDataFrame([(",1,Lund",), ("E1,,Graz",)], "value string")
    for found, rejects in (files.scan_delimited(spark, path, layouts.LOCATION), files.split_lines(lines, layouts.LOCATION)):
        assert [r["employee_id"] for r in found.collect()] == ["E1"]
        assert [r["bad_columns"] for r in rejects.collect()] == [["employee_id"]]


def test_sale_without_time_is_a_reject(spark):
    lines = spark.createDataFrame([(f"{fixtures.sales_lines()[1]},",)], "value string")
    found, rejects = files.split_lines(lines, layouts.TIMED_STORE_SALE)
    assert found.count() == 0 and [r["bad_columns"] for r in rejects.collect()] == [["sold_at"]]


def test_replay_keeps_rows_without_a_number(spark, tmp_path):
    for name, rows_, waves in (("a", [(1, "x"), (None, "y"), (9, "z")], 2), ("b", [(None, "x"), (None, "y")], 3)):
        df = spark.createDataFrame(rows_, "seq bigint, value string")
        path = str(tmp_path / name)
        list(topics.replay(df, "seq", path, waves))
        assert spark.read.parquet(path).count() == len(rows_)


def test_exact_sum(spark):
    values = [0.1] * 10 + [1e13, -1e13, -0.3]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    assert str(df.agg(exact_sum(F.col("v"))).first()[0]) == "0.70"
    assert df.where("v > 1e20").agg(exact_sum(F.col("v"))).first()[0] is None
