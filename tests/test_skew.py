"""Hot keys: the split paths against brute force, on fixtures where one key has a third of the rows."""

import math
import random
import statistics
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import own, panes, rows, windows
from tallyworks.operators.cogroup import cogroup
from tallyworks.operators.periods import missed_periods
from tallyworks.operators.skew import heavy_keys


@pytest.fixture(scope="module")
def arrivals():
    """(key, seq, value): key 'hot' and key None are large, the rest small."""
    rng = random.Random(5)
    seqs = list(range(100, 3100))
    rng.shuffle(seqs)
    found = []
    for i, seq in enumerate(seqs):
        key = "hot" if i % 3 == 0 else None if i % 3 == 1 and i % 2 else f"k{rng.randrange(40)}"
        found.append((key, seq, rng.randrange(-50, 100)))
    return found


def by_key(items):
    grouped = defaultdict(list)
    for key, seq, value in sorted(items, key=lambda r: r[1]):
        grouped[key].append(value)
    return grouped


def frame(spark, items):
    return spark.createDataFrame(items, "key string, seq bigint, value bigint").repartition(7)


def test_heavy_keys(spark, arrivals):
    df = frame(spark, arrivals)
    found = {r["key"]: r["key_rows"] for r in heavy_keys(df, ["key"], 200).collect()}
    assert found == {k: len(v) for k, v in by_key(arrivals).items() if len(v) > 200}
    assert set(found) == {"hot", None}
    assert heavy_keys(df, ["key"], 5000) is None


@pytest.mark.parametrize("slot_rows", [64, 10_000])
@pytest.mark.parametrize("n", [1, 5])
def test_discarding(spark, arrivals, slot_rows, n):
    want = set()
    for key, found in by_key(arrivals).items():
        for pane in range(len(found) // n):
            want.add((key, pane, n, sum(found[pane * n : (pane + 1) * n])))
    got = panes.discarding_panes(frame(spark, arrivals), ["key"], "seq", F.col("value"), n, slot_rows=slot_rows)
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("most", [3, 100_000])
def test_own_aggregates(spark, arrivals, monkeypatch, most):
    """A hot key, a NULL key, NULL values and keys without a value, with states sent early and late."""
    monkeypatch.setattr(own, "MOST_KEYS", most)
    found = [*((k, v) for k, _, v in arrivals), ("hot", None), ("empty", None), ("one", 7)]
    df = spark.createDataFrame(found, "key string, value bigint").repartition(7)
    groups = defaultdict(list)
    for key, value in found:
        groups[key] += [] if value is None else [value]
    means = {r.key: r.m for r in own.aggregate_own(df, ["key"], F.col("value"), own.Mean(), "m").collect()}
    assert means.keys() == groups.keys() and math.isnan(means.pop("empty"))
    assert means == {k: sum(v) / len(v) for k, v in groups.items() if v}
    variances = {r.key: r.m for r in own.aggregate_own(df, ["key"], F.col("value"), own.Variance(), "m").collect()}
    assert variances["one"] is None and variances["empty"] is None
    for key, values in groups.items():
        if len(values) > 1:
            assert variances[key] == pytest.approx(statistics.variance(values))
    whole = own.aggregate_own(df, [], F.col("value"), own.Mean(), "m").collect()
    every = [v for values in groups.values() for v in values]
    assert [r.m for r in whole] == [sum(every) / len(every)]
    assert [math.isnan(r.m) for r in own.aggregate_own(df.limit(0), [], F.col("value"), own.Mean(), "m").collect()] == [True]
    assert own.aggregate_own(df.limit(0), ["key"], F.col("value"), own.Mean(), "m").collect() == []


def test_discarding_flush(spark, arrivals):
    got = panes.discarding_panes(
        frame(spark, arrivals), ["key"], "seq", F.col("value"), 7, flush=True, slot_rows=64
    ).collect()
    assert sum(r["n"] for r in got) == len(arrivals)
    assert sum(r["total"] for r in got) == sum(v for _, _, v in arrivals)


@pytest.mark.parametrize("slot_rows", [64, 10_000])
def test_accumulating(spark, arrivals, slot_rows):
    want = set()
    for key, found in by_key(arrivals).items():
        for count in range(2, len(found) + 1, 2):
            want.add((key, count // 2 - 1, count, sum(found[:count])))
    got = panes.accumulating_panes(frame(spark, arrivals), ["key"], "seq", F.col("value"), 2, slot_rows=slot_rows)
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("slot_rows", [64, 10_000])
def test_numbering_on_earlier_input(spark, arrivals, slot_rows):
    before = spark.createDataFrame([("hot", 1000, 7), ("k3", 5, -2), ("gone", 9, 9)], "key string, seen bigint, total bigint")
    known = {"hot": (1000, 7), "k3": (5, -2)}
    want = set()
    for key, found in by_key(arrivals).items():
        seen, total = known.get(key, (0, 0))
        for i, value in enumerate(found):
            total += value
            want.add((key, seen + i + 1, total))
    got = panes.number_arrivals(frame(spark, arrivals), ["key"], "seq", F.col("value"), before, slot_rows)
    got = [tuple(r) for r in got.select("key", "position", "running").collect()]
    assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("block", [3, 1000])
def test_running_scores(spark, arrivals, block):
    want = {(k, s) for k, found in by_key(arrivals).items() for s in range(2, len(found) + 1, 2)}
    got = [tuple(r) for r in panes.running_scores(frame(spark, arrivals), ["key"], 2, block=block).collect()]
    assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("max_list", [16, 100_000])
def test_cogroup(spark, max_list):
    """A hot key with many values, a hot key with many copies of one value, one-sided keys."""
    left = [("hot", f"v{i}") for i in range(300)] + [("copies", "same")] * 200 + [("a", "x"), ("a", "x"), ("l", "y")]
    left += [(None, f"n{i}") for i in range(100)] + [("empty", None)] * 60
    right = [("hot", i) for i in range(40)] + [("copies", 1), ("a", 5), ("r", 6), (None, 8)]
    sides = {
        "names": spark.createDataFrame(left, "id string, v string"),
        "numbers": spark.createDataFrame(right, "id string, n bigint"),
    }
    got = sorted(cogroup(sides, "id", max_list=max_list).collect(), key=lambda row: row["part"])
    want = defaultdict(lambda: ([], []))
    for key, value in left:
        want[key][0].extend([] if value is None else [value])
    for key, value in right:
        want[key][1].append(value)
    seen = defaultdict(lambda: ([], []))
    parts = defaultdict(int)
    for row in got:
        seen[row["id"]][0].extend(row["names"])
        seen[row["id"]][1].extend(row["numbers"])
        parts[row["id"]] += 1
        assert list(row["names"]) == sorted(row["names"])
        assert len(row["names"]) <= max_list
    # The parts of a key, one after the other, are its sorted lists.
    assert dict(seen) == {k: (sorted(a), sorted(b)) for k, (a, b) in want.items()}
    assert len({(r["id"], r["part"]) for r in got}) == len(got)
    assert parts["a"] == parts["l"] == parts["r"] == parts["empty"] == 1
    for key in ("hot", "copies", None):
        assert (parts[key] > 1) == (max_list == 16)


def sessions_of(times, gap, inclusive):
    grouped = []
    for t in sorted(times):
        if grouped and (t - grouped[-1][-1] < gap or (inclusive and t - grouped[-1][-1] == gap)):
            grouped[-1].append(t)
        else:
            grouped.append([t])
    return grouped


@pytest.mark.parametrize("group_rows", [100, 1_000_000])
@pytest.mark.parametrize("inclusive", [False, True])
def test_sessions(spark, inclusive, group_rows):
    rng = random.Random(9)
    events = [("hot", rng.randrange(0, 3000)) for _ in range(700)]
    events += [(f"k{rng.randrange(5)}", rng.randrange(0, 3000)) for _ in range(400)]
    df = spark.createDataFrame(events, "key string, t bigint")
    df = df.select("key", F.timestamp_seconds("t").alias("ts"), F.col("t").cast("double").alias("v"))
    got = windows.session_mean(df, ["key"], "ts", 5_000_000, F.col("v"), inclusive=inclusive, group_rows=group_rows)
    rows_ = got.select(
        "key", F.unix_seconds("session_start"), F.unix_seconds("session_end"), F.round("mean", 6), "n"
    ).collect()
    want = set()
    for key in {k for k, _ in events}:
        for group in sessions_of([t for k, t in events if k == key], 5, inclusive):
            want.add((key, group[0], group[-1] + 5, round(sum(group) / len(group), 6), len(group)))
    assert len(rows_) == len(want) and {tuple(r) for r in rows_} == want


def test_missed_periods(spark):
    rng = random.Random(3)
    seen = {f"c{i}": {rng.randrange(1, 13) for _ in range(rng.randrange(0, 12))} for i in range(60)}
    data = [(k, m) for k, months in seen.items() for m in list(months) * 2] + [(k, None) for k in seen]
    got = missed_periods(spark.createDataFrame(data, "key string, month int"), ["key"], "month").collect()
    want = set()
    for key, months in seen.items():
        longest = run = 0
        for month in range(1, 13):
            run = 0 if month in months else run + 1
            longest = max(longest, run)
        want.add((key, 12 - len(months), longest))
    assert {tuple(r) for r in got} == want
    with pytest.raises(ValueError):
        missed_periods(spark.range(1), ["id"], "id", 0)
    days = [("a", d) for d in (1, 62, 63, 130)] + [("b", None), ("c", 200), ("c", 124), ("c", 125)]
    got = missed_periods(spark.createDataFrame(days, "key string, day int"), ["key"], "day", 200).collect()
    assert {tuple(r) for r in got} == {("a", 196, 70), ("b", 200, 200), ("c", 197, 123)}


def test_exclude_beyond_broadcast(spark):
    df = spark.range(1000).withColumnRenamed("id", "key")
    ids = spark.range(0, 1000, 3).withColumnRenamed("id", "key")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in ("-1", "10m"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            assert rows.exclude(df, ids, "key").count() == 666
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
