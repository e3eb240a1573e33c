"""Carried rows as a log, running totals, and slots and ranges of hot keys, on input with a hot key and sparse numbers."""

import random

import pytest
from pyspark.sql import functions as F, types as T

from tallyworks.operators import panes, windows
from tallyworks.operators.prefix import running_total
from tallyworks.operators.skew import heavy_keys
from tallyworks.session import read_note, write_note
from tallyworks.sources import files, topics
from tallyworks.streaming.state import MERGED, KeyedLog

SCHEMA = T.StructType().add("key", "string").add("seen", "long").add("total", "long")


def log(spark, path):
    return KeyedLog(spark, str(path / "log"), SCHEMA, ["key"])


def rows(spark, found):
    return spark.createDataFrame([(k, a, b) for k, (a, b) in found.items()], SCHEMA)


def held(df):
    found = [tuple(row) for row in df.collect()]
    assert len(found) == len({key for key, *_ in found})
    return {key: (a, b) for key, a, b in found}


def test_a_small_batch_writes_its_own_rows(spark, tmp_path):
    table = log(spark, tmp_path)
    table.write(0, spark.range(1_000_000).select(F.col("id").cast("string").alias("key"), F.lit(1).alias("seen"), "id"
    ).withColumnRenamed("id", "total"))
    few = {str(k): (2, -k) for k in range(0, 1000, 100)}
    table.write(1, rows(spark, few))
    assert table.segments(1) == [("0", 1_000_000), ("1", 10)]
    touched = spark.createDataFrame([("100",), ("999999",), ("none",)], "key string")
    assert held(table.rows(1, touched)) == {"100": (2, -100), "999999": (1, 999999)}
    assert held(table.rows(0, touched)) == {"100": (1, 100), "999999": (1, 999999)}
    # Only the folders of the keys that are asked for are read.
    text = table.rows(1, touched)._jdf.queryExecution().toString()
    assert "__bucket" in text and "PartitionFilters" in text


def test_segments_merge_and_batches_run_again(spark, tmp_path):
    rng = random.Random(4)
    table, now = log(spark, tmp_path), {}
    for batch in range(14):
        size = 60 if batch == 0 else 0 if batch == 5 else rng.randrange(1, 12)
        new = {rng.choice([None, *map(str, range(80))]): (batch, rng.randrange(100)) for _ in range(size)}
        if batch in (3, 7, 12):
            # A run that wrote other rows and failed before its results counted.
            table.write(batch, rows(spark, {"0": (-1, -1), "x": (-1, -1)}))
        table.write(batch, rows(spark, new))
        now |= new
        assert held(table.rows(batch)) == now
        assert held(table.rows(batch, spark.createDataFrame([(None,), ("3",)], "key string"))) == {k: v for k, v in now.items() if k in (None, "3")}
    segments = table.segments(13)
    assert len(segments) < 2 * MERGED and any("merged" in name for name, _ in segments)
    # Nothing is left but what the last two lists name.
    kept = {name for batch in (12, 13) for name, _ in table.segments(batch)}
    found = {path.name for path in (tmp_path / "log" / "segments").iterdir() if not path.name.startswith(".")}
    assert kept == found and read_note(spark, f"{table.path}/lists/11") is None


def test_notes(spark, tmp_path):
    place = str(tmp_path / "deep" / "note")
    assert read_note(spark, place) is None
    write_note(spark, place, "one ü")
    write_note(spark, place, "two")
    assert read_note(spark, place) == "two"


def test_running_total(spark):
    rng = random.Random(8)
    data = [(rng.choice([None, rng.randrange(10**12)]) if i % 50 == 0 else i * 7919**2 - 10**9, rng.randrange(-5, 9)) for i in range(2000)]
    df = spark.createDataFrame(data, "seq bigint, n int").repartition(6)
    found, total = running_total(df, ["seq"], F.col("n"), "ahead")
    assert total == sum(n for _, n in data)
    ahead = 0
    for row in sorted(found.collect(), key=lambda r: (r.seq is not None, r.seq or 0, r.ahead) if r.seq is not None else (False, 0, 0)):
        if row.seq is not None:
            assert row.ahead == sum(n for s, n in data if s is None or s < row.seq) or sum(s == row.seq for s, _ in data) > 1
    empty, nothing = running_total(df.limit(0), ["seq"], F.lit(1), "ahead")
    assert empty.count() == 0 and nothing == 0


def test_replay_cuts_by_rank(spark, tmp_path):
    """Numbers with large gaps, and rows without one, which come first."""
    data = [(i**5, i) for i in range(97)] + [(None, -1)] * 3
    df = spark.createDataFrame(data, "seq bigint, n int")
    path, sizes, before = str(tmp_path / "topic"), [], 0
    for _ in topics.replay(df, "seq", path, 4):
        count = spark.read.parquet(path).count()
        sizes.append(count - before)
        before = count
        seen = {row.seq for row in spark.read.parquet(path).collect()}
        assert None in seen and seen - {None} == {i**5 for i in range(count - 3)}
    assert sizes == [25, 25, 25, 25]


def test_numbered_lines_have_no_whole_window(spark, tmp_path):
    for k in range(5):
        (tmp_path / f"part{k}.txt").write_text("".join(f"{k}-{i}\n" for i in range(k * 3 + 1)))
    lines = files.scan_numbered_lines(spark, str(tmp_path))
    assert "SinglePartition" not in lines._jdf.queryExecution().toString()
    assert [row.value for row in lines.orderBy("seq").collect()] == [f"{k}-{i}" for k in range(5) for i in range(k * 3 + 1)]
    assert [row.seq for row in lines.orderBy("seq").collect()] == list(range(35))


def test_slots_of_sparse_numbers(spark):
    """A third of the rows in one key, whose numbers are far apart: slots hold like numbers of rows."""
    rng = random.Random(6)
    data = [("hot" if i % 3 == 0 else f"k{i % 50}", rng.randrange(10**15) * 3000 + i, 1) for i in range(3000)]
    df = spark.createDataFrame(data, "key string, seq bigint, amount bigint").repartition(4).withColumn("pane_key", F.struct("key"))
    heavy = heavy_keys(df, ["key"], 100)
    slotted, offsets = panes._slotted(df, ["key"], "seq", heavy, None, 100)
    sizes = {tuple(row)[0]: row["count"] for row in slotted.where("key = 'hot'").groupBy("slot").count().collect()}
    assert len(sizes) >= 6 and max(sizes.values()) <= 300
    assert offsets.count() == len(sizes)


@pytest.mark.parametrize("range_slots", [1, 2, 5, 4096])
@pytest.mark.parametrize("inclusive", [False, True])
def test_sessions_linked_over_ranges(spark, range_slots, inclusive):
    """Sessions that go over many ranges, before 1970 too, equal those of the built-in window."""
    rng = random.Random(9)
    data, at = [], -3000
    for _ in range(900):
        at += rng.choice([0, 1, 4, 5, 5, 6, 30])
        data.append((rng.choice(["hot", "hot", "a", None]), at, float(rng.randrange(9))))
    df = spark.createDataFrame(data, "key string, t bigint, v double").withColumn("ts", F.timestamp_seconds("t")).repartition(5)
    args = (["key"], "ts", 5_000_000, F.col("v"), "mean", None, inclusive)
    got = windows._linked_sessions(df, *args, range_slots=range_slots)
    want = windows.native_sessions(df, *args)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_no_group_holds_all_slots_of_a_hot_key(spark):
    """A key with 20,000 slots: the first round splits them by range, the second has two rows for each range."""
    df = spark.range(20_000).select(F.lit("hot").alias("key"), F.timestamp_seconds(F.col("id") * 7).alias("ts"), F.lit(1.0).alias("v"))
    gap = 5_000_000
    slots = df.groupBy("key", F.window("ts", "5 seconds").alias("slot")).agg(
        F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.sum("v").alias("total"), F.count("v").alias("counted"), F.count("v").alias("n")
    )
    ranged = slots.withColumn("time_range", F.floor(F.unix_micros("slot.start") / F.lit(gap * 64)))
    inside = windows._linked(ranged, ["key", "time_range"], gap, False)
    assert ranged.groupBy("key", "time_range").count().agg(F.max("count")).first()[0] <= 64
    assert inside.count() == 20_000
    found = windows._linked_sessions(df, ["key"], "ts", gap, F.col("v"), "mean", None, False, range_slots=64)
    assert found.count() == 20_000
