"""Runs over long series, exclusion by long lists, arrival times of files, and watched streams."""

import random

import pytest
from pyspark.sql import functions as F

from tallyworks.operators import periods, rows
from tallyworks.session import remove_folder, set_file_times
from tallyworks.sources import files, layouts, topics
from tallyworks.streaming import control
from tests import fixtures


def missed(seen, n):
    """The count and the longest run of the periods 1..n that are not seen, by a plain loop."""
    longest = run = count = 0
    for k in range(1, n + 1):
        run = 0 if k in seen else run + 1
        count += k not in seen
        longest = max(longest, run)
    return count, longest


@pytest.mark.parametrize("n", [1, 61, 62, 63, 124, 500, 100_000])
def test_long_series(spark, n):
    rng = random.Random(n)
    seen = {"few": set(rng.choices(range(1, n + 1), k=3)), "many": set(rng.choices(range(1, n + 1), k=min(n, 5000)))}
    seen |= {"all": set(range(1, n + 1)), "first": {1}, "last": {n}, None: {(n + 1) // 2}, "odd": set()}
    data = [(key, k) for key, found in seen.items() for k in found] * 2
    data += [("odd", None), ("odd", 0), ("odd", n + 1), ("odd", -5), ("few", None)]
    df = spark.createDataFrame(data, "key string, period bigint").repartition(4)
    got = {row["key"]: (row["missed"], row["longest_gap"]) for row in periods.missed_in_series(df, ["key"], "period", n).collect()}
    assert got == {key: missed(found, n) for key, found in seen.items()}
    if n <= 500:
        short = periods.missed_periods(df, ["key"], "period", n).collect()
        assert got == {row["key"]: (row["missed"], row["longest_gap"]) for row in short}
    assert periods.missed_in_series(df.limit(0), ["key"], "period", n).count() == 0


def test_long_exclusion(spark):
    """A million ids: equal to the plain join, and most rows that stay do not move."""
    df = spark.range(0, 3_000_000, 2).select("id", (F.col("id") % 7).alias("v"))
    df = df.union(spark.range(5).select(F.lit(None).cast("bigint"), "id"))
    ids = spark.range(0, 3_000_000, 3).union(spark.range(3).select(F.lit(None).cast("bigint")))
    got = rows.exclude_long(df, ids, "id")
    want = rows.exclude(df, ids, "id")
    totals = [F.count(F.lit(1)), F.count("id"), F.sum("id"), F.sum(F.hash("id", "v"))]
    assert got.agg(*totals).first() == want.agg(*totals).first()
    bits = rows.id_filter(ids, "id").first()["bits"]
    assert len(bits) == rows.FILTER_WORDS
    # Which rows move: the branch of the join alone has an exchange, above the scan of its own rows.
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Join LeftAnti") + plan.count("LeftAnti") >= 1 and "Union" in plan
    passing = sum(word.bit_count() for word in (b & (2**64 - 1) for b in bits)) / (rows.FILTER_WORDS * 64)
    assert passing**rows.FILTER_HASHES < 0.06


def test_long_exclusion_of_texts_and_nothing(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), ("", 5)], "k string, v int")
    none = spark.createDataFrame([], "k string")
    assert rows.exclude_long(df, none, "k", 1).count() == 5
    for words in (1, 8):
        listed = spark.createDataFrame([("b",), ("b",), ("",), (None,)], "k string")
        got = rows.exclude_long(df, listed, "k", words).collect()
        assert sorted(map(tuple, got), key=str) == [("a", 1), (None, 4)]
    assert rows.exclude_long(df.limit(0), none, "k").count() == 0
    with pytest.raises(TypeError):
        rows.exclude_long(df, spark.range(3).select(F.col("id").alias("k")), "k")


def test_arrival_of_files(spark, tmp_path):
    topic = str(tmp_path / "topic")
    df = spark.range(4).select(F.col("id").alias("n"))
    topics.publish(df.coalesce(1), topic)
    set_file_times(spark, topic, 1_000_000)
    stream = topics.subscribe(spark, topic, df.schema, arrival="came")
    control.run_out(control.start_sink(stream, str(tmp_path / "out"), str(tmp_path / "cp")))
    got = spark.read.parquet(str(tmp_path / "out")).select("n", F.unix_seconds("came")).collect()
    assert sorted(map(tuple, got)) == [(k, 1_000_000) for k in range(4)]


def test_a_failing_query_is_reported_with_its_batch(spark, tmp_path):
    df = spark.range(3).select(F.col("id").alias("n"))
    topic = str(tmp_path / "topic")
    for k in range(3):
        topics.publish(df.select((F.col("n") + 10 * k).alias("n")).coalesce(1), topic)
        set_file_times(spark, topic, 1_000_000) if k == 0 else None

    def start(name, limit):
        stream = topics.subscribe(spark, topic, df.schema, files_per_batch=1)
        whole = stream.select(F.when(F.col("n") < limit, F.col("n")).otherwise(F.raise_error(F.lit("too large"))).alias("n"))
        return control.start_sink(whole, str(tmp_path / name), str(tmp_path / f"{name}-cp"))

    with control.watching(spark) as watch:
        fine = control.run_all([start("a", 100), start("b", 100)], watch)
        assert [(record.batches, record.rows, record.reason) for record in fine] == [([0, 1, 2], 9, None)] * 2
        with pytest.raises(control.StreamFailed) as failure:
            control.run_all([start("c", 100), start("d", 10)], watch)
    assert failure.value.batch == 1
    assert not spark.streams.active


@pytest.mark.parametrize("layout, lines", [(layouts.CARD, fixtures.CARD_LINES), (layouts.LOAN, fixtures.loan_lines())])
def test_rows_and_rejects_from_one_pass(spark, tmp_path, layout, lines):
    """The same as two passes give, with counts, and without the input once it was read."""
    path = fixtures.write(tmp_path, "in.csv", [*lines, "", ",,,"])
    texts = lambda df: sorted(str(row) for row in df.collect())
    want = [texts(df) for df in files.scan_delimited(spark, path, layout, header=True)]
    rows_, rejects, counts = files.scan_delimited_once(spark, path, layout, header=True)
    remove_folder(spark, path)
    assert [texts(rows_), texts(rejects)] == want
    assert (counts["rows"], counts["rejects"]) == tuple(map(len, want)) and counts["read"] >= counts["rows"]
    bad = [name for row in rejects.collect() for name in row["bad_columns"]]
    assert {name: counts[f"bad {name}"] for name in set(bad)} == {name: bad.count(name) for name in set(bad)}


def test_one_pass_over_nothing(spark, tmp_path):
    path = fixtures.write(tmp_path, "in.csv", ["head"])
    rows_, rejects, counts = files.scan_delimited_once(spark, path, layouts.CARD, header=True)
    assert rows_.count() == rejects.count() == 0 and set(counts.values()) == {0}
