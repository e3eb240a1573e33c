"""Streams against their batch twins, over restarts, with late rows and with hot keys."""

import random
import time

import pytest
from pyspark.sql import functions as F, types as T

from tallyworks.operators import panes
from tallyworks.plans import game, store
from tallyworks.sources import files, layouts, topics
from tallyworks.streaming import control
from tallyworks.streaming import panes as stream_panes
from tallyworks.streaming.windows import session_stream, tumbling_stream
from tests import fixtures

PANES = T.StructType().add("key", "string").add("pane", "long").add("n", "long").add("total", "long")


@pytest.fixture
def base(tmp_path):
    return str(tmp_path / "run")


def tuples(df):
    return sorted(df.collect(), key=str)


def arrivals(spark, count=900, seed=1):
    rng = random.Random(seed)
    data = []
    for seq in range(count):
        key = "hot" if seq % 3 == 0 else rng.choice(["a", "b", "c", None])
        data.append((seq, key, rng.randrange(-20, 50)))
    return spark.createDataFrame(data, "seq bigint, key string, value bigint").repartition(5)


def replayed(spark, df, base, start, waves=4):
    topics.open_topic(spark, f"{base}/topic", df.schema)
    stream = topics.subscribe(spark, f"{base}/topic", df.schema)
    for _ in topics.replay(df, "seq", f"{base}/topic", waves):
        control.run_out(start(stream))
    return stream


@pytest.mark.parametrize("slot_rows", [50, 1_000_000])
def test_discarding_over_restarts(spark, base, slot_rows):
    df = arrivals(spark)
    replayed(
        spark,
        df,
        base,
        lambda s: stream_panes.start_discarding(
            s, ["key"], "seq", F.col("value"), 7, f"{base}/out", f"{base}/cp", slot_rows
        ),
    )
    got = stream_panes.read_results(spark, f"{base}/out", PANES)
    assert tuples(got) == tuples(panes.discarding_panes(df, ["key"], "seq", F.col("value"), 7))


@pytest.mark.parametrize("slot_rows", [50, 1_000_000])
def test_accumulating_over_restarts(spark, base, slot_rows):
    df = arrivals(spark)
    replayed(
        spark,
        df,
        base,
        lambda s: stream_panes.start_accumulating(
            s, ["key"], "seq", F.col("value"), 3, f"{base}/out", f"{base}/cp", slot_rows
        ),
    )
    got = stream_panes.read_results(spark, f"{base}/out", PANES)
    assert tuples(got) == tuples(panes.accumulating_panes(df, ["key"], "seq", F.col("value"), 3))


def test_failed_batch_runs_again(spark, base, monkeypatch):
    """A batch that wrote its results and then failed is run again and leaves every pane once."""
    df = arrivals(spark)
    args = (["key"], "seq", F.col("value"), 7, f"{base}/out", f"{base}/cp")
    writer = stream_panes.batch_writer

    def failing_writer(*writer_args):
        on_batch = writer(*writer_args)

        def broken(batch, batch_id):
            on_batch(batch, batch_id)
            raise RuntimeError("stopped on purpose")

        return broken

    def start(stream):
        if start.waves == 1:
            with monkeypatch.context() as patched:
                patched.setattr(stream_panes, "batch_writer", failing_writer)
                query = stream_panes.start_discarding(stream, *args)
            with pytest.raises(Exception, match="stopped on purpose"):
                control.run_out(query)
        start.waves += 1
        return stream_panes.start_discarding(stream, *args)

    start.waves = 0
    replayed(spark, df, base, start, waves=3)
    got = stream_panes.read_results(spark, f"{base}/out", PANES)
    assert tuples(got) == tuples(panes.discarding_panes(df, ["key"], "seq", F.col("value"), 7))


def kill_frame(spark, lines):
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "seq bigint, value string")
    return df


def test_scores_stream(spark, base):
    rng = random.Random(2)
    lines = [fixtures.kill_line(who=rng.choice("ABC"), team=rng.choice(["T1", "T2"])) for _ in range(60)]
    df = kill_frame(spark, lines)

    def start(stream):
        found, _ = files.split_lines(stream, layouts.KILL)
        return game.start_player_team_scores(found, f"{base}/out", f"{base}/cp")

    replayed(spark, df, base, start)
    schema = T.StructType().add("kind", "string").add("id", "string").add("score", "long")
    got = stream_panes.read_results(spark, f"{base}/out", schema)
    assert tuples(got) == tuples(game.player_team_scores(files.split_lines(df, layouts.KILL)[0]))


def test_store_stream(spark, base):
    lines = fixtures.sales_lines()[1:]
    df = kill_frame(spark, lines)
    names = layouts.STORE_SALE.fieldNames()

    def typed(lines_df):
        parts = F.split("value", ",", -1)
        raw = lines_df.select("seq", *[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)])
        return raw.withColumns({n: F.col(n).try_cast("bigint") for n in ("pieces_sold", "buy_rate", "sell_price")})

    replayed(
        spark, df, base, lambda s: store.start_profit_panes(typed(s), "seq", f"{base}/out", f"{base}/cp"), waves=3
    )
    schema = T.StructType().add("store_id", "string").add("pane", "long").add("n", "long").add("total", "long")
    got = stream_panes.read_results(spark, f"{base}/out", schema)
    assert tuples(got) == tuples(store.profit_panes(typed(df), "seq"))


EVENT = "seq bigint, key string, ts timestamp, value double"


def waves_of_events(spark, base, waves, start):
    """Publish each list of (key, second) as one wave, then a row far in the future."""
    schema = spark.createDataFrame([], EVENT).schema
    topics.open_topic(spark, f"{base}/topic", schema)
    stream = topics.subscribe(spark, f"{base}/topic", schema)
    for events in [*waves, [("end", 10_000_000)]]:
        df = spark.createDataFrame([(i, k, t, float(t)) for i, (k, t) in enumerate(events)], "seq bigint, key string, t bigint, value double")
        topics.publish(df.select("seq", "key", F.timestamp_seconds("t").alias("ts"), "value"), f"{base}/topic")
        control.run_out(start(stream))


def seconds(name):
    return F.unix_seconds(name).alias(name)


def test_session_stream_gap_and_late_rows(spark, base):
    def start(stream):
        with control.setting(spark, control.LOCAL_SESSION_MERGE, "true"):
            sessions = session_stream(stream, ["key"], "ts", 5_000_000, F.col("value"))
            return control.start_sink(sessions, f"{base}/out", f"{base}/cp")

    # Gaps of 4, 5 and 6 seconds; the last wave has a row long behind the watermark, which is dropped.
    waves = [[("a", 0), ("a", 4), ("a", 9), ("b", 2)], [("a", 15), ("b", 40)], [("a", 3), ("b", 44)]]
    waves_of_events(spark, base, waves, start)
    got = spark.read.parquet(f"{base}/out").select("key", seconds("session_start"), seconds("session_end"), "mean", "n")
    assert sorted(tuple(r) for r in got.collect()) == [
        ("a", 0, 9, 2.0, 2),
        ("a", 9, 14, 9.0, 1),
        ("a", 15, 20, 15.0, 1),
        ("b", 2, 7, 2.0, 1),
        ("b", 40, 49, 42.0, 2),
    ]
    assert spark.conf.get(control.LOCAL_SESSION_MERGE) == "false"


@pytest.mark.parametrize("delay, late_is_in", [("0 seconds", False), ("1 minute", True)])
def test_tumbling_stream_lateness(spark, base, delay, late_is_in):
    def start(stream):
        sums = tumbling_stream(stream, ["key"], "ts", "20 seconds", F.col("value"), scale=2, delay=delay)
        return control.start_sink(sums, f"{base}/out", f"{base}/cp")

    waves_of_events(spark, base, [[("a", 1), ("a", 19), ("a", 20)], [("a", 45)], [("a", 5)]], start)
    got = spark.read.parquet(f"{base}/out").select("key", seconds("window_start"), F.col("total").cast("double"), "n")
    first = ("a", 0, 25.0, 3) if late_is_in else ("a", 0, 20.0, 2)
    assert sorted(tuple(r) for r in got.collect()) == [first, ("a", 20, 20.0, 1), ("a", 40, 45.0, 1)]


def test_listen_stops_a_running_query(spark, base):
    df = spark.range(10).select(F.col("id").alias("n"))
    topics.publish(df, f"{base}/topic")
    stream = topics.subscribe(spark, f"{base}/topic", df.schema, files_per_batch=1)
    query = control.start_sink(stream.select(*topics.envelope(F.col("n"))), f"{base}/out", f"{base}/cp", continuous="0 seconds")
    query.processAllAvailable()
    started = time.monotonic()
    assert control.listen(query, 1) is False
    assert time.monotonic() - started < 30
    assert not query.isActive
    assert spark.read.parquet(f"{base}/out").count() == 10
