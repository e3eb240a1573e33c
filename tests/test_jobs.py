"""The command line, from files to files."""

import os

from pyspark.sql import functions as F

from tallyworks import jobs
from tallyworks.plans import attendance, store
from tallyworks.sources import files, layouts, sinks, topics
from tests import fixtures


def text_of(spark, path):
    return sorted(r[0] for r in spark.read.text(path).collect())


def test_numbered_lines(spark, tmp_path):
    """Several files and several blocks of a file keep their order."""
    folder = tmp_path / "in"
    os.makedirs(folder)
    for i in range(3):
        fixtures.write(folder, f"part{i}.txt", ["head"] + [f"line {i} {j:06d}" for j in range(4000 * (i + 1))])
    want = [f"line {i} {j:06d}" for i in range(3) for j in range(4000 * (i + 1))]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        numbered = files.scan_numbered_lines(spark, str(folder), header=True)
        got = [tuple(r) for r in numbered.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(got) == list(enumerate(want))
    plain = files.scan_numbered_lines(spark, str(folder)).collect()
    assert sorted(r["seq"] for r in plain) == list(range(len(want) + 3))


def test_batch_jobs(spark, tmp_path):
    cards = fixtures.write(tmp_path, "cards.csv", fixtures.CARD_LINES)
    loans = fixtures.write(tmp_path, "loans.csv", fixtures.loan_lines())
    staff, places = fixtures.attendance(tmp_path), fixtures.location(tmp_path)
    ids = fixtures.write(tmp_path, "ids.txt", ["E1"])
    numbers = fixtures.write(tmp_path, "numbers.csv", ["n", "10", "20"])
    words = fixtures.write(tmp_path, "words.txt", ["king king king king king king lear"])
    run = lambda *a: jobs.main(list(a), spark)
    out = lambda name: str(tmp_path / "out" / name)

    run("card-defaulters", "--input", cards, "--output", out("card"), "--rejects", out("bad"))
    assert text_of(spark, out("card"))[0] == "C1, 4, Nils Berg"
    assert spark.read.json(out("bad/input")).count() == 2
    run("top-defaulters", "--input", cards, "--output", out("top"), "--k", "1")
    assert text_of(spark, out("top")) == ["C1, 4"]
    run("loan-defaulters", "--input", loans, "--output", out("medical"), "--output2", out("personal"))
    assert text_of(spark, out("medical")) == ["M3, Al Day,3", "M4, Al Day,3"]
    assert text_of(spark, out("personal")) == [f"{p}, Al Day,{n}" for p, n in (("P4", 4), ("PEND", 2), ("PMID", 2), ("PSTART", 2))]
    run("both-defaulters", "--input", cards, "--input2", loans, "--output", out("both"))
    assert spark.read.json(out("both")).count() == 8
    run("attendance-count", "--input", staff, "--output", out("count"))
    assert "('Sam', 10)" in text_of(spark, out("count"))
    run("names-and-places", "--input", staff, "--input2", places, "--output", out("places"))
    assert spark.read.json(out("places")).count() == 13
    run("routed-names", "--input", staff, "--output", out("tags"))
    assert text_of(spark, out("tags") + "/tag=marked") == ["Arvid"]
    run("attendance-without", "--input", staff, "--input2", ids, "--output", out("without"))
    assert len(text_of(spark, out("without"))) == 8
    run("word-count", "--input", words, "--output", out("words"))
    assert text_of(spark, out("words")) == ["('king', 6)"]
    run("mean", "--input", numbers, "--output", out("mean"))
    assert text_of(spark, out("mean")) == ["15.0"]


def test_fan_out(spark, tmp_path):
    found, _ = files.scan_delimited(spark, fixtures.attendance(tmp_path), layouts.ATTENDANCE)
    paths = [str(tmp_path / n) for n in ("hr", "finance")]
    outputs = {p: (lambda df, d=d: attendance.attendance_count(df, d)) for p, d in zip(paths, ("HR", "Finance"))}
    sinks.fan_out(found, outputs)
    assert [spark.read.parquet(p).count() for p in paths] == [2, 1]


def test_stream_jobs(spark, tmp_path):
    sales = fixtures.write(tmp_path, "sales.csv", fixtures.sales_lines())
    topic, out, checkpoint = (str(tmp_path / n) for n in ("topic", "panes", "cp"))
    jobs.main(["replay", "--input", sales, "--output", topic, "--header"], spark)
    jobs.main(["store-panes", "--input", topic, "--output", out, "--checkpoint", checkpoint], spark)
    lines = files.scan_numbered_lines(spark, sales, header=True)
    want = store.profit_panes(files.split_lines(lines, layouts.STORE_SALE)[0], "seq")
    got = spark.read.parquet(out).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_score_and_session_jobs(spark, tmp_path):
    lines = [fixtures.kill_line(at=str(1700000000 + s)) for s in (0, 3, 60, 63)]
    # No player: a reject of both jobs. No weapon rank: a kill for the scores, a reject of the sessions.
    lines += [fixtures.kill_line(who=""), fixtures.kill_line(who="W2", team="T7", rank="high"), fixtures.kill_line(who="W2", team="T7", rank="")]
    kills = fixtures.write(tmp_path, "kills.csv", lines)
    topic = str(tmp_path / "topic")
    jobs.main(["replay", "--input", kills, "--output", topic], spark)
    for job in ("player-team-scores", "weapon-sessions"):
        out, checkpoint = str(tmp_path / job), str(tmp_path / f"{job}-cp")
        bad = str(tmp_path / f"{job}-bad")
        jobs.main([job, "--input", topic, "--output", out, "--checkpoint", checkpoint, "--rejects", bad], spark)
    rejects = {job: spark.read.parquet(str(tmp_path / f"{job}-bad") + "/input") for job in ("player-team-scores", "weapon-sessions")}
    assert {job: df.count() for job, df in rejects.items()} == {"player-team-scores": 2, "weapon-sessions": 3}
    scores = spark.read.parquet(str(tmp_path / "player-team-scores")).select("kind", "id", "score")
    assert sorted(map(tuple, scores.collect())) == [("player", "W1", 2), ("player", "W1", 4), ("player", "W2", 2), ("team", "T7", 2), ("team", "T9", 2), ("team", "T9", 4)]
    # The second session is still open: nothing later has come.
    first = spark.read.parquet(str(tmp_path / "weapon-sessions")).select(F.unix_seconds("session_start"), "n")
    assert [tuple(r) for r in first.collect()] == [(1700000000, 2)]


def test_messages_of_windows(spark, tmp_path):
    lines = [f"{line},{1700000000 + 30 * i}" for i, line in enumerate(fixtures.sales_lines()[1:4])]
    sales = fixtures.write(tmp_path, "sales.csv", lines)
    topic, out, checkpoint = (str(tmp_path / n) for n in ("topic", "out", "cp"))
    jobs.main(["replay", "--input", sales, "--output", topic], spark)
    jobs.main(["store-windows", "--input", topic, "--output", out, "--checkpoint", checkpoint, "--messages"], spark)
    found = [bytes(row["value"]).decode() for row in spark.read.parquet(out).collect()]
    assert found and all(line.startswith("('STR_") and line.endswith(")") for line in found)


def test_passthrough_job(spark, tmp_path):
    numbers = fixtures.write(tmp_path, "counts.csv", ["\ufeffCounts", "1", "2", "3"])
    topic, out, checkpoint = (str(tmp_path / n) for n in ("topic", "out", "cp"))
    jobs.main(["replay-numbers", "--input", numbers, "--output", topic], spark)
    jobs.main(["passthrough", "--input", topic, "--output", out, "--checkpoint", checkpoint, "--every", "1 second", "--seconds", "20"], spark)
    got = spark.read.parquet(out).select("value", F.col("attributes")["even"]).collect()
    assert sorted(map(tuple, got)) == [("Send number: 1", "False"), ("Send number: 2", "True"), ("Send number: 3", "False")]


def test_windows_over_arrival_time(spark, tmp_path):
    """Seven-column sales without a time of their own, in 20 second windows of their arrival."""
    topic, out, checkpoint = (str(tmp_path / n) for n in ("topic", "out", "cp"))
    arrivals = [(0, 100, "STR_1,Mumbai,P,Toys,2,10,15"), (1, 119, "STR_1,Mumbai,P,Toys,1,10,11"), (2, 121, "STR_1,Mumbai,P,Toys,1,1,9")]
    for seq, at, line in [*arrivals, (3, 10_000, "STR_9,Mumbai,P,Toys,1,1,1")]:
        row = spark.createDataFrame([(seq, at, line)], "seq bigint, at bigint, value string")
        topics.publish(row.select("seq", F.timestamp_seconds("at").alias("arrived_at"), "value"), topic)
        jobs.main(["store-windows", "--time", "arrived_at", "--input", topic, "--output", out, "--checkpoint", checkpoint], spark)
    got = spark.read.parquet(out).select("store_id", F.unix_seconds("window_start"), "profit", "n")
    assert sorted(map(tuple, got.collect())) == [("STR_1", 100, 11, 2), ("STR_1", 120, 8, 1)]
    assert "arrived_at" in spark.read.parquet(topic).columns
