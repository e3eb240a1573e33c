"""Command line of the ready-made queries: ``spark-submit tallyworks/jobs.py <job> --input ... --output ...``.

Batch jobs read delimited text and write text lines. Stream jobs read a topic
that ``replay`` filled from a text file, and append to an output folder; they
take in what is there and end, or with ``--every`` run until stopped or, with
``--seconds``, for that long. A job demands only the columns that it uses; rows in
which one of these is bad go to the folder of ``--rejects``.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyworks.functions import text
from tallyworks.operators import keyed, rows
from tallyworks.plans import attendance, bank, game, store
from tallyworks.session import build_session
from tallyworks.sources import files, layouts, sinks, topics
from tallyworks.streaming import control

MESSAGE = T.StructType().add("seq", "long").add("arrived_at", "timestamp").add("value", "string")


def _scan(spark: SparkSession, args, layout: T.StructType, header: bool, option: str = "input") -> DataFrame:
    """The rows of an input; its rejects go to a folder of their own below that of the rejects.

    With rejects or several outputs the input is read once, and its counts are printed.
    """
    if not args.rejects and "output2" not in args:
        return files.scan_delimited(spark, getattr(args, option), layout, header)[0]
    found, rejects, counts = files.scan_delimited_once(spark, getattr(args, option), layout, header)
    if args.rejects:
        sinks.write_table(rejects, f"{args.rejects}/{option}", "json")
    print(json.dumps({option: {name: n for name, n in counts.items() if n}}))
    return found


def _lines(df: DataFrame, line: Column, path: str) -> None:
    sinks.write_lines(df, line, path)


def card_defaulters(spark, args):
    cards = _scan(spark, args, layouts.CARD, True)
    _lines(bank.card_defaulters(cards), bank.card_line(), args.output)


def top_defaulters(spark, args):
    top = bank.top_defaulters(_scan(spark, args, layouts.CARD, True), args.k)
    _lines(top, F.concat_ws(", ", "customer_id", "points"), args.output)


def loan_defaulters(spark, args):
    loans = _scan(spark, args, layouts.LOAN, True)
    _lines(bank.medical_loan_defaulters(loans), bank.loan_line(), args.output)
    personal = bank.personal_loan_defaulters(loans).withColumn("late_payments", bank.missed_payments())
    _lines(personal, bank.loan_line(), args.output2)


def both_defaulters(spark, args):
    loans = _scan(spark, args, layouts.LOAN, True, "input2")
    sinks.write_table(bank.both_defaulters(_scan(spark, args, layouts.CARD, True), loans), args.output, "json")


def attendance_count(spark, args):
    counted = attendance.attendance_count(_scan(spark, args, layouts.needing(layouts.ATTENDANCE, "name", "dept"), False))
    _lines(counted, attendance.pair_line("name", "n"), args.output)


def names_and_places(spark, args):
    places = _scan(spark, args, layouts.needing(layouts.LOCATION, "employee_id", "city"), False, "input2")
    staff = _scan(spark, args, layouts.needing(layouts.ATTENDANCE, "employee_id", "name"), False)
    found = attendance.names_and_places(staff, places)
    sinks.write_table(found, args.output, "json")


def routed_names(spark, args):
    staff = _scan(spark, args, layouts.needing(layouts.ATTENDANCE, "name"), False)
    sinks.write_tagged(attendance.routed_names(staff), args.output, form="text")


def attendance_without(spark, args):
    ids = files.scan_ids(spark, args.input2, "employee_id")
    staff = _scan(spark, args, layouts.needing(layouts.ATTENDANCE, "employee_id", "name", "dept"), False)
    kept = attendance.attendance_without(staff, ids)
    _lines(kept, F.concat_ws(", ", "employee_id", "name", "n"), args.output)


def word_count(spark, args):
    counted = rows.word_counts(files.scan_lines(spark, args.input), "value")
    _lines(counted, attendance.pair_line("word", "n"), args.output)


def mean(spark, args):
    numbers = _scan(spark, args, layouts.NUMBER, True)
    _lines(keyed.global_mean(numbers, F.col("n")), F.col("mean"), args.output)


def replay(spark, args):
    lines = files.scan_numbered_lines(spark, args.input, args.header)
    for _ in topics.replay(lines, "seq", args.output, args.waves, stamp="arrived_at"):
        pass


def replay_numbers(spark, args):
    lines = files.scan_numbered_lines(spark, args.input, True)
    numbers, rejects = files.split_lines(lines, layouts.NUMBER)
    if args.rejects:
        sinks.write_table(rejects, f"{args.rejects}/input", "json")
    topics.publish(numbers.select("seq", *topics.envelope(F.col("n"))), args.output)


def _run(query, args) -> None:
    """Wait for the query and what runs beside it, and print what each took in; an error names the batch."""
    for record in control.run_all([query, *args.beside], args.watch, args.seconds):
        print(json.dumps({"batches": len(record.batches), "rows": record.rows}))


def _topic_rows(spark, args, layout: T.StructType) -> DataFrame:
    """Typed rows of a topic, with ``seq`` and ``arrived_at`` in front.

    The rejects are a stream of their own over the same topic, which takes in what is
    there before the job starts, and with ``--every`` goes on beside it.
    """
    found, rejects = files.split_lines(topics.subscribe(spark, args.input, MESSAGE), layout)
    if args.rejects:
        query = control.start_sink(rejects, f"{args.rejects}/input", f"{args.checkpoint}-rejects", continuous=args.every)
        if args.every is None:
            control.run_out(query)
        else:
            args.beside.append(query)
    return found


def store_panes(spark, args):
    sales = _topic_rows(spark, args, layouts.STORE_SALE)
    line = store.pane_line() if args.messages else None
    query = store.start_profit_panes(sales, "seq", args.output, args.checkpoint, args.n, args.every, line)
    _run(query, args)


def _messages(df: DataFrame, line: Column, args) -> DataFrame:
    """The results as columns, or with ``--messages`` as encoded text lines in ``value``."""
    return df.select(text.encode(line).alias("value")) if args.messages else df


def store_windows(spark, args):
    layout = layouts.STORE_SALE if args.time == "arrived_at" else layouts.TIMED_STORE_SALE
    windows = store.profit_window_stream(_topic_rows(spark, args, layout), args.time, delay=args.delay)
    results = _messages(windows, store.window_line(), args)
    _run(control.start_sink(results, args.output, args.checkpoint, continuous=args.every), args)


def player_team_scores(spark, args):
    kills = _topic_rows(spark, args, layouts.needing(layouts.KILL, "player_id", "team_id", "kill_ts"))
    line = game.score_line() if args.messages else None
    query = game.start_player_team_scores(kills, args.output, args.checkpoint, args.n, args.every, line)
    _run(query, args)


def weapon_sessions(spark, args):
    # The time of the kill is only needed for windows over it.
    timed = ["kill_ts"] if args.time == "kill_ts" else []
    kills = _topic_rows(spark, args, layouts.needing(layouts.KILL, *game.WEAPON_KEYS, *game.POINT_COLUMNS, *timed))
    with control.setting(spark, control.LOCAL_SESSION_MERGE, "true"):
        sessions = game.weapon_session_stream(kills, args.time, args.gap * 1_000_000, delay=args.delay)
        results = _messages(sessions, game.weapon_line(), args)
        query = control.start_sink(results, args.output, args.checkpoint, continuous=args.every)
    _run(query, args)


def passthrough(spark, args):
    schema = T.StructType().add("seq", "long").add("value", "string")
    schema = schema.add("attributes", T.MapType(T.StringType(), T.StringType()))
    messages = topics.subscribe(spark, args.input, schema)
    _run(control.start_sink(messages, args.output, args.checkpoint, continuous=args.every), args)


BATCH = {
    job.__name__.replace("_", "-"): job
    for job in (
        card_defaulters,
        top_defaulters,
        loan_defaulters,
        both_defaulters,
        attendance_count,
        names_and_places,
        routed_names,
        attendance_without,
        word_count,
        mean,
        replay,
        replay_numbers,
    )
}
STREAM = {
    job.__name__.replace("_", "-"): job
    for job in (store_panes, store_windows, player_team_scores, weapon_sessions, passthrough)
}
NEEDS = {
    "loan-defaulters": ["output2"],
    "both-defaulters": ["input2"],
    "names-and-places": ["input2"],
    "attendance-without": ["input2"],
}

# The jobs that read no typed columns, so that no row can be bad.
UNTYPED = ("word-count", "replay", "passthrough")

# The stream jobs with windows, and their column of event time; the other choice is the time of arrival.
EVENT_TIME = {"store-windows": "sold_at", "weapon-sessions": "kill_ts"}
# The stream jobs that fire by count, and after how many rows.
FIRE_AFTER = {"store-panes": store.PANE_ROWS, "player-team-scores": game.FIRE_EVERY}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tallyworks")
    jobs = top.add_subparsers(dest="job", required=True)
    for name in [*BATCH, *STREAM]:
        job = jobs.add_parser(name)
        for option in ["input", "output", *NEEDS.get(name, [])]:
            job.add_argument(f"--{option}", required=True)
        if name in STREAM:
            job.add_argument("--checkpoint", required=True)
            job.add_argument("--every", help="trigger interval, such as '10 seconds'")
            job.add_argument("--seconds", type=float)
        if name not in UNTYPED:
            job.add_argument("--rejects", help="folder for unreadable rows")
        if name in EVENT_TIME:
            job.add_argument("--time", choices=["arrived_at", EVENT_TIME[name]], default=EVENT_TIME[name])
            job.add_argument("--delay", default="0 seconds", help="how long to wait for late rows")
        if name in EVENT_TIME or name in FIRE_AFTER:
            job.add_argument("--messages", action="store_true", help="publish text lines instead of columns")
        if name in FIRE_AFTER:
            job.add_argument("--n", type=int, default=FIRE_AFTER[name], help="rows per firing")
        if name == "weapon-sessions":
            job.add_argument("--gap", type=int, default=5, help="seconds")
        if name == "top-defaulters":
            job.add_argument("--k", type=int, default=20)
        if name == "replay":
            job.add_argument("--header", action="store_true")
            job.add_argument("--waves", type=int, default=1)
    return top


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(arguments)
    session = spark or build_session(None, f"tallyworks {args.job}")
    if args.job in BATCH:
        BATCH[args.job](session, args)
        return
    args.beside = []
    with control.watching(session) as args.watch:
        STREAM[args.job](session, args)


if __name__ == "__main__":
    main()
