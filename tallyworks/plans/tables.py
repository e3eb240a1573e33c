"""The operators as queries over the test tables.

Every query takes (spark, folder) and reads whole tables. The domain files of
the card, loan, attendance, store and game queries are not among the tables;
each query names the columns that stand in for theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tallyworks.functions import scoring, text, values
from tallyworks.functions.values import units
from tallyworks.operators import keyed, panes, rows, windows
from tallyworks.operators.cogroup import cogroup
from tallyworks.operators.own import Mean, Variance, aggregate_own
from tallyworks.operators.periods import missed_in_series, missed_periods
from tallyworks.plans import attendance, bank, game, store
from tallyworks.session import set_file_times, work_folder
from tallyworks.sources import files, layouts, sinks, topics
from tallyworks.streaming import control
from tallyworks.streaming import panes as stream_panes
from tallyworks.streaming import windows as stream_windows

GAP_US = 6 * 3600 * 1_000_000
WAVES = 2
MESSAGE = T.StructType().add("value", "binary")
DAYS = 31
MINUTES = DAYS * 24 * 60
# The first of the fixed times at which files are landed, and the seconds between two.
LANDED_AT, LANDED_EVERY, LANDINGS = 1_704_067_200, 15, 4


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- filters, projections, keyed aggregates -------------------------------------------------


def attendance_count(spark: SparkSession, folder: str) -> DataFrame:
    """Urgent orders per customer: the customer is the employee, the priority the department."""
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("name"), F.col("o_orderpriority").alias("dept")
    )
    return attendance.attendance_count(orders, "1-URGENT").withColumnRenamed("name", "o_custkey")


def sum_per_key(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = table(spark, folder, "lineitem")
    sums = keyed.keyed_sum(lineitem, ["l_suppkey"], F.col("l_extendedprice"), scale=2)
    return sums.withColumn("total", F.col("total").cast("double"))


def membership_profit(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = table(spark, folder, "lineitem")
    chosen = lineitem.where(F.col("l_returnflag").isin("A", "R") & F.col("l_extendedprice").isNotNull())
    profit = F.col("l_extendedprice") * (1 - F.col("l_discount")) - F.col("l_quantity")
    sums = keyed.keyed_sum(chosen, ["l_suppkey"], profit, "profit", scale=4)
    return sums.withColumn("profit", F.col("profit").cast("double"))


def having_threshold(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    return keyed.at_least(keyed.keyed_count(orders, ["o_custkey", "o_orderpriority"]), "n", 3)


def length_prefix_filter(spark: SparkSession, folder: str) -> DataFrame:
    name = F.col("p_name")
    part = table(spark, folder, "part").where(text.length_between(name, 8, 10) & name.startswith("s"))
    return part.select("p_partkey", "p_name")


def text_keys(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    line = F.format_string("%d, %s", "c_custkey", text.full_name(F.col("c_name"), F.col("c_mktsegment")))
    coded = customer.select(text.encode(line).alias("payload"))
    decoded = coded.select(text.decode(F.col("payload")).alias("line"))
    key, name = text.fields(F.col("line"), ["key", "name"])
    return decoded.select("line", values.to_long(key).alias("key"), text.strip(name).alias("name"))


def dirty_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates as padded text and junk-marked Unix seconds, some of them unreadable, parsed back."""
    day = F.to_date("o_orderdate")
    broken = F.col("o_orderkey") % 11 == 0
    shown = F.when(broken, "n/a").otherwise(F.date_format(day, "dd-MM-yyyy"))
    seconds = F.when(broken, "12x").otherwise((F.unix_date(day).cast("bigint") * 86400).cast("string"))
    dirty = table(spark, folder, "orders").select(
        "o_orderkey",
        F.concat(F.lit(" "), shown, F.lit("\r\n")).alias("day_text"),
        F.concat(F.lit("'"), seconds, F.lit("\\r\\n'")).alias("seconds_text"),
    )
    parsed = values.to_day(F.col("day_text"))
    clean = text.scrub_timestamp(F.col("seconds_text"))
    due = F.lit("1998-06-15").cast("date")
    return dirty.select(
        "o_orderkey",
        parsed.alias("day"),
        F.month(parsed).cast("bigint").alias("month"),
        values.late_flag(due, parsed).cast("bigint").alias("late"),
        F.when(text.is_digits(clean), values.to_long(clean)).alias("seconds"),
    )


def global_mean(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.global_mean(table(spark, folder, "lineitem"), F.col("l_quantity"), scale=2)


def mean_per_key(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return keyed.keyed_mean(events, ["user_id", "event_type"], F.col("value"), scale=2)


def own_mean(spark: SparkSession, folder: str) -> DataFrame:
    """The mean of cents per user by an aggregate of one's own."""
    return aggregate_own(table(spark, folder, "events"), ["user_id"], units(F.col("value")), Mean(), "mean")


def own_variance(spark: SparkSession, folder: str) -> DataFrame:
    """The variance of cents per type of event; five keys, so that each is hot."""
    return aggregate_own(table(spark, folder, "events"), ["event_type"], units(F.col("value")), Variance(), "variance")


def own_global_mean(spark: SparkSession, folder: str) -> DataFrame:
    return aggregate_own(table(spark, folder, "events"), [], units(F.col("value")), Mean(), "mean")


def pair_combine(spark: SparkSession, folder: str) -> DataFrame:
    return keyed.combined_pair(table(spark, folder, "orders"), ["o_custkey"], "o_orderpriority")


def distinct_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("user_id", "event_type").distinct()


# --- co-group, exclusion, union, routing, order, words ---------------------------------------


def exclude_long_list(spark: SparkSession, folder: str) -> DataFrame:
    """Orders without a returned item; the list has a third of all orders and grows with them."""
    returned = table(spark, folder, "lineitem").where(F.col("l_returnflag") == "R")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return rows.exclude_long(orders, returned.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


def _list_texts(grouped: DataFrame, *names: str) -> DataFrame:
    others = [c for c in grouped.columns if c not in names]
    return grouped.select(*others, *[text.joined(F.col(n), ",").alias(n) for n in names])


def cogroup_full_outer(spark: SparkSession, folder: str) -> DataFrame:
    """Customer names and the events of the user with the same number; most customers have none."""
    names = table(spark, folder, "customer").select(F.col("c_custkey").alias("custkey"), "c_name")
    events = table(spark, folder, "events").select(F.col("user_id").alias("custkey"), "event_id")
    return _list_texts(cogroup({"names": names, "events": events}, "custkey"), "names", "events")


def names_and_places(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct priorities of the orders of a customer, and the segment: the employee, names and cities."""
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("employee_id"), F.col("o_orderpriority").alias("name"))
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("employee_id"), F.col("c_mktsegment").alias("city"))
    found = _list_texts(attendance.names_and_places(orders, customers), "cities", "names")
    return found.select(F.col("employee_id").alias("custkey"), "cities", "names")


def cogroup_named(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    sides = {
        name: events.where(F.col("event_type") == kind).select("user_id", "event_id")
        for name, kind in (("purchases", "purchase"), ("errors", "error"))
    }
    return _list_texts(cogroup(sides, "user_id"), "purchases", "errors")


def exclude_anti(spark: SparkSession, folder: str) -> DataFrame:
    """Finished orders per customer without the customers of nations 0-4, for short lowest priorities."""
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("employee_id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_orderstatus").alias("dept"),
    )
    listed = table(spark, folder, "customer").where(F.col("c_nationkey").between(0, 4))
    ids = listed.select(F.col("c_custkey").alias("employee_id"))
    kept = attendance.attendance_without(orders, ids, "F", 3, 10)
    return kept.select(F.col("employee_id").alias("custkey"), F.col("name").alias("priority"), "n")


def union_all(spark: SparkSession, folder: str) -> DataFrame:
    sides = []
    for kind, name, letter in (("customer", "customer", "c"), ("supplier", "supplier", "s")):
        side = table(spark, folder, name)
        balance = F.col(f"{letter}_acctbal").alias("balance")
        sides.append(side.select(F.lit(kind).alias("kind"), F.col(f"{letter}_name").alias("name"), balance))
    return rows.union_all(sides)


def tag_routing(spark: SparkSession, folder: str) -> DataFrame:
    names = table(spark, folder, "part").select(F.col("p_name").alias("name"))
    return attendance.routed_names(names, 9, "s")


def word_count(spark: SparkSession, folder: str) -> DataFrame:
    return rows.word_counts(table(spark, folder, "documents"), "text")


# --- defaulters ------------------------------------------------------------------------------


def _cards(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as card rows of a supplier: a limit of 50, the discount stands for what is not cleared."""
    quantity = F.col("l_quantity")
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("customer_id"),
        F.lit(50.0).alias("max_limit"),
        quantity.alias("spent"),
        F.round(quantity * (1 - 5 * F.col("l_discount")), 4).alias("payment_cleared"),
    )


def card_points(spark: SparkSession, folder: str) -> DataFrame:
    return bank.card_totals(_cards(spark, folder), ["customer_id"])


def card_defaulters(spark: SparkSession, folder: str) -> DataFrame:
    """The text line of every supplier, those without points included."""
    cards = _cards(spark, folder).withColumns({"first_name": F.lit("Supplier"), "last_name": F.col("customer_id").cast("string")})
    return bank.card_defaulters(cards).select("customer_id", bank.card_line().alias("line"))


def text_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """All orders written as text lines, the numbers of the customers as a list of ids, and both scanned again."""
    base = work_folder(spark, "text")
    orders = table(spark, folder, "orders")
    line = F.concat_ws(
        ",", "o_orderkey", F.format_string("%.2f", "o_totalprice"), F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    )
    sinks.write_lines(orders, line, f"{base}/orders")
    sinks.write_lines(table(spark, folder, "customer").where("c_nationkey < 5"), F.col("c_custkey"), f"{base}/ids")
    layout = layouts.layout(("o_orderkey", layouts.LONG, True), ("price", layouts.DOUBLE, True), ("at", layouts.TIME, True))
    found, _ = files.scan_delimited(spark, f"{base}/orders", layout)
    ids = files.scan_ids(spark, f"{base}/ids").select(F.col("id").cast("bigint").alias("o_orderkey"))
    kept = rows.exclude(found, ids, "o_orderkey")
    return kept.select("o_orderkey", "price", F.unix_seconds("at").alias("seconds"))


def sorted_points(spark: SparkSession, folder: str) -> DataFrame:
    return rows.by_points(card_points(spark, folder), "points", "customer_id")


def top_defaulters(spark: SparkSession, folder: str) -> DataFrame:
    return bank.top_defaulters(_cards(spark, folder), 20)


def late_defaulters(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with late line items: the order date is due, the ship date paid.

    An order with very many lines makes one join partition large, which the
    adaptive skew join splits; the sum then combines before its shuffle.
    """
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("customer_id"), "o_orderdate")
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    payments = lines.join(orders, "o_orderkey")
    return bank.late_totals(payments, ["customer_id"], "o_orderdate", "l_shipdate")


def _purchase_days(spark: SparkSession, folder: str) -> DataFrame:
    purchases = table(spark, folder, "events").where(F.col("event_type") == "purchase")
    return purchases.select(F.col("user_id").alias("customer_id"), F.dayofmonth("ts").alias("day"))


def missed_period_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Days 1..31 without a purchase, per user."""
    return missed_periods(_purchase_days(spark, folder), ["customer_id"], "day", DAYS)


def missed_minutes(spark: SparkSession, folder: str) -> DataFrame:
    """Minutes of a month without an event, per user."""
    minute = F.expr("timestampdiff(MINUTE, TIMESTAMP_NTZ '2024-01-01 00:00:00', ts) + 1")
    events = table(spark, folder, "events").select(F.col("user_id").alias("customer_id"), minute.alias("minute"))
    return missed_in_series(events, ["customer_id"], "minute", MINUTES)


def missed_period_defaulters(spark: SparkSession, folder: str) -> DataFrame:
    return bank.missed_totals(_purchase_days(spark, folder), ["customer_id"], "day", DAYS, in_all=20, in_a_row=8)


def combined_defaulters(spark: SparkSession, folder: str) -> DataFrame:
    """Loan findings of both kinds per customer, next to card findings."""
    late = late_defaulters(spark, folder).select(
        "customer_id", F.format_string("%d late", "late_payments").alias("finding")
    )
    gone = missed_period_defaulters(spark, folder).select(
        "customer_id", F.format_string("%d missed", bank.missed_payments(20)).alias("finding")
    )
    card = card_points(spark, folder).select(
        "customer_id", F.format_string("%d fraud_points", "points").alias("finding")
    )
    sides = {"card_defaulter": card, "loan_defaulter": rows.union_all([gone, late])}
    both = cogroup(sides, "customer_id", short=("card_defaulter", "loan_defaulter"))
    return _list_texts(both, "card_defaulter", "loan_defaulter")


# --- game scores, windows, panes -------------------------------------------------------------


def _kills(spark: SparkSession, folder: str) -> DataFrame:
    """Events as kills: ``props.k`` is the engagement time; ids give ranks and places."""
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    user, event = F.col("user_id"), F.col("event_id")
    return table(spark, folder, "events").select(
        event,
        "ts",
        F.col("event_type").alias("game_id"),
        user.alias("player_id"),
        (user % 10).alias("team_id"),
        (k % 3).alias("used_weapon"),
        k.alias("engagement_seconds"),
        (user % 10 + 1).alias("rank_of_weapon"),
        (event % 10 + 1).alias("prey_weapon_rank"),
        (user % 7).alias("killer_location"),
        (event % 5).alias("prey_location"),
    )


def weapon_points(spark: SparkSession, folder: str) -> DataFrame:
    scored = game.with_points(_kills(spark, folder))
    return keyed.keyed_mean(scored, game.WEAPON_KEYS, F.col("points"), "mean_points", scale=0)


def weapon_sessions(spark: SparkSession, folder: str) -> DataFrame:
    return game.weapon_sessions(_kills(spark, folder), "ts", 8 * GAP_US)


def tumbling_sum(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    sums = windows.tumbling_sum(events, ["event_type"], "ts", "1 hour", F.col("value"), scale=2)
    return sums.withColumn("total", F.col("total").cast("double"))


def session_mean(spark: SparkSession, folder: str) -> DataFrame:
    return windows.session_mean(table(spark, folder, "events"), ["user_id"], "ts", GAP_US, F.col("value"), scale=2)


def _double_total(df: DataFrame) -> DataFrame:
    return df.withColumn("total", values.from_units(F.col("total")))


def pane_discarding(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", "event_id", "value")
    return _double_total(panes.discarding_panes(events, ["user_id"], "event_id", units(F.col("value")), 5))


def pane_accumulating(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", "event_id", "value")
    return _double_total(panes.accumulating_panes(events, ["user_id"], "event_id", units(F.col("value")), 2))


def _sales(spark: SparkSession, folder: str) -> DataFrame:
    """Events as sales: users are stores, clicks and views come from the two cities, values are prices in cents."""
    events = table(spark, folder, "events")
    city = F.when(F.col("event_type") == "click", store.CITIES[0]).when(F.col("event_type") == "view", store.CITIES[1])
    return events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        F.col("user_id").cast("string").alias("store_id"),
        F.coalesce(city, F.lit("elsewhere")).alias("store_location"),
        units(F.col("value")).alias("sell_price"),
        (F.col("event_id") % 100).alias("buy_rate"),
        (F.col("event_id") % 7 + 1).alias("pieces_sold"),
    )


def store_pane_profit(spark: SparkSession, folder: str) -> DataFrame:
    """Profit of every five sales of a store in the cities."""
    return store.profit_panes(_sales(spark, folder), "event_id")


def store_window_profit(spark: SparkSession, folder: str) -> DataFrame:
    """Profit per store and 20 seconds."""
    return _unzoned(store.profit_windows(_sales(spark, folder), "ts"), "window_start", "window_end")


def player_team_score(spark: SparkSession, folder: str) -> DataFrame:
    return game.player_team_scores(_kills(spark, folder))


# --- streams ---------------------------------------------------------------------------------


def stream_landed_profit(spark: SparkSession, folder: str) -> DataFrame:
    """Profit per store and 20 seconds of arrival, which is the time of the files that another program lands."""
    base = work_folder(spark, "landed")
    sales = _sales(spark, folder).drop("ts")

    def land(rows: DataFrame, k: int, at: int) -> None:
        rows.write.parquet(f"{base}/topic/{k}")
        set_file_times(spark, f"{base}/topic/{k}", at)

    def take_in() -> None:
        stream = topics.subscribe(spark, f"{base}/topic/*", sales.schema, arrival="landed_at")
        windows = store.profit_window_stream(stream, "landed_at")
        control.run_out(control.start_sink(windows, f"{base}/out", f"{base}/checkpoint"))

    for k in range(LANDINGS):
        land(sales.where(F.col("event_id") % LANDINGS == k), k, LANDED_AT + k * LANDED_EVERY)
        if k % 2:
            with control.setting(spark, control.BATCH_WITHOUT_INPUT, "false"):
                take_in()
    # A file of the next day closes all windows; its own stays open.
    ahead = [F.lit({"store_location": store.CITIES[0]}.get(f.name)).cast(f.dataType).alias(f.name) for f in sales.schema]
    land(spark.range(1).select(*ahead), LANDINGS, LANDED_AT + 86400)
    take_in()
    return _unzoned(spark.read.parquet(f"{base}/out"), "window_start", "window_end")


def _zoned_events(spark: SparkSession, folder: str) -> DataFrame:
    """Watermarks need timestamps with a zone."""
    events = table(spark, folder, "events")
    return events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")


def _replayed(spark: SparkSession, events: DataFrame, base: str, start, flush: bool = False) -> None:
    """Publish the events in waves and run the query that ``start`` gives after each, on one checkpoint.

    With ``flush`` a last row far in the future moves the watermark past all
    windows; its own window stays open, so it is never in the results. Only that
    last run needs a batch without input, in which the windows close.
    """
    topic = f"{base}/topic"
    topics.open_topic(spark, topic, events.schema)
    stream = topics.subscribe(spark, topic, events.schema)
    for _ in topics.replay(events, "event_id", topic, WAVES):
        with control.setting(spark, control.BATCH_WITHOUT_INPUT, "false"):
            query = start(stream)
        control.run_out(query)
    if flush:
        ahead = {"event_id": F.lit(-1), "ts": F.lit("2999-01-01").cast("timestamp"), "user_id": F.lit(-1)}
        # The row has to pass the filter of the store queries.
        ahead["store_location"] = F.lit(store.CITIES[0])
        row = spark.range(1).select(*[ahead.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in events.schema])
        topics.publish(row, topic)
        control.run_out(start(stream))


def _unzoned(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def _windowed(spark: SparkSession, events: DataFrame, label: str, transform) -> DataFrame:
    base = work_folder(spark, label)

    def start(stream: DataFrame):
        with control.setting(spark, control.LOCAL_SESSION_MERGE, "true"):
            return control.start_sink(transform(stream), f"{base}/out", f"{base}/checkpoint")

    _replayed(spark, events, base, start, flush=True)
    return spark.read.parquet(f"{base}/out")


def stream_tumbling(spark: SparkSession, folder: str) -> DataFrame:
    sums = _windowed(
        spark,
        _zoned_events(spark, folder),
        "tumbling",
        lambda s: stream_windows.tumbling_stream(s, ["event_type"], "ts", "1 hour", F.col("value"), scale=2),
    )
    return _unzoned(sums, "window_start", "window_end").withColumn("total", F.col("total").cast("double"))


def stream_session(spark: SparkSession, folder: str) -> DataFrame:
    means = _windowed(
        spark,
        _zoned_events(spark, folder),
        "session",
        lambda s: stream_windows.session_stream(s, ["user_id"], "ts", GAP_US, F.col("value"), scale=2),
    )
    return _unzoned(means, "session_start", "session_end")


def stream_weapon_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The weapon sessions of a stream, published as encoded text lines and decoded again."""
    columns = [*game.WEAPON_KEYS, "rank_of_weapon", "prey_weapon_rank", "killer_location", "prey_location"]
    events = _kills(spark, folder).select("event_id", F.col("ts").cast("timestamp").alias("ts"), "engagement_seconds", *columns)
    kills = events.withColumn("user_id", F.col("player_id"))

    def messages(stream: DataFrame) -> DataFrame:
        sessions = game.weapon_session_stream(stream, "ts", 8 * GAP_US)
        return sessions.select(text.encode(game.weapon_line()).alias("value"))

    return _windowed(spark, kills, "weapons", messages).select(text.decode(F.col("value")).alias("line"))


def _pane_results(spark: SparkSession, folder: str, label: str, starter, n: int) -> DataFrame:
    base = work_folder(spark, label)
    events = table(spark, folder, "events").select("event_id", "user_id", "value")

    def start(stream: DataFrame):
        return starter(
            stream, ["user_id"], "event_id", units(F.col("value")), n, f"{base}/out", f"{base}/checkpoint"
        )

    _replayed(spark, events, base, start)
    schema = T.StructType(
        [
            events.schema["user_id"],
            T.StructField("pane", T.LongType()),
            T.StructField("n", T.LongType()),
            T.StructField("total", T.LongType()),
        ]
    )
    return _double_total(stream_panes.read_results(spark, f"{base}/out", schema))


def stream_pane_discarding(spark: SparkSession, folder: str) -> DataFrame:
    return _pane_results(spark, folder, "discarding", stream_panes.start_discarding, 5)


def stream_pane_accumulating(spark: SparkSession, folder: str) -> DataFrame:
    return _pane_results(spark, folder, "accumulating", stream_panes.start_accumulating, 2)


def stream_store_pane_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The profit panes of a stream, published as encoded text lines and decoded again."""
    base = work_folder(spark, "store-panes")

    def start(stream: DataFrame):
        out, checkpoint = f"{base}/out", f"{base}/checkpoint"
        return store.start_profit_panes(stream, "event_id", out, checkpoint, line=store.pane_line())

    _replayed(spark, _sales(spark, folder), base, start)
    return _decoded_lines(stream_panes.read_results(spark, f"{base}/out", MESSAGE))


def stream_score_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The running scores of a stream, published as encoded text lines and decoded again."""
    base = work_folder(spark, "score-messages")
    kills = _kills(spark, folder).select("event_id", "player_id", "team_id")

    def start(stream: DataFrame):
        return game.start_player_team_scores(stream, f"{base}/out", f"{base}/checkpoint", line=game.score_line())

    _replayed(spark, kills, base, start)
    return _decoded_lines(stream_panes.read_results(spark, f"{base}/out", MESSAGE))


def stream_store_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Profit per store and 20 seconds, as a stream."""
    found = _windowed(spark, _sales(spark, folder), "store-windows", lambda s: store.profit_window_stream(s, "ts"))
    return _unzoned(found, "window_start", "window_end")


def _decoded_lines(messages: DataFrame) -> DataFrame:
    return messages.select(text.decode(F.col("value")).alias("line"))


def stream_player_team_score(spark: SparkSession, folder: str) -> DataFrame:
    base = work_folder(spark, "scores")
    kills = _kills(spark, folder).select("event_id", "player_id", "team_id")
    _replayed(
        spark, kills, base, lambda s: game.start_player_team_scores(s, f"{base}/out", f"{base}/checkpoint")
    )
    schema = T.StructType().add("kind", "string").add("id", "string").add("score", "long")
    return stream_panes.read_results(spark, f"{base}/out", schema)


def _message_columns(df: DataFrame) -> DataFrame:
    even: Column = F.col("attributes")["even"]
    return df.select("value", even.alias("even"))


def replay_envelope(spark: SparkSession, folder: str) -> DataFrame:
    return _message_columns(table(spark, folder, "events").select(*topics.envelope(F.col("event_id"))))


def stream_passthrough(spark: SparkSession, folder: str) -> DataFrame:
    """The events table itself as a topic, every row as a message with attribute, passed on unchanged."""
    base = work_folder(spark, "passthrough")
    path = f"{folder}/events.parquet"
    stream = topics.subscribe(spark, topics.exact_glob(path), spark.read.parquet(path).schema)
    messages = stream.select(*topics.envelope(F.col("event_id")))
    control.run_out(control.start_sink(messages, f"{base}/out", f"{base}/checkpoint"))
    return _message_columns(spark.read.parquet(f"{base}/out"))
