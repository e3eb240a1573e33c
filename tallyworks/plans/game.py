"""Scores and weapon points of game kills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyworks.functions import scoring
from tallyworks.operators.panes import running_scores
from tallyworks.operators.windows import session_mean
from tallyworks.streaming.panes import start_scores
from tallyworks.streaming.windows import NO_DELAY, session_stream

# Fixed values of the game queries.
FIRE_EVERY = 2
SESSION_GAP_US = 5_000_000
WEAPON_KEYS = ["game_id", "player_id", "used_weapon"]
# The columns that points of a kill are made from.
POINT_COLUMNS = ["engagement_seconds", "rank_of_weapon", "prey_weapon_rank", "killer_location", "prey_location"]


def player_and_team(kills: DataFrame, player: str = "player_id", team: str = "team_id") -> DataFrame:
    """The number of kills of players and of teams, told apart by ``kind``, as parts to be summed up.

    Kills are counted per player and team first, so only the counts are doubled.
    """
    counted = kills.groupBy(player, team).agg(F.count(F.lit(1)).alias("added"))
    scorers = F.array(
        F.struct(F.lit("player").alias("kind"), F.col(player).cast("string").alias("id")),
        F.struct(F.lit("team").alias("kind"), F.col(team).cast("string").alias("id")),
    )
    return counted.select(F.explode(scorers).alias("scorer"), "added").select("scorer.kind", "scorer.id", "added")


def player_team_scores(kills: DataFrame, n: int = FIRE_EVERY) -> DataFrame:
    """Kills so far of every player and team, after every n kills."""
    return running_scores(player_and_team(kills), ["kind", "id"], n, "added")


def start_player_team_scores(
    kills: DataFrame,
    out: str,
    checkpoint: str,
    n: int = FIRE_EVERY,
    continuous: str | None = None,
    line: Column | None = None,
) -> StreamingQuery:
    return start_scores(kills, ["kind", "id"], n, out, checkpoint, player_and_team, continuous, line)


def score_line() -> Column:
    return F.concat(F.col("id"), F.lit(": "), F.col("score").cast("string"))


def with_points(kills: DataFrame, rank_rule: str = "written") -> DataFrame:
    points = scoring.weapon_points(
        F.col("engagement_seconds"),
        F.col("rank_of_weapon"),
        F.col("prey_weapon_rank"),
        F.col("killer_location"),
        F.col("prey_location"),
        rank_rule,
    )
    return kills.withColumn("points", points)


def weapon_sessions(
    kills: DataFrame, time: str = "kill_ts", gap_us: int = SESSION_GAP_US, rank_rule: str = "written"
) -> DataFrame:
    """Mean points per game, player, weapon and session."""
    scored = with_points(kills, rank_rule)
    return session_mean(
        scored, WEAPON_KEYS, time, gap_us, F.col("points"), "mean_points", 0, look_at=["player_id"]
    )


def weapon_session_stream(
    kills: DataFrame,
    time: str = "kill_ts",
    gap_us: int = SESSION_GAP_US,
    rank_rule: str = "written",
    delay: str = NO_DELAY,
) -> DataFrame:
    scored = with_points(kills, rank_rule)
    return session_stream(scored, WEAPON_KEYS, time, gap_us, F.col("points"), "mean_points", 0, delay=delay)


def weapon_line() -> Column:
    key = F.concat_ws(",", *WEAPON_KEYS)
    return F.concat(key, F.lit(": "), F.col("mean_points").cast("string"))
