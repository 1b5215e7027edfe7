"""Explicit table schemas; nothing is inferred or picked by position."""

from __future__ import annotations

from pyspark.sql import types as T

from matchlab.functions.fixed_values import PLAYER_STATS, TEAM_STATS

_TYPES = {"long": T.LongType(), "string": T.StringType(), "int": T.IntegerType(), "double": T.DoubleType(), "date": T.DateType(), "timestamp": T.TimestampType()}


def struct(columns: str, doubles: list[str] | None = None, tail: str = "") -> T.StructType:
    """``"match_id long, round int"`` plus a list of double columns plus a tail; needs no running session."""

    def fields(text: str) -> list[T.StructField]:
        pairs = [c.split() for c in text.split(",") if c.strip()]
        return [T.StructField(name, _TYPES[kind]) for name, kind in pairs]

    return T.StructType(fields(columns) + [T.StructField(n, T.DoubleType()) for n in doubles or []] + fields(tail))


# --- fixed values: the tables' columns and types
SCHEMAS = {
    "ladder": struct(
        "team string, ladder_points double, points_for double, points_against double, points_diff double, season int, round int, ladder_position int"
    ),
    "player_match": struct(
        "player_id long, firstname string, surname string, team_name string, squad_id long, position string, jumper_number int, utc_start date, match_id long, competition_id long, round int, team_location string",
        PLAYER_STATS,
        "season int",
    ),
    "team_match": struct(
        "competition_id long, match_id long, round int, team_name string, team_location string, utc_start date", TEAM_STATS
    ),
    "player_key": struct("player_id long, firstname string, surname string"),
    "lineup": struct("firstname string, surname string, position string, team string"),
    "results": struct("season int, round int, date date, home_team string, away_team string, home_score double, away_score double"),
    "odds": struct("home_odds_close double, away_odds_close double, home_score double, away_score double"),
    "prediction_log": struct("pred_a double, pred_h double, match_id long, date date, away_team string, home_team string, pick string"),
    "experiments_log": struct(
        "timestamp timestamp, algorithm string, feature_set string, resample_scheme string, logloss double, notes string"
    ),
}

KEYS = {
    "ladder": ["team", "season", "round"],
    "player_match": ["player_id", "match_id"],
    "team_match": ["match_id", "team_name"],
    "player_key": ["player_id"],
    "prediction_log": ["match_id"],
}
