"""The weekly job: add the last round, build the next one, refit, predict, log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlab.functions.columns import week_floor
from matchlab.functions.fixed_values import FIXTURE_TEAM_NAMES, LADDER_NAMES, LINEUP_NAMES
from matchlab.operators import model as M
from matchlab.operators.keyed import first_per_key
from matchlab.operators.names import canonical_team, resolve_lineup
from matchlab.operators.resample import time_split
from matchlab.operators.teams import build_fixtures, ladder_position
from matchlab.plans.features import dated, training_frame
from matchlab.plans.load import stored_schema
from matchlab.session import bounded_broadcast, cut
from matchlab.sources import tables as S
from matchlab.sources import versions as V
from matchlab.sources.schemas import KEYS, SCHEMAS

MAX_FIXTURES = 1_000_000  # matches of one round that may be broadcast


@dataclass
class Week:
    """Everything one weekly run reads. Histories may hold the round to predict and later ones; they are not used."""

    team_match: DataFrame
    player_match: DataFrame
    ladder: DataFrame
    player_key: DataFrame
    results: DataFrame
    lineup: DataFrame
    season: int
    round: int
    competition: Column | None = None
    round_offset: int = 0
    player_order: Sequence[str] = ("date", "match_id")
    names: Mapping[str, str] = field(default_factory=lambda: FIXTURE_TEAM_NAMES)
    slots: int = 100


def week_frame(week: Week, before: Column | None = None, **scale) -> DataFrame:
    """Model frame of the history and the coming round together.

    Of the histories only what was known then takes part, so a week that is run again after later rounds
    were stored gives the same rows: matches and players before the day ``before`` and not of the fixtures
    themselves, league tables of earlier rounds.
    """
    fixtures = cut(
        build_fixtures(
            week.results,
            week.season,
            week.round,
            week.competition,
            week.round_offset,
            week.names,
            week.slots,
            rows_bound=scale.get("match_bound"),
        )
    )
    coming = bounded_broadcast(fixtures.select("match_id").distinct(), MAX_FIXTURES)

    def history(df: DataFrame) -> DataFrame:
        df = dated(df)
        df = df if before is None else df.filter(F.col("date") < before)
        return df.join(coming, "match_id", "left_anti")

    earlier = (F.col("season") < week.season) | ((F.col("season") == week.season) & (F.col("round") < week.round))
    lineup = resolve_lineup(week.lineup, week.player_key, fixtures)
    tm = history(week.team_match).unionByName(fixtures.drop("season"), allowMissingColumns=True)
    pm = history(week.player_match).unionByName(
        lineup.withColumn("team_name", F.coalesce("team_name", "team")).drop("team"), allowMissingColumns=True
    )
    return training_frame(tm, pm, week.ladder.filter(earlier), week.player_order, **scale)


def score_week(week: Week, as_of: Column, pipeline: Pipeline, **scale) -> DataFrame:
    """Refit on every match before the week's Tuesday and predict the matches from it on."""
    frame = cut(week_frame(week, week_floor(as_of), **scale))
    past, coming = time_split(frame, week_floor(as_of))
    model = M.fit(pipeline, past)
    return M.score(model, coming).select("pred_a", "pred_h", "match_id", "date", "away_team", "home_team", "pick")


def stored(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A stored table, in its newest version or an earlier one."""
    return V.read(spark, f"{root}/tables/{name}", stored_schema(name), version)


def log_predictions(spark: SparkSession, root: str, predictions: DataFrame) -> int:
    """One row per match: predicting a week again replaces its rows, and the version before can be read back."""
    new = V.with_source(predictions.withColumn("season", F.year("date")), F.current_timestamp())
    return V.merge(spark, f"{root}/tables/prediction_log", stored_schema("prediction_log"), new, KEYS["prediction_log"])


def append_round(spark: SparkSession, root: str, season: int, round_number: int) -> None:
    """Merge the landed extracts of the round before into the stored tables; of several files the latest wins.

    Plain tables ``root/<name>`` become the first version of the stored ones, once.
    """
    landed = f"{root}/landed/season={season}/round={round_number}"

    def scan(name: str) -> DataFrame:
        files = V.file_source(spark.read.parquet(f"{landed}/{name}"))
        own = {c: S.snake_case(c) for c in files.columns if c not in ("_at", "_from", "_block")}
        return V.placed(files.withColumnsRenamed(own))

    team, player = (S.unnest_competition(scan(name)) for name in ("team_match", "player_match"))
    ladder = S.renamed(scan("ladder"), LADDER_NAMES).withColumns(
        {
            "team": canonical_team(F.col("team")),
            "season": F.lit(season),
            "round": F.lit(round_number),
        }
    )
    # A corrected row counts once, so it must win before positions are given.
    at, name = ladder.agg(F.max("_at"), F.max("_from")).first()
    ladder = V.with_source(ladder_position(V.latest_per_key(ladder, KEYS["ladder"]).drop("_at", "_from")), F.lit(at), name)
    for name, df in (("team_match", team), ("player_match", player), ("ladder", ladder)):
        full, table = stored_schema(name), f"{root}/tables/{name}"
        df = df.withColumns({"season": F.lit(season), **({"utc_start": F.to_date("utc_start")} if "utc_start" in df.columns else {})})
        typed = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in full], "_at", "_from", "_place")
        V.adopt(spark, table, full, f"{root}/{name}", KEYS[name])
        V.merge(spark, table, full, typed, KEYS[name])


def run_week(
    spark: SparkSession,
    root: str,
    season: int,
    round_number: int,
    as_of: dt.date | None = None,
    competition: int | None = None,
    round_offset: int = 0,
    names: Mapping[str, str] = FIXTURE_TEAM_NAMES,
    **scale,
) -> DataFrame:
    """Whole weekly job on a folder: running it again for the same week leaves the same tables.

    ``root`` holds the stored tables in versions (``tables/``), ``landed/season=/round=`` the extracts, ``results``,
    ``lineup`` and ``workflow`` (the unfitted pipeline). Predictions go to ``tables/prediction_log``.
    """
    append_round(spark, root, season, round_number - 1)
    now = f"{root}/landed/season={season}/round={round_number}"
    day = F.current_date() if as_of is None else F.lit(as_of)
    pm = stored(spark, root, "player_match")
    week = Week(
        team_match=stored(spark, root, "team_match").drop("season"),
        player_match=pm,
        ladder=stored(spark, root, "ladder"),
        player_key=first_per_key(
            pm.filter(F.col("utc_start") < week_floor(day)).select("player_id", "firstname", "surname", "utc_start", "match_id"),
            ["player_id"],
            [F.col(c) for c in ("utc_start", "match_id", "firstname", "surname")],
        ),
        results=spark.read.schema(SCHEMAS["results"]).parquet(f"{now}/results"),
        lineup=S.renamed(S.snake_columns(spark.read.parquet(f"{now}/lineup")), LINEUP_NAMES).select(*SCHEMAS["lineup"].names),
        season=season,
        round=round_number,
        competition=None if competition is None else F.lit(competition),
        round_offset=round_offset,
        names=names,
    )
    predictions = score_week(week, day, M.load_pipeline(f"{root}/workflow"), **scale)
    log_predictions(spark, root, predictions)
    return stored(spark, root, "prediction_log").select(*SCHEMAS["prediction_log"].names)
