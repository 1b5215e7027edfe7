"""Operators on team rows (two per match) and on matches (one row, home and away)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchlab.functions.columns import last_word, result_code
from matchlab.functions.fixed_values import FIXTURE_TEAM_NAMES, LADDER_COLUMNS
from matchlab.operators.keyed import first_per_key
from matchlab.operators.names import map_values
from matchlab.operators.ordered import lag_values, number_rows
from matchlab.session import bounded_broadcast, cut

SIDES = ("home", "away")
ORDER = ("date", "match_id")
MAX_LADDER = 300_000  # rows of about 100 bytes


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


def rest_days(
    tm: DataFrame, part: Sequence[str] = ("competition_id", "team_name"), order: Sequence[str] = ORDER, **scale
) -> DataFrame:
    """Days since the team's previous match in the competition; null for its first."""
    prev = lag_values(tm, list(part), _cols(order), {"_prev_date": F.col(order[0])}, **scale)
    return prev.withColumn("days_rest", F.datediff(order[0], "_prev_date")).drop("_prev_date")


def ladder_position(
    ladder: DataFrame, order: Sequence[Column] | None = None, by: Sequence[str] = ("season", "round"), **scale
) -> DataFrame:
    """Rank of each team in the league table of a round."""
    order = order or [F.col("ladder_points").desc(), F.col("points_diff").desc(), F.col("team")]
    ranked = number_rows(ladder, list(by), order, **scale)
    return ranked.withColumn("ladder_position", (F.col("_pos") + 1).cast("int")).drop("_pos")


def attach_ladder(tm: DataFrame, ladder: DataFrame, team: str = "team_name") -> DataFrame:
    """Left join of the league table on (last word of the team name, year of the date, round).

    The table (teams x seasons x rounds) is stored and counted; up to ``MAX_LADDER`` rows it is
    broadcast, so the team rows stay where they are.
    """
    keys = ["team", "season", "round"]
    order = ["ladder_position", "ladder_points", "points_for", "points_against", "points_diff"]
    table = first_per_key(ladder, keys, _cols(order)).select(
        F.col("team").alias("_team"),
        F.col("season").alias("_season"),
        F.col("round").alias("_round"),
        "ladder_points",
        *[F.col(c).alias(f"ladder_{c}") for c in ("points_for", "points_against", "points_diff")],
        "ladder_position",
    )
    on = (
        (last_word(F.col(team)) == F.col("_team"))
        & (F.year("date") == F.col("_season"))
        & (F.col("round") == F.col("_round"))
    )
    table = bounded_broadcast(cut(table), MAX_LADDER)
    return tm.join(table, on, "left").drop("_team", "_season", "_round")


def attach_prior_ladder(tm: DataFrame, ladder: DataFrame, team: str = "team_name", rounds: DataFrame | None = None) -> DataFrame:
    """League columns as they stood after the team's previous round.

    The lag runs over the rounds in which a team plays, not over its matches: where a round holds several
    matches of a team, all of them see the table of the round before, and none a table that counts its own
    result. Rounds (teams x seasons x rounds) are stored and counted like the league table; ``rounds`` is a table with the
    team rows of ``tm`` that is cheaper to read.
    """
    year = F.year("date").alias("_year")
    rounds = (tm if rounds is None else rounds).select(F.col(team), year, "round").distinct().withColumn("date", F.make_date("_year", F.lit(7), F.lit(1)))
    held = attach_ladder(rounds, ladder, team)
    w = Window.partitionBy(team).orderBy("_year", "round")
    prior = held.select(
        F.col(team).alias("_team"),
        F.col("_year").alias("_season"),
        F.col("round").alias("_round"),
        *[F.lag(c).over(w).alias(c) for c in LADDER_COLUMNS],
    )
    on = (F.col(team) == F.col("_team")) & (F.year("date") == F.col("_season")) & (F.col("round") == F.col("_round"))
    prior = bounded_broadcast(cut(prior), MAX_LADDER)
    return tm.join(prior, on, "left").drop("_team", "_season", "_round")


def pair_matches(
    tm: DataFrame,
    values: Mapping[str, str] | None = None,
    keys: Sequence[str] = ("match_id", "round", "date"),
) -> DataFrame:
    """One row per match with ``<name>_home`` and ``<name>_away`` for each value column.

    The two sides are fixed, so this is a plain aggregation without a pass for pivot values, partial per map task. Of
    several rows of a side one counts as a whole: the largest by its value columns in their order, nulls smallest.
    """
    values = values or {"team_name": "team", "score": "score"}
    row = f"struct({', '.join(f'`{src}`' for src in values)})"
    aggs = [F.expr(f"max({row}) FILTER (WHERE team_location = '{side}') AS _{side}") for side in SIDES]
    named = [F.col(f"_{side}").getField(src).alias(f"{dst}_{side}") for src, dst in values.items() for side in SIDES]
    return tm.groupBy(*keys).agg(*aggs).select(*keys, *named)


def with_result(matches: DataFrame, scheme: str = "elo", out: str = "result") -> DataFrame:
    return matches.withColumn(out, result_code(F.col("score_home"), F.col("score_away"), scheme))


def unpivot_sides(df: DataFrame, stems: Sequence[str]) -> DataFrame:
    """One row per side: ``<stem>_home`` / ``<stem>_away`` become ``<stem>`` under team_location."""
    sides = [
        F.struct(F.lit(s).alias("team_location"), *[F.col(f"{stem}_{s}").alias(stem) for stem in stems])
        for s in SIDES
    ]
    kept = [c for c in df.columns if c not in {f"{stem}_{s}" for stem in stems for s in SIDES}]
    return df.select(*kept, F.explode(F.array(*sides)).alias("_side")).select(*kept, "_side.*")


def build_fixtures(
    results: DataFrame,
    season: int | None = None,
    round_number: int | None = None,
    competition: Column | None = None,
    round_offset: int = 0,
    names: Mapping[str, str] | DataFrame = FIXTURE_TEAM_NAMES,
    slots: int = 100,
    **scale,
) -> DataFrame:
    """Fixtures in long form from a list of results.

    match_id = (competition * 100 + round) * slots + running number by date and home team within the
    round. A round of ``slots`` matches or more fails when it is read, so ids never run into the next
    round. ``round_offset`` corrects sources that number rounds ahead. Without season and round every
    round of the list is built.
    """
    competition = F.col("competition_id") if competition is None else competition
    df = results.withColumn("competition_id", competition.cast("long"))
    if season is not None:
        df = df.filter(F.col("season") == season)
    if round_number is not None:
        df = df.filter(F.col("round") == round_number + round_offset)
    df = df.withColumn("round", F.col("round") - round_offset)
    for side in SIDES:
        df = map_values(df, f"{side}_team", names)
    order = _cols(["date", "home_team", "away_team"])
    df = number_rows(df, ["competition_id", "round"], order, **scale)
    number = F.col("_pos") + 1
    full = F.raise_error(F.concat(F.lit(f"a round has {slots} matches or more; raise slots: round "), F.col("round")))
    number = F.when(number < slots, number).otherwise(full.cast("long"))
    match_id = (F.col("competition_id") * 100 + F.col("round")) * slots + number
    wide = df.select(
        "competition_id",
        match_id.cast("long").alias("match_id"),
        "season",
        "round",
        "date",
        F.col("home_team").alias("team_name_home"),
        F.col("away_team").alias("team_name_away"),
    )
    return unpivot_sides(wide, ["team_name"])


def local_alias_table(spark: SparkSession, aliases: Mapping[str, str]) -> DataFrame:
    return spark.createDataFrame(list(aliases.items()), "value string, mapped string")
