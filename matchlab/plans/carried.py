"""Team features that a week continues: closing ratings, form and last days are stored, not computed anew.

A snapshot holds the state through a day, that is of all matches before it. A refresh goes on from the newest snapshot
that no correction reaches back behind, so a correction of an old match rebuilds the rows from the snapshot
before it and leaves all earlier ones alone.

    <root>/tables/team_match      the matches, in versions
    <root>/tables/team_features   one row per match and side, in versions
    <root>/state/<kind>           ratings, form and last days by the day they go through
    <root>/state/snapshots        the valid days and the version of the matches that they stand for
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlab.functions.fixed_values import FORM_DECAY, LONG_RUN_K, TEAM_STATS
from matchlab.operators import frame, ratings, teams
from matchlab.operators.ordered import carried_ewma
from matchlab.session import cut
from matchlab.sources import versions as V

ORDER = ("date", "match_id")
REST_KEY = ["competition_id", "team_name"]


@dataclass
class State:
    """What all matches before a day leave behind."""

    ratings: DataFrame  # pool, team, rating (one per k)
    form: DataFrame  # team_name and one column per statistic
    last: DataFrame  # competition_id, team_name, date


def carried_rest(tm: DataFrame, last: DataFrame | None, part: Sequence[str] = REST_KEY, **scale) -> tuple[DataFrame, DataFrame]:
    """(rows with days_rest, last day per team); the day before the first new match comes from ``last``."""
    real = tm.withColumn("_turn", F.lit(1))
    days = tm.select(*part, "date")
    if last is not None:
        real = real.unionByName(last.select(*part, "date").withColumn("_turn", F.lit(0)), allowMissingColumns=True)
        days = days.unionByName(last.select(*part, "date"))
    rested = teams.rest_days(real, part, ("date", "_turn", "match_id"), **scale)
    return rested.filter("_turn = 1").drop("_turn"), days.groupBy(*part).agg(F.max("date").alias("date"))


def continue_teams(
    tm: DataFrame,
    state: State | None,
    ks: Mapping[str, float] = LONG_RUN_K,
    lam: float = FORM_DECAY,
    cols: Sequence[str] = TEAM_STATS,
    pool: Sequence[str] = (),
    match_bound: int | None = None,
    **scale,
) -> tuple[DataFrame, State]:
    """(rest, lagged form and ratings of the rows of ``tm``, state after them); ``tm`` holds only matches after the state.

    Rows before the state plus rows continued from it are what one pass over all rows gives.
    """
    grid = list(ks.values())
    matches = cut(teams.with_result(teams.pair_matches(tm, keys=["match_id", "date", *pool]), "elo"))
    kw = {"pool": pool, "rows_bound": match_bound, "state": state and state.ratings}
    rated = ratings.elo(matches, grid, arrays=False, **kw)
    named = ["match_id"] + [f"{c}_{i} AS {prefix}{c}" for i, prefix in enumerate(ks) for c in ("elo_home", "elo_away", "pr_home")]
    rested, last = carried_rest(tm.withColumn("result", F.col("score")), state and state.last, **scale)
    formed, form = carried_ewma(rested, state and state.form, ["team_name"], list(ORDER), cols, lam, **scale)
    rows = formed.join(frame.elo_sides(rated.selectExpr(*named)), ["match_id", "team_location"], "left")
    return rows, State(ratings.closing_ratings(matches, grid, **kw), form, last)


# ---------------------------------------------------------------- stored


def _kinds(cols: Sequence[str]) -> dict[str, T.StructType]:
    day = T.StructField("through", T.DateType())
    form = T.StructType([day, T.StructField("team_name", T.StringType())])
    for c in cols:
        form = form.add(c, T.DoubleType())
    return {
        "ratings": T.StructType([day]).add("pool", T.StringType()).add("team", T.StringType()).add("rating", T.ArrayType(T.DoubleType())),
        "form": form,
        "last": T.StructType([day]).add("competition_id", T.LongType()).add("team_name", T.StringType()).add("date", T.DateType()),
    }


SNAPSHOTS = T.StructType().add("kind", T.StringType()).add("through", T.DateType()).add("version", T.LongType())


def load_state(spark: SparkSession, root: str, through: dt.date, cols: Sequence[str] = TEAM_STATS) -> State:
    return State(*[V.read(spark, f"{root}/state/{k}", s, parts=[str(through)]).drop("through") for k, s in _kinds(cols).items()])


def refresh(
    spark: SparkSession, root: str, schema: T.StructType, through: dt.date, ks: Mapping[str, float] = LONG_RUN_K, cols: Sequence[str] = TEAM_STATS, **options
) -> dt.date | None:
    """Bring the stored team features and a snapshot up to the matches before ``through``; returns the day they went on from.

    ``schema`` is that of the stored matches (with date and season). Run again, or after a crash at any point, it gives the same
    tables: snapshots count only once the last step, their list, is published, and features are merged by match and team.
    """
    table = f"{root}/tables/team_match"
    head = max(V.versions(spark, table), default=0)
    known = V.read(spark, f"{root}/state/snapshots", SNAPSHOTS).collect()  # one row per snapshot
    days = [r.through for r in known if r.through <= through]
    if known:
        changed = V.first_change(spark, table, schema, min(r.version for r in known), "date")
        days = [d for d in days if changed is None or d <= changed]
    start = max(days, default=None)
    state = None if start is None else load_state(spark, root, start, cols)
    tm = V.read(spark, table, schema, head).filter(F.col("date") < F.lit(through))
    tm = cut(tm if start is None else tm.filter(F.col("date") >= F.lit(start)))
    rows, after = continue_teams(tm, state, ks, cols=cols, **options)
    rows = cut(rows)
    merged = V.with_source(rows, F.current_timestamp())
    V.merge(spark, f"{root}/tables/team_features", rows.schema, merged, ["match_id", "team_name"])
    for kind, fields in _kinds(cols).items():
        own = getattr(after, kind).withColumn("through", F.lit(through))
        V.replace(spark, f"{root}/state/{kind}", fields, own.select(*[F.col(f.name).cast(f.dataType) for f in fields]), "through")
    valid = sorted({*days, through})
    listed = spark.createDataFrame([("teams", d, head) for d in valid], SNAPSHOTS)
    V.replace(spark, f"{root}/state/snapshots", SNAPSHOTS, listed, "kind")
    return start
