import re

import pytest
from pyspark.sql import functions as F

from matchlab.functions.columns import last_word, result_code
from matchlab.functions.fixed_values import PLAYER_FEATURES, PLAYER_STATS
from matchlab.operators.form import group_scale, player_rates
from matchlab.operators.frame import DIFF_FEATURES, PREDICTORS, join_team_features, model_frame, team_rollup
from matchlab.operators.keyed import first_per_key
from matchlab.operators.metrics import devig
from matchlab.operators.teams import attach_ladder, attach_prior_ladder, pair_matches, rest_days, unpivot_sides
from suite import queries


def test_the_frame_has_36_predictors():
    assert len(DIFF_FEATURES) == 33 and len(PREDICTORS) == 36 and len(PLAYER_FEATURES) == 18


def test_result_codes(spark):
    df = spark.createDataFrame([(2.0, 1.0), (1.0, 2.0), (1.0, 1.0), (None, 1.0)], "h double, a double")
    codes = df.select(*[result_code(F.col("h"), F.col("a"), s).alias(s) for s in ("elo", "label", "odds")]).collect()
    assert [r.elo for r in codes] == [1.0, 0.0, 0.5, None]
    assert [r.label for r in codes] == ["H", "A", "A", "A"]
    assert [r.odds for r in codes] == [1.0, 0.0, 0.0, 0.0]


def test_last_word_is_null_without_a_match(spark):
    df = spark.createDataFrame([("St George-Illawarra Dragons",), ("x!",), (None,)], "t string")
    assert [r[0] for r in df.select(last_word(F.col("t"))).collect()] == ["Dragons", None, None]


def players(spark, **changes):
    base = {c: 2.0 for c in PLAYER_STATS}
    ids = "player_id long, team_name string, jumper_number int, position string, squad_id long, match_id long, competition_id long, season int, round int, team_location string, firstname string, surname string"
    schema = ids + ", " + ", ".join(f"{c} double" for c in PLAYER_STATS)
    row = (1, "A", 1, "Prop", 1, 1, 1, 2020, 1, "home", changes.pop("firstname", "Al"), "Bo")
    stats = {**base, **changes}
    return spark.createDataFrame([(*row, *[stats[c] for c in PLAYER_STATS])], schema).withColumn("date", F.lit("2020-01-01").cast("date"))


def test_rates_over_nothing_are_null(spark):
    r = player_rates(players(spark, runs=0.0, tackles=0.0, possessions=0.0, conversion_attempts=0.0, kicks_general_play=0.0, firstname=None)).first()
    for c in ("m_per_run", "miss_per_t", "pass_per_touch", "goals_per_kick", "km_per_kick", "err_per_touch"):
        assert r[c] is None
    assert r.tackles_time == 0.0 and r.points_per_game == 2.0 and r.name == "NA_Bo"
    r = player_rates(players(spark)).first()
    assert r.tackles_time == pytest.approx(2 / 0.6) and r.goals_per_kick == 1.0


def test_scaling_of_single_rows_constants_and_gaps(spark):
    df = spark.createDataFrame([("one", 1.0), ("flat", 2.0), ("flat", 2.0), ("ok", 1.0), ("ok", 3.0), ("ok", None), (None, 1.0), (None, 3.0)], "g string, x double")
    out = {}
    for r in group_scale(df, ["g"], ["x"]).collect():
        out.setdefault(r.g, []).append(r.x)
    assert out["one"] == [None] and out["flat"] == [None, None]
    assert sorted(v for v in out["ok"] if v is not None) == pytest.approx([-0.70710678, 0.70710678])
    assert len(out["ok"]) == 3 and sorted(out[None]) == pytest.approx([-0.70710678, 0.70710678])


def test_rounding_noise_is_no_spread(spark):
    df = spark.createDataFrame([("g", 0.3), ("g", 0.1 + 0.2)], "g string, x double")
    assert [r.x for r in group_scale(df, ["g"], ["x"]).collect()] == [None, None]


def test_first_row_per_key_and_pairs(spark):
    df = spark.createDataFrame([(1, "A", "home", 5.0), (1, "A", "home", 4.0), (1, "B", "away", 3.0)], "match_id long, team_name string, team_location string, score double")
    one = first_per_key(df, ["match_id", "team_name"], [F.col("score")])
    assert one.count() == 2
    wide = pair_matches(one, keys=["match_id"]).first()
    assert (wide.team_home, wide.score_home, wide.team_away, wide.score_away) == ("A", 4.0, "B", 3.0)
    long = unpivot_sides(pair_matches(one, keys=["match_id"]), ["team", "score"])
    assert sorted((r.team_location, r.team, r.score) for r in long.collect()) == [("away", "B", 3.0), ("home", "A", 4.0)]


def test_rest_days_and_ladder_join(spark):
    tm = spark.createDataFrame([(1, 1, "X Storm", "2020-03-01", 1), (1, 2, "X Storm", "2020-03-09", 2), (2, 3, "X Storm", "2020-03-10", 3)], "competition_id long, match_id long, team_name string, date string, round int")
    tm = tm.withColumn("date", F.to_date("date"))
    assert {r.match_id: r.days_rest for r in rest_days(tm).collect()} == {1: None, 2: 8, 3: None}
    ladder = spark.createDataFrame([("Storm", 2.0, 1.0, 1.0, 0.0, 2020, 1, 1), ("Storm", 2.0, 1.0, 1.0, 0.0, 2020, 1, 2)], "team string, ladder_points double, points_for double, points_against double, points_diff double, season int, round int, ladder_position int")
    joined = {r.match_id: r.ladder_position for r in attach_ladder(tm, ladder).collect()}
    assert joined == {1: 1, 2: None, 3: None}


def test_league_columns_never_count_the_present_round(spark):
    """Three matches of a team in one round: all see the table after its previous round."""
    games = [(k, "X Storm", f"2020-0{1 + k // 3}-0{1 + k % 3}", 1 + k // 3) for k in range(9)] + [(20, "X Storm", "2021-05-01", 5)]
    tm = spark.createDataFrame(games, "match_id long, team_name string, date string, round int").withColumn("date", F.to_date("date"))
    schema = "team string, ladder_points double, points_for double, points_against double, points_diff double, season int, round int, ladder_position int"
    tables = [("Storm", 10.0 * r, 1.0, 1.0, 0.0, 2020, r, r) for r in (1, 2, 3)]

    def points(rows):
        return {r.match_id: r.ladder_points for r in attach_prior_ladder(tm, spark.createDataFrame(rows, schema)).collect()}

    want = {k: None if k < 3 else 10.0 * (k // 3) for k in range(9)} | {20: 30.0}
    assert points(tables) == want
    changed = points([*tables[:2], ("Storm", 99.0, 9.0, 9.0, 9.0, 2020, 3, 1)])
    assert {k: v for k, v in changed.items() if k < 9} == {k: v for k, v in want.items() if k < 9}


def team_rows(spark, swap=False):
    def row(side, v, score):
        return (1, side, f"{side} team", score, 0.6, 0.6, 0.6, *[v + i for i in range(len(DIFF_FEATURES))])

    cols = ["match_id long", "team_location string", "team_name string", "result double", "pr_home double", "shortpr_home double", "longpr_home double", *[f"{c} double" for c in DIFF_FEATURES]]
    sides = ("away", "home") if swap else ("home", "away")
    return spark.createDataFrame([row(sides[0], 1.5, 20.0), row(sides[1], 7.0, 10.0)], ", ".join(cols)).withColumn("date", F.lit("2020-01-01").cast("date"))


def test_swapping_the_sides_negates_the_differences(spark):
    a, b = model_frame(team_rows(spark)).first(), model_frame(team_rows(spark, swap=True)).first()
    assert all(a[f"{c}_diff"] == -b[f"{c}_diff"] == -5.5 for c in DIFF_FEATURES)
    assert (a.result, b.result, a.home_team, b.home_team) == ("H", "A", "home team", "home team")


def test_missing_side_counts_as_zero(spark):
    r = model_frame(team_rows(spark).filter("team_location = 'home'")).first()
    assert r.score_diff == 1.5 + DIFF_FEATURES.index("score") and r.result == "A" and r.away_result == 0.0


def test_rollup_ignores_missing_values(spark):
    pf = player_rates(players(spark)).unionByName(player_rates(players(spark, runs=0.0)))
    r = team_rollup(pf).first()
    assert r.m_per_run == 1.0 and r.team_location == "home"
    tf = spark.createDataFrame([(1, "A", 3.0)], "match_id long, team_name string, result double")
    assert join_team_features(team_rollup(pf), tf).first().result == 3.0


def test_odds_without_margin(spark):
    df = spark.createDataFrame([(1.5, 3.0, 10.0, 4.0), (None, 3.0, 1.0, 2.0)], "home_odds_close double, away_odds_close double, home_score double, away_score double")
    rows = devig(df).collect()
    assert len(rows) == 1 and rows[0].home_pr == pytest.approx(2 / 3) and rows[0].result == 1.0


def test_duplicate_sides_keep_the_values_of_one_row(spark):
    from matchlab.operators.teams import pair_matches

    rows = [(1, 1, 1, "home", "A", 9.0), (1, 1, 1, "home", "B", 4.0), (1, 1, 1, "away", "C", None), (1, 1, 1, "away", "C", 2.0), (2, 1, 1, "away", None, 3.0)]
    tm = spark.createDataFrame(rows, "match_id int, round int, date int, team_location string, team_name string, score double")
    got = sorted(tuple(r) for r in pair_matches(tm).select("match_id", "team_home", "score_home", "team_away", "score_away").collect())
    assert got == [(1, "B", 4.0, "C", 2.0), (2, None, None, None, 3.0)]


def test_spread_is_judged_once_per_group(spark):
    rows = [("a", 1.0, 0.3), ("a", 3.0, 0.1 + 0.2), ("b", 5.0, 1.0), ("z", 0.0, None), ("z", 0.0, 2.0)]
    out = group_scale(spark.createDataFrame(rows, "g string, x double, y double"), ["g"], ["x", "y"])
    assert "CASE WHEN" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((r.g, r.x, r.y) for r in out.collect() if r.g == "a")
    assert [g[1] for g in got] == pytest.approx([-0.70710678, 0.70710678]) and [g[2] for g in got] == [None, None]
    assert all(r.x is None and r.y is None for r in out.collect() if r.g != "a")


def test_the_frame_deals_its_players_by_match_once(spark, sf):
    """Statistics and scaled rows share one exchange; roll-up, features and pivot find their rows by match in place."""
    out = queries.build_frame(spark, sf)
    assert out.count() == len(out.collect())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan
    assert not re.search(r"Exchange hashpartitioning\(match_id#\d+L?, team_key#", plan)
