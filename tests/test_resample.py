import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchlab.functions.columns import week_floor
from matchlab.operators.resample import fold_ends, initial_size, rolling_origin, time_split
from matchlab.operators.teams import build_fixtures


def games(spark, n):
    return spark.range(n).select(F.col("id").alias("match_id"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 3).cast("int")).alias("date")).repartition(5)


def test_ten_folds_end_where_the_scheme_says(spark):
    n = 700
    out = rolling_origin(games(spark, n)).collect()
    ends = fold_ends(n, initial_size(n))
    assert ends == [250 + 31 * i for i in range(10)]
    for fold, end in enumerate(ends, 1):
        train = {r.match_id for r in out if r.fold == fold and r.role == "analysis"}
        held = {r.match_id for r in out if r.fold == fold and r.role == "assessment"}
        assert train == set(range(end)) and held == set(range(end, end + 150))


@pytest.mark.parametrize("cumulative", [True, False])
def test_other_schemes(spark, cumulative):
    n, initial, assess, skip = 100, 20, 10, 6
    out = rolling_origin(games(spark, n), initial=initial, assess=assess, skip=skip, cumulative=cumulative).collect()
    for fold, end in enumerate(fold_ends(n, initial, assess, skip), 1):
        start = 0 if cumulative else end - initial
        assert {r.match_id for r in out if r.fold == fold and r.role == "analysis"} == set(range(start, end))
        assert {r.match_id for r in out if r.fold == fold and r.role == "assessment"} == set(range(end, end + assess))
    with pytest.raises(ValueError):
        rolling_origin(games(spark, 100))


def test_week_floor_is_the_tuesday_before(spark):
    days = [dt.date(2026, 4, 21), dt.date(2026, 4, 20), dt.date(2026, 4, 26)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r[0] for r in df.select(week_floor(F.col("d"))).collect()] == [dt.date(2026, 4, 21), dt.date(2026, 4, 14), dt.date(2026, 4, 21)]
    before, after = time_split(df.toDF("date"), F.lit(dt.date(2026, 4, 21)))
    assert before.count() == 1 and after.count() == 2


def test_fixture_ids(spark):
    names = [("Wests Tigers", "Canberra"), ("North Qld", "Cronulla"), ("Brisbane", "Canterbury")]
    rows = [(2026, 9, dt.date(2026, 4, 23 + i), h, a) for i, (h, a) in enumerate(names)] + [(2026, 8, dt.date(2026, 4, 1), "x", "y")]
    res = spark.createDataFrame(rows, "season int, round int, date date, home_team string, away_team string")
    out = build_fixtures(res, 2026, 8, F.lit(12999), round_offset=1)
    got = sorted((r.match_id, r.team_location, r.team_name, r.round) for r in out.collect())
    assert got[:2] == [(129990801, "away", "Canberra Raiders", 8), (129990801, "home", "Wests Tigers", 8)]
    assert got[-1] == (129990803, "home", "Brisbane Broncos", 8) and len(got) == 6


def test_fixture_ids_are_unique_or_fail(spark):
    rows = [(2026, r, f"2026-01-{1 + n % 28:02d}", f"h{n}", f"a{n}") for r in (1, 2) for n in range(150)]
    res = spark.createDataFrame(rows, "season int, round int, date string, home_team string, away_team string").withColumn("date", F.to_date("date"))
    out = build_fixtures(res, competition=F.lit(3), slots=1000)
    assert out.select("match_id").distinct().count() == 300
    with pytest.raises(Exception, match="raise slots"):
        build_fixtures(res, competition=F.lit(3)).collect()
