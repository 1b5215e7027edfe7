import csv
import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchlab.functions.fixed_values import TEAM_STATS
from matchlab.sources.schemas import SCHEMAS, struct
from matchlab.sources.tables import (
    append_log,
    collect_extracts,
    log_experiment,
    read_table,
    snake_case,
    unnest_competition,
    upsert,
    upsert_table,
    write_table,
)


def test_snake_case():
    names = ["kicksGeneralPlay", "timeInOwn20", "playerId", "utc_start", "runsHitupMetres", "Home Odds Close"]
    assert [snake_case(n) for n in names] == ["kicks_general_play", "time_in_own20", "player_id", "utc_start", "runs_hitup_metres", "home_odds_close"]


def test_csv_with_row_names_and_timestamps(spark, tmp_path):
    path = tmp_path / "team.csv"
    names = SCHEMAS["team_match"].names
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["", *names])
        w.writerow(["1", 9, 7, 3, "A Storm", "home", "2025-03-01T09:30:00Z", *[1.5] * 9])
        w.writerow(["2", 9, 7, 3, "B Eels", "away", "2025-03-01", "NA", *[2] * 8])
    rows = read_table(spark, "team_match", str(path), "csv", row_names=True).orderBy("team_name").collect()
    assert [r.utc_start for r in rows] == [dt.date(2025, 3, 1)] * 2
    assert rows[0].match_id == 7 and rows[1].score is None and rows[1].goal_line_dropouts == 2.0


def test_csv_columns_are_taken_by_name(spark, tmp_path):
    path = tmp_path / "key.csv"
    path.write_text("player_id,surname,firstname,extra\n7,Smith,Ann,x\n8.0,Ng,Bo,y\n")
    rows = read_table(spark, "player_key", str(path), "csv").orderBy("player_id").collect()
    assert [tuple(r) for r in rows] == [(7, "Ann", "Smith"), (8, "Bo", "Ng")]
    path.write_text("player_id,surname\n7,Smith\n")
    with pytest.raises(ValueError, match="firstname"):
        read_table(spark, "player_key", str(path), "csv")
    path.write_text("player_id,surname,firstname\nseven,Smith,Ann\n")
    with pytest.raises(Exception, match="seven"):
        read_table(spark, "player_key", str(path), "csv").collect()


def test_log_times_in_both_formats(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text("timestamp,algorithm,feature_set,resample_scheme,logloss,notes\n24/11/2025 9:05,a,b,c,0.5,\n2025-11-25T10:00:00Z,a,b,c,NA,n\n")
    rows = read_table(spark, "experiments_log", str(path), "csv").orderBy("timestamp").collect()
    assert [r.timestamp for r in rows] == [dt.datetime(2025, 11, 24, 9, 5), dt.datetime(2025, 11, 25, 10, 0)]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_write_and_append(spark, tmp_path, fmt):
    path = str(tmp_path / "log")
    df = spark.createDataFrame([("Storm", 4.0, 1.0, 1.0, 0.0, 2025, 1, 1)], SCHEMAS["ladder"])
    write_table(df, path, fmt)
    append_log(df.withColumn("round", F.lit(2)), path, fmt)
    assert sorted(r["round"] for r in read_table(spark, "ladder", path, fmt).collect()) == [1, 2]
    write_table(df, path, fmt)
    assert read_table(spark, "ladder", path, fmt).count() == 1


def test_experiment_log(spark, tmp_path):
    path = str(tmp_path / "log")
    for loss in (0.6, 0.5):
        log_experiment(spark, path, algorithm="gbt", feature_set="a, b", resample_scheme="10 cv folds", logloss=loss)
    rows = read_table(spark, "experiments_log", path, "csv").collect()
    assert sorted(r.logloss for r in rows) == [0.5, 0.6] and rows[0].feature_set == "a, b" and rows[0].timestamp


def test_extracts_are_united_by_name(spark):
    a = spark.createDataFrame([(1, 2.0), (None, 3.0)], "playerId long, kickMetres double")
    b = spark.createDataFrame([(5, "x")], "playerId long, firstname string")
    out = collect_extracts([a, b], ["player_id"], season=F.lit(2020))
    assert out.columns == ["player_id", "kick_metres", "firstname", "season"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2.0, None, 2020), (5, None, "x", 2020)]
    assert collect_extracts([a]).count() == 1
    nested = spark.sql("SELECT named_struct('id', 7) AS competition_id")
    assert unnest_competition(nested).first()[0] == 7


def test_upsert_corrects_and_is_idempotent(spark):
    hist = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id long, t string, x double")
    new = spark.createDataFrame([(2, "b", 5.0), (3, "c", 3.0)], "id long, t string, x double")
    once = upsert(hist, new, ["id", "t"])
    twice = upsert(once, new, ["id", "t"])
    want = [(1, "a", 1.0), (2, "b", 5.0), (3, "c", 3.0)]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == want


def test_upsert_table_rewrites_only_touched_seasons(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = struct("id long, x double, season int")
    first = spark.createDataFrame([(1, 1.0, 2020), (2, 2.0, 2021)], schema)
    upsert_table(spark, path, schema, first, ["id"])
    before = {p.name for p in (tmp_path / "t" / "season=2020").glob("*.parquet")}
    fix = spark.createDataFrame([(2, 9.0, 2021), (3, 3.0, 2021)], schema)
    for _ in range(2):
        upsert_table(spark, path, schema, fix, ["id"])
    rows = sorted((r.id, r.x, r.season) for r in spark.read.schema(schema).parquet(path).collect())
    assert rows == [(1, 1.0, 2020), (2, 9.0, 2021), (3, 3.0, 2021)]
    assert before == {p.name for p in (tmp_path / "t" / "season=2020").glob("*.parquet")}
    assert len(TEAM_STATS) == 9


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_extract_folders_by_season_and_round(spark, tmp_path, fmt):
    path = str(tmp_path / "landed")
    rows = [("Storm", 4.0, 1.0, 1.0, 0.0, s, r, 1) for s in (2020, 2021) for r in (1, 2)]
    df = spark.createDataFrame(rows, SCHEMAS["ladder"])
    writer = df.write.partitionBy("season", "round").format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)
    got = read_table(spark, "ladder", path, fmt).filter("season = 2021")
    assert sorted((r.season, r["round"], r.ladder_points, r.ladder_position) for r in got.collect()) == [(2021, 1, 4.0, 1), (2021, 2, 4.0, 1)]


def test_files_of_a_folder_with_different_headers(spark, tmp_path):
    folder = tmp_path / "keys"
    for part, text in {
        "season=1": "player_id,firstname,surname\n1,Ann,Smith\n",
        "season=2": "player_id,surname,firstname,extra\n2,Bob,Kim,x\n",
        "season=3": "surname,firstname,player_id\nNg,Bo,3\n",
        "season=4": "player_id,firstname,surname\n4,Di,Lee\n",
    }.items():
        (folder / part).mkdir(parents=True)
        (folder / part / "a b+c.csv").write_text(text)
    rows = read_table(spark, "player_key", str(folder), "csv").orderBy("player_id").collect()
    assert [tuple(r) for r in rows] == [(1, "Ann", "Smith"), (2, "Kim", "Bob"), (3, "Bo", "Ng"), (4, "Di", "Lee")]
    wide = struct("player_id long, firstname string, surname string, season int")
    assert sorted((r.player_id, r.season) for r in read_table(spark, wide, str(folder), "csv").collect()) == [(i, i) for i in range(1, 5)]
    (folder / "season=3" / "a b+c.csv").write_text("surname,player_id\nNg,3\n")
    with pytest.raises(ValueError, match="firstname"):
        read_table(spark, "player_key", str(folder), "csv")
