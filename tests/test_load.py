"""Bulk load of landed folders: headers in any order, both formats, corrections, later files, broken calls."""

import datetime as dt
import os

import pytest

from matchlab.functions.fixed_values import PLAYER_STATS, TEAM_STATS
from matchlab.plans import load as L
from matchlab.sources import versions as V


def put(path, header, rows, at):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join([",".join(header), *[",".join("NA" if v is None else str(v) for v in r) for r in rows]]) + "\n")
    os.utime(path, (at, at))


def camel(name):
    head, *rest = name.split("_")
    return head + "".join(w.capitalize() for w in rest)


def land_team(landed, season, rnd, score, at, name="f.csv", turned=False, teams=("Storm", "Eels")):
    header = ["competitionId", "matchId", "teamName", "teamLocation", "utcStart", *map(camel, TEAM_STATS)]
    rows = [[9, season * 100 + rnd, t, side, f"{season}-03-0{rnd}T10:00:00Z", score + k, *[1.5] * 8] for k, (t, side) in enumerate(zip(teams, ("home", "away")))]
    if turned:
        header, rows = header[::-1], [r[::-1] for r in rows]
    put(f"{landed}/season={season}/round={rnd}/team_match/{name}", header, rows, at)


def table(spark, root, name, *cols):
    return sorted(tuple(r) for r in V.read(spark, f"{root}/tables/{name}", L.stored_schema(name) if name != "player_key" else L.SCHEMAS[name]).select(*cols).collect())


def test_bulk_load(spark, tmp_path, monkeypatch):
    landed, root = str(tmp_path / "landed"), str(tmp_path / "root")
    land_team(landed, 2020, 1, 10.0, 1_700_000_000)
    land_team(landed, 2020, 2, 20.0, 1_700_000_000, turned=True)
    land_team(landed, 2021, 1, 30.0, 1_700_000_000)
    ladder = ["team", "points", "points_for", "points_against", "points_diff"]
    put(f"{landed}/season=2020/round=1/ladder/a.csv", ladder, [["Big Storm", 2, 10, 4, 6], ["Eels", 4, 4, 10, -6], [None, 1, 1, 1, 1]], 1_700_000_000)
    header = ["player_id", "firstname", "surname", "team_name", "squad_id", "position", "jumper_number", "utc_start", "match_id", "competition_id", "team_location", *PLAYER_STATS]
    for season, who in ((2021, "Bea"), (2020, "Ann")):
        row = [5, who, "Lee", "Storm", 1, "Prop", 3, f"{season}-03-01", season * 100 + 1, 9, "home", *[1] * len(PLAYER_STATS)]
        df = spark.createDataFrame([tuple(map(str, row))], ", ".join(f"`{camel(h)}` string" for h in header))
        df.coalesce(1).write.parquet(f"{landed}/season={season}/round=1/player_match")
    put(f"{landed}/season=2020/round=1/notes/a.csv", ["x"], [[1]], 1_700_000_000)

    merge = V.merge

    def crash(spark, table, *a, **k):
        if table.endswith("load_ledger"):
            raise RuntimeError("driver lost")
        return merge(spark, table, *a, **k)

    with monkeypatch.context() as m:
        m.setattr(L.V, "merge", crash)
        with pytest.raises(RuntimeError, match="driver lost"):
            L.load(spark, landed, root)
    want = [(y * 100 + r, t, s + k, dt.date(y, 3, r), r, y) for y, r, s in ((2020, 1, 10.0), (2020, 2, 20.0), (2021, 1, 30.0)) for k, t in enumerate(("Storm", "Eels"))]
    cols = ("match_id", "team_name", "score", "utc_start", "round", "season")
    for files in (6, 0):
        assert L.load(spark, landed, root).count() == files
        assert table(spark, root, "team_match", *cols) == sorted(want)
    assert table(spark, root, "ladder", "team", "ladder_points", "season", "round", "ladder_position") == [("Eels", 4.0, 2020, 1, 1), ("Storm", 2.0, 2020, 1, 2)]
    assert table(spark, root, "player_key", "player_id", "firstname") == [(5, "Ann")]
    assert table(spark, root, "player_match", "player_id", "season", "tackles") == [(5, 2020, 1.0), (5, 2021, 1.0)]

    land_team(landed, 2020, 2, 25.0, 1_700_000_500, "g.csv")  # corrected later
    land_team(landed, 2021, 1, 99.0, 1_600_000_000, "old.csv")  # older than what is stored
    put(f"{landed}/season=2020/round=1/ladder/b.csv", ladder[::-1], [[60, 4, 70, 6, "Storm"]], 1_700_000_500)
    assert L.load(spark, landed, root).count() == 3
    want = [(*w[:2], w[2] + 5 if w[0] == 202002 else w[2], *w[3:]) for w in want]
    assert table(spark, root, "team_match", *cols) == sorted(want)
    assert table(spark, root, "ladder", "team", "ladder_position") == [("Eels", 2), ("Storm", 1)]


def test_a_missing_column_is_named(spark, tmp_path):
    put(f"{tmp_path}/landed/season=2020/round=1/ladder/a.csv", ["team", "points"], [["Storm", 2]], 1_700_000_000)
    with pytest.raises(ValueError, match="points_for"):
        L.load(spark, f"{tmp_path}/landed", f"{tmp_path}/root")


def test_nothing_landed(spark, tmp_path):
    os.makedirs(tmp_path / "landed")
    assert L.load(spark, f"{tmp_path}/landed", f"{tmp_path}/root").count() == 0
