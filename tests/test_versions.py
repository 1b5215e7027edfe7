"""Versioned tables: source order, replays, late files, crashes, competing writers."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlab.sources import commerce
from matchlab.sources import versions as V
from matchlab.streaming.ingest import stream_upsert
from suite import queries

SCHEMA = T.StructType().add("id", "long").add("season", "integer").add("x", "double")


def rows(spark, table, **kw):
    return sorted(map(tuple, V.read(spark, table, SCHEMA, **kw).collect()), key=str)


def batch(spark, data, at, name=""):
    """(id, season, x, place)"""
    df = spark.createDataFrame(data, "id long, season int, x double, place long").repartition(3)
    return V.with_source(df, F.lit(at), name, F.col("place")).drop("place")


def test_the_last_row_of_a_batch_wins(spark, tmp_path):
    table = str(tmp_path / "t")
    V.merge(spark, table, SCHEMA, batch(spark, [(1, 2020, 10.0, 2), (1, 2020, 4.0, 1), (2, 2020, 1.0, 1), (None, 2020, 7.0, 1), (None, 2020, 8.0, 5)], "2024-01-01"), ["id"])
    assert rows(spark, table) == [(1, 2020, 10.0), (2, 2020, 1.0), (None, 2020, 8.0)]


def test_order_of_arrival_does_not_matter(spark, tmp_path):
    first = [(1, 2020, 1.0, 0), (2, 2021, 2.0, 0)]
    second = [(1, 2020, 5.0, 0), (3, 2021, 3.0, 0)]
    want = [(1, 2020, 5.0), (2, 2021, 2.0), (3, 2021, 3.0)]
    for k, order in enumerate([(0, 1), (1, 0), (0, 1, 0), (1, 1, 0, 1)]):
        table = str(tmp_path / f"t{k}")
        for i in order:
            V.merge(spark, table, SCHEMA, batch(spark, (first, second)[i], f"2024-01-0{i + 1}"), ["id"])
        assert rows(spark, table) == want


def test_versions_can_be_read_back_and_forgotten(spark, tmp_path):
    table = str(tmp_path / "t")
    for i in range(1, 5):
        assert V.merge(spark, table, SCHEMA, batch(spark, [(1, 2020, float(i), 0), (i, 2021, float(i), 0)], f"2024-01-0{i}"), ["id", "season"]) == i
    assert rows(spark, table, version=2) == [(1, 2020, 2.0), (1, 2021, 1.0), (2, 2021, 2.0)]
    assert rows(spark, table, parts=["2020"]) == [(1, 2020, 4.0)]
    assert sorted(V.changed_parts(spark, table, 3)) == ["2020", "2021"] and V.changed_parts(spark, table, 4) == []
    assert V.merge(spark, table, SCHEMA, batch(spark, [], "2024-02-01"), ["id", "season"]) == 4
    now = rows(spark, table)
    V.forget(spark, table, keep=2)
    assert V.versions(spark, table) == [3, 4] and rows(spark, table) == now and len(os.listdir(f"{table}/data")) == 2


def test_untouched_partitions_keep_their_folder(spark, tmp_path):
    table = str(tmp_path / "t")
    V.merge(spark, table, SCHEMA, batch(spark, [(1, 2020, 1.0, 0), (2, 2021, 2.0, 0), (3, None, 3.0, 0)], "2024-01-01"), ["id"])
    V.merge(spark, table, SCHEMA, batch(spark, [(2, 2021, 9.0, 0), (3, None, 4.0, 0)], "2024-01-02"), ["id"])
    assert sorted(V.changed_parts(spark, table, 1), key=str) == ["2021", None]
    assert rows(spark, table) == [(1, 2020, 1.0), (2, 2021, 9.0), (3, None, 4.0)]


def test_a_crash_before_the_switch_leaves_the_old_version(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    old, new = batch(spark, [(1, 2020, 1.0, 0)], "2024-01-01"), batch(spark, [(1, 2020, 2.0, 0)], "2024-01-02")
    V.merge(spark, table, SCHEMA, old, ["id"])

    def crash(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(V, "_publish", crash)
        with pytest.raises(RuntimeError, match="driver lost"):
            V.merge(spark, table, SCHEMA, new, ["id"])
    assert rows(spark, table) == [(1, 2020, 1.0)] and len(os.listdir(f"{table}/data")) == 2
    assert V.merge(spark, table, SCHEMA, new, ["id"]) == 2 and rows(spark, table) == [(1, 2020, 2.0)]
    V.forget(spark, table, keep=1)
    assert len(os.listdir(f"{table}/data")) == 1


def test_two_writers_lose_nothing(spark, tmp_path, monkeypatch):
    table = str(tmp_path / "t")
    V.merge(spark, table, SCHEMA, batch(spark, [(1, 2020, 1.0, 0)], "2024-01-01"), ["id"])
    publish, rival = V._publish, [batch(spark, [(2, 2020, 2.0, 0)], "2024-01-02")]

    def slow(*a):
        if rival:
            V.merge(spark, table, SCHEMA, rival.pop(), ["id"])
        publish(*a)

    monkeypatch.setattr(V, "_publish", slow)
    assert V.merge(spark, table, SCHEMA, batch(spark, [(3, 2020, 3.0, 0)], "2024-01-03"), ["id"]) == 3
    assert rows(spark, table) == [(1, 2020, 1.0), (2, 2020, 2.0), (3, 2020, 3.0)]
    monkeypatch.setattr(V, "_publish", lambda s, listed, t, v: publish(s, listed, t, 1))
    with pytest.raises(V.Conflict):
        V.merge(spark, table, SCHEMA, batch(spark, [(4, 2020, 3.0, 0)], "2024-01-04"), ["id"], attempts=2)


def land(spark, folder, name, data, at):
    df = spark.createDataFrame(data, SCHEMA).coalesce(1)
    df.write.parquet(f"{folder}-{name}")
    (part,) = [f for f in os.listdir(f"{folder}-{name}") if f.endswith(".parquet")]
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}-{name}/{part}", "rb") as source, open(f"{folder}/{name}.parquet", "wb") as target:
        target.write(source.read())
    os.utime(f"{folder}/{name}.parquet", (at, at))


def test_a_correction_in_the_same_stream_batch_wins(spark, tmp_path):
    landed, table, state = (str(tmp_path / n) for n in ("landed", "table", "state"))
    land(spark, landed, "b", [(1, 2020, 4.0), (2, 2020, 9.0)], 1_700_000_000)
    land(spark, landed, "a", [(1, 2020, 10.0)], 1_700_000_100)  # later, though its name comes first and its value is larger
    land(spark, landed, "c", [(2, 2020, 1.0), (2, 2020, 3.0), (2, 2020, 2.0)], 1_700_000_050)  # the last row of a file
    stream_upsert(spark, landed, table, SCHEMA, ["id"], state)
    assert rows(spark, table) == [(1, 2020, 10.0), (2, 2020, 2.0)]
    stream_upsert(spark, landed, table, SCHEMA, ["id"], str(tmp_path / "lost state"))  # all files once more
    assert rows(spark, table) == [(1, 2020, 10.0), (2, 2020, 2.0)]
    land(spark, landed, "late", [(1, 2020, 5.0)], 1_699_999_999)  # an older file that arrives later
    stream_upsert(spark, landed, table, SCHEMA, ["id"], state)
    assert rows(spark, table) == [(1, 2020, 10.0), (2, 2020, 2.0)]


def test_plain_tables_are_adopted_once(spark, tmp_path):
    plain, table = str(tmp_path / "plain"), str(tmp_path / "t")
    V.adopt(spark, table, SCHEMA, plain, ["id"])
    assert not V.exists(spark, table) and rows(spark, table) == []
    spark.createDataFrame([(1, 2020, 1.0)], SCHEMA).write.partitionBy("season").parquet(plain)
    for _ in range(2):
        V.adopt(spark, table, SCHEMA, plain, ["id"])
    assert V.versions(spark, table) == [1] and rows(spark, table) == [(1, 2020, 1.0)]


def test_equal_places_are_settled_alike(spark):
    data = [(1, 2020, float(x % 7), 0) for x in range(40)]
    got = {tuple(V.latest_per_key(batch(spark, data[k:] + data[:k], "2024-01-01"), ["id"]).select("id", "x").first()) for k in (0, 5, 11)}
    assert len(got) == 1


def test_latest_per_key_needs_no_sort_aggregate(spark):
    df = batch(spark, [(1, 2020, 1.0, 0), (1, 2020, 2.0, 1)], "2024-01-01")
    plan = V.latest_per_key(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_extracts_read_their_matches_once(spark, sf, monkeypatch):
    tm, read = commerce.team_match(spark, sf), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    monkeypatch.setattr(commerce, "team_match", lambda *_: tm.mapInArrow(counted, tm.schema))
    path, schema = queries._versioned(spark, sf)
    assert V.read(spark, path, schema).count() == read.value == tm.count()


def test_rows_are_dealt_by_key_once_and_stored_once(spark, tmp_path, monkeypatch):
    df = batch(spark, [(1, 2020, float(x), x) for x in range(20)], "2024-01-01")
    plan = V.latest_per_key(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("WindowGroupLimit") == 2  # a hot key is cut down before it is dealt
    cuts, cut = [], V.cut
    monkeypatch.setattr(V, "cut", lambda df: cuts.append(df) or cut(df))
    for at in ("2024-01-01", "2024-01-02"):
        V.merge(spark, str(tmp_path / "t"), SCHEMA, batch(spark, [(1, 2020, 1.0, 1), (2, 2020, 2.0, 1)], at), ["id"])
    assert len(cuts) == 2


def test_stored_rows_outside_the_extract_stay_as_they_are(spark, tmp_path):
    table = str(tmp_path / "t")
    twice = spark.createDataFrame([(1, 2020, 1.0), (2, 2020, 2.0), (2, 2020, 3.0), (3, 2020, 4.0)], SCHEMA)
    V.replace(spark, table, SCHEMA, V.with_source(twice, F.lit("2024-01-02")), "season")
    V.merge(spark, table, SCHEMA, batch(spark, [(1, 2020, 9.0, 1), (4, 2020, 8.0, 1)], "2024-01-01"), ["id"])  # 1 is stored from later
    V.merge(spark, table, SCHEMA, batch(spark, [(3, 2020, 7.0, 1)], "2024-01-02"), ["id"])
    assert rows(spark, table) == [(1, 2020, 1.0), (2, 2020, 2.0), (2, 2020, 3.0), (3, 2020, 7.0), (4, 2020, 8.0)]
