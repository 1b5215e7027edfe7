"""Fitted preprocessing: levels, unseen and missing values, constants, the same by table and by pipeline."""

import pytest
from pyspark.sql import functions as F

from matchlab.operators import model as M
from matchlab.operators import preprocess as P

SCHEMA = "id int, x double, flat double, empty double, team string, one string, result string"
TRAIN = [
    (1, 1.0, 3.0, None, "b's", "k", "H"),
    (2, 2.0, 3.0, None, "a\\\\z", "k", "A"),
    (3, None, 3.0, None, "c", "k", "H"),
    (4, 4.0, None, None, None, "k", "A"),
    (5, 5.0, 3.0, None, "B S", "k", "H"),
]


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(TRAIN, SCHEMA)


@pytest.fixture(scope="module")
def rules(train):
    return P.fit_rules(train, ["x", "flat", "empty"], ["team", "one"]).cache()


def test_rules(rules):
    got = {(r.predictor, r.kind, r.level): (r.keep, r.place) for r in rules.collect()}
    assert got[("x", "numeric", None)][0] and not got[("flat", "numeric", None)][0] and not got[("empty", "numeric", None)][0]
    assert [k[2] for k, v in sorted(got.items(), key=lambda kv: kv[1][1]) if k[:2] == ("team", "nominal")] == ["B S", "a\\\\z", "b's", "c"]
    assert not got[("one", "nominal", "k")][0] and not got[("one", "novel", None)][0]
    features = [r.feature for r in rules.filter("predictor = 'team'").collect()]
    assert len(set(features)) == 5


def test_prepared_rows(spark, rules, train):
    seen = {r.level: r.feature for r in rules.filter("predictor = 'team'").collect()}
    got = {r.id: r.asDict() for r in P.prepare(train, rules, ["id"]).collect()}
    assert set(got[1]) == {"id", "x", seen["a\\\\z"], seen["b's"], seen["c"], "team_new"}
    assert got[1][seen["b's"]] == 1.0 and got[1][seen["c"]] == 0.0 and got[1]["team_new"] == 0.0
    assert all(got[5][f] == 0.0 for f in seen.values() if f in got[5])  # the reference level
    assert got[4][seen["c"]] is None and got[4]["team_new"] is None and got[3]["x"] is None
    assert sorted(r.id for r in P.prepare(train, rules, ["id"], training=True).collect()) == [1, 2, 5]
    late = spark.createDataFrame([(9, 7.0, 1.0, 1.0, "unseen", "other", "H")], SCHEMA)
    row = P.prepare(late, rules, ["id"]).first()
    assert row["team_new"] == 1.0 and row[seen["c"]] == 0.0
    with pytest.raises(ValueError, match="kept columns"):
        P.prepare(train, rules, ["x"])


def test_the_pipeline_prepares_alike_after_storing(spark, rules, train, tmp_path):
    fitted = P.prepared_pipeline(rules, {"tree_depth": 1}, trees=1).fit(M.labelled(train).dropna(subset=["x", "team"]))
    M.save_model(fitted, str(tmp_path / "m"))
    rules.write.parquet(str(tmp_path / "rules"))
    late = train.union(spark.createDataFrame([(9, 7.0, 1.0, 1.0, "unseen", "other", "H")], SCHEMA)).dropna(subset=["x", "team"])
    made = P.prepare(late, spark.read.parquet(str(tmp_path / "rules")), ["id"])
    names = [c for c in made.columns if c != "id"]
    want = {r.id: [r[c] for c in names] for r in made.collect()}
    assert list(P.expressions(rules)) == names
    out = M.load_model(str(tmp_path / "m")).transform(late)
    assert {r.id: r.features.toArray().tolist() for r in out.collect()} == want


def test_too_many_levels(spark, monkeypatch):
    monkeypatch.setattr(P, "MAX_LEVELS", 3)
    df = spark.range(4).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="more than 3 levels"):
        P.fit_rules(df, [], ["c"])
