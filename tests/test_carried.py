"""Features continued from stored state equal those of one pass, also after corrections."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlab.functions.fixed_values import LONG_RUN_K
from matchlab.operators import ordered
from matchlab.operators.ordered import carried_ewma, lagged_ewma
from matchlab.plans import carried
from matchlab.sources import commerce
from matchlab.sources import versions as V
from suite import queries

STATS = ["score", "set_restarts"]
KS = LONG_RUN_K
SCHEMA = (
    T.StructType().add("competition_id", "long").add("match_id", "long").add("team_name", "string").add("team_location", "string")
    .add("date", "date").add("score", "double").add("set_restarts", "double").add("season", "integer")
)


def games(n=60, teams=6, seed=5):
    rng = random.Random(seed)
    out = []
    for m in range(n):
        h, a = rng.sample(range(teams), 2)
        day = dt.date(2020, 12, 1) + dt.timedelta(days=2 * (m // 2))
        for side, t in (("home", h), ("away", a)):
            out.append((1, m, f"t{t}", side, day, None if m > n - 3 else float(rng.randrange(30)), None if rng.random() < 0.02 else float(rng.randrange(9)), day.year))
    return out


def near(a, b):
    return (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-9) if isinstance(a, float) else a == b)


def rows_of(df):
    names = ["match_id", "team_name", "date", "days_rest", *STATS, "result", *sorted(c for c in df.columns if "elo" in c or "pr" in c)]
    return {(r.match_id, r.team_name): [r[c] for c in names] for r in df.collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for k, w in want.items():
        assert all(near(x, y) for x, y in zip(got[k], w)), (k, got[k], w)


def test_continued_equals_one_pass(spark):
    tm = spark.createDataFrame(games(), SCHEMA)
    whole, last = carried.continue_teams(tm, None, KS, cols=STATS)
    state, got = None, {}
    edges = [dt.date(2020, 1, 1), dt.date(2020, 12, 20), dt.date(2020, 12, 21), dt.date(2022, 1, 1)]
    for low, high in zip(edges, edges[1:]):
        rows, state = carried.continue_teams(tm.filter((F.col("date") >= F.lit(low)) & (F.col("date") < F.lit(high))), state, KS, cols=STATS)
        got |= rows_of(rows)
    same(got, rows_of(whole))
    for a, b in ((state.form, last.form), (state.last, last.last), (state.ratings, last.ratings)):
        key = ["team" if "team" in a.columns else "team_name"]
        one, two = ({r[key[0]]: r.asDict() for r in df.collect()} for df in (a, b))
        assert one.keys() == two.keys()
        for k in one:
            for c in one[k]:
                x, y = one[k][c], two[k][c]
                assert x == y or x == pytest.approx(y, rel=1e-9)


def test_corrections_rebuild_only_later_rows(spark, tmp_path, monkeypatch):
    root, table = str(tmp_path), str(tmp_path / "tables/team_match")
    data = games()
    tm = spark.createDataFrame(data, SCHEMA)
    V.merge(spark, table, SCHEMA, V.with_source(tm, F.lit("2024-01-01")), ["match_id", "team_name"])
    run = lambda d: carried.refresh(spark, root, SCHEMA, d, KS, cols=STATS)
    weeks = [dt.date(2020, 12, 15), dt.date(2020, 12, 29), dt.date(2021, 1, 20)]
    assert [run(d) for d in weeks] == [None, weeks[0], weeks[1]]
    features = lambda: rows_of(V.read(spark, f"{root}/tables/team_features", stored))
    stored = carried.continue_teams(tm, None, KS, cols=STATS)[0].schema

    def whole():
        now = V.read(spark, table, SCHEMA).filter(F.col("date") < F.lit(weeks[-1]))
        return rows_of(carried.continue_teams(now, None, KS, cols=STATS)[0])

    same(features(), whole())
    assert run(weeks[-1]) == weeks[-1]  # nothing new
    fixed = tm.filter("match_id = 25").withColumn("score", F.col("score") + 40)
    assert weeks[0] <= fixed.first()["date"] < weeks[1]
    V.merge(spark, table, SCHEMA, V.with_source(fixed, F.lit("2024-02-01")), ["match_id", "team_name"])
    replace = V.replace

    def crash(spark, table, *a, **k):
        if table.endswith("snapshots"):
            raise RuntimeError("driver lost")
        return replace(spark, table, *a, **k)

    with monkeypatch.context() as m:
        m.setattr(carried.V, "replace", crash)
        with pytest.raises(RuntimeError, match="driver lost"):
            run(weeks[-1])
    assert run(weeks[-1]) == weeks[0]
    same(features(), whole())
    assert [r.through for r in V.read(spark, f"{root}/state/snapshots", carried.SNAPSHOTS).orderBy("through").collect()] == [weeks[0], weeks[-1]]


@pytest.mark.parametrize("nulls,hot_rows", [("poison", 40), ("skip", 10**6), ("skip", 40)])
def test_carried_form_equals_one_pass(spark, nulls, hot_rows):
    rng = random.Random(8)
    data = [(rng.choice(["hot", "hot", "a", None]), t, None if rng.random() < 0.1 else rng.random(), None if t < 70 or rng.random() < 0.5 else rng.random()) for t in range(300)]
    df = spark.createDataFrame(data, "k string, t int, x double, y double")
    want = {r.t: (r.x, r.y) for r in lagged_ewma(df, ["k"], ["t"], ["x", "y"], 0.5, nulls).collect()}
    state, got = None, {}
    for low, high in ((0, 50), (50, 51), (51, 300)):
        rows, state = carried_ewma(df.filter(F.col("t").between(low, high - 1)), state, ["k"], ["t"], ["x", "y"], 0.5, nulls, hot_rows=hot_rows)
        got |= {r.t: (r.x, r.y) for r in rows.collect()}
    assert got.keys() == want.keys()
    for t, w in want.items():
        assert all(near(a, b) for a, b in zip(got[t], w)), (t, got[t], w)


@pytest.mark.parametrize("hot_rows", [10**6, 100])
@pytest.mark.parametrize("chunk", [2, 65_536])
def test_sparse_values_reach_over_many_blocks(spark, hot_rows, chunk, monkeypatch):
    """A value every few hundred rows: blocks of 432 rows hold one or none, and what is older still counts."""
    rng = random.Random(2)
    n = 6000
    data = [("k" if i % 50 else "other", i, rng.random() if rng.random() < 0.004 else None, rng.random() if 2000 < i < 2010 else None) for i in range(n)]
    carried_ = ordered._carried
    monkeypatch.setattr(ordered, "_carried", lambda blocks, key, lam, c=chunk: carried_(blocks, key, lam, c))
    df = spark.createDataFrame(data, "k string, t int, x double, y double").repartition(3)
    got = {r.t: (r.x, r.y) for r in lagged_ewma(df, ["k"], ["t"], ["x", "y"], 0.5, "skip", hot_rows=hot_rows).collect()}
    for at in (0, 1):
        state = {}
        for k, t, *v in data:
            assert near(got[t][at], state.get(k))
            if v[at] is not None:
                state[k] = v[at] if k not in state else 0.5 * state[k] + 0.5 * v[at]


def test_exchanges_do_not_grow_with_the_columns(spark):
    counts = set()
    for n in (1, 18):
        cols = [f"c{i}" for i in range(n)]
        df = spark.range(100).selectExpr("id % 3 AS k", "id AS t", *[f"CAST(id AS DOUBLE) AS {c}" for c in cols])
        plan = lagged_ewma(df, ["k"], ["t"], cols, 0.9, "skip", rows_bound=100)._jdf.queryExecution().executedPlan().toString()
        counts.add((plan.count("Exchange hashpartitioning"), plan.count("Sort ["), plan.count("Join")))
    assert len(counts) == 1


def test_spans_read_their_rows_once(spark, sf):
    tm, read = commerce.team_match(spark, sf), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    rows = tm.mapInArrow(counted, tm.schema)
    assert queries._continued(rows, carried.carried_rest).count() == read.value == tm.count()
