import math
import random

import pytest
from pyspark.sql import functions as F

from matchlab.operators import ordered
from matchlab.operators.ordered import ewma_width, lag_values, lagged_ewma, number_rows, split_hot

ORDER = ["t", "id"]


def rows(n=3000, seed=1, gaps=True):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None])
        x = None if gaps and rng.random() < 0.002 else round(rng.random() * 10, 3)
        y = None if rng.random() < 0.3 else float(rng.randrange(5))
        out.append((key, rng.randrange(50), i, x, y))
    rng.shuffle(out)
    return out


def frame(spark, data):
    return spark.createDataFrame(data, "k string, t int, id int, x double, y double").repartition(5)


def reference(data, lam, nulls, col):
    """Row id -> lagged state, by a plain loop."""
    out = {}
    for key in {r[0] for r in data}:
        state, seen, dead = None, False, False
        for r in sorted((r for r in data if r[0] == key), key=lambda r: (r[1], r[2])):
            out[r[2]] = None if dead else state
            x = r[col]
            if x is None:
                dead = dead or nulls == "poison"
                continue
            state = x if not seen else lam * state + (1 - lam) * x
            seen = True
    return out


@pytest.mark.parametrize("nulls", ["poison", "skip"])
@pytest.mark.parametrize("hot_rows", [10**6, 300])
@pytest.mark.parametrize("lam", [0.5, 0.94])
def test_ewma_equals_loop(spark, nulls, hot_rows, lam):
    data = rows()
    out = lagged_ewma(frame(spark, data), ["k"], ORDER, ["x", "y"], lam, nulls, hot_rows=hot_rows, suffix="_s")
    got = {r.id: (r.x_s, r.y_s) for r in out.collect()}
    assert len(got) == len(data)
    for col, at in ((3, 0), (4, 1)):
        want = reference(data, lam, nulls, col)
        for i, w in want.items():
            g = got[i][at]
            assert (g is None) == (w is None), (i, g, w)
            assert w is None or math.isclose(g, w, rel_tol=1e-11, abs_tol=1e-12)


def test_history_longer_than_a_block_does_not_overflow(spark):
    lam, n = 0.5, 3 * ewma_width(0.5) + 7
    df = spark.range(n).select(F.lit("k").alias("k"), F.col("id").alias("t"), "id", (F.col("id") % 13).alias("x"))
    want, state = [], None
    for i in range(n):
        want.append(state)
        state = float(i % 13) if state is None else lam * state + (1 - lam) * (i % 13)
    for hot_rows in (10**6, 100):
        out = lagged_ewma(df, ["k"], ORDER, ["x"], lam, hot_rows=hot_rows).orderBy("id").collect()
        assert all((r.x is None and w is None) or math.isclose(r.x, w, rel_tol=1e-12) for r, w in zip(out, want))


def test_constant_history_and_no_look_ahead(spark):
    flat = spark.createDataFrame([("k", i, i, 4.0) for i in range(30)], "k string, t int, id int, x double")
    got = [r.x for r in lagged_ewma(flat, ["k"], ORDER, ["x"]).orderBy("id").collect()]
    assert got[0] is None and all(abs(v - 4) < 1e-12 for v in got[1:])
    data = rows(200, gaps=False)
    last = max((r for r in data if r[0] == "hot"), key=lambda r: (r[1], r[2]))
    changed = [(*r[:3], 1e6, r[4]) if r is last else r for r in data]
    a, b = (
        {r.id: r.x for r in lagged_ewma(frame(spark, d), ["k"], ORDER, ["x"]).collect()} for d in (data, changed)
    )
    assert a == b


@pytest.mark.parametrize("hot_rows", [10**6, 300])
def test_numbers_and_lags_equal_loop(spark, hot_rows):
    data = rows(1500)
    df = number_rows(frame(spark, data), ["k"], ORDER, hot_rows=hot_rows)
    df = lag_values(df, ["k"], ORDER, {"before": F.col("x")}, hot_rows=hot_rows, chunk_rows=64)
    got = {r.id: (r._pos, r.before) for r in df.collect()}
    for key in {r[0] for r in data}:
        mine = sorted((r for r in data if r[0] == key), key=lambda r: (r[1], r[2]))
        for i, r in enumerate(mine):
            assert got[r[2]] == (i, mine[i - 1][3] if i else None)


def test_whole_table_ranks_without_a_key(spark):
    df = number_rows(spark.range(1000).select((F.lit(1000) - F.col("id")).alias("v")).repartition(7), [], ["v"])
    assert [r._pos for r in df.orderBy("v").collect()] == list(range(1000))


def test_split_keeps_every_row_and_null_keys(spark):
    data = rows(1000)
    cold, hot = split_hot(frame(spark, data), ["k"], hot_rows=100)
    assert cold is None or cold.count() + hot.count() == 1000
    assert split_hot(frame(spark, data), ["k"], rows_bound=50, hot_rows=100)[1] is None
    assert split_hot(frame(spark, data), ["k"], hot_rows=5000)[1] is None


def test_arguments_are_checked(spark):
    df = frame(spark, rows(5))
    with pytest.raises(ValueError):
        lagged_ewma(df, ["k"], ORDER, ["x"], lam=1.0)
    with pytest.raises(ValueError):
        lagged_ewma(df, ["k"], ORDER, ["x"], nulls="drop")


@pytest.mark.parametrize("batch", ["7", "10000"])
def test_states_of_many_hot_keys_take_no_call_per_key(spark, monkeypatch, batch):
    """Keys of several blocks are composed side by side, whole tasks at a time, also where a batch ends amid a key."""
    from matchlab.operators import ordered

    monkeypatch.setattr(ordered, "ewma_width", lambda lam: 4)
    rng = random.Random(4)
    data = [(f"k{i % 61}" if i % 62 else None, rng.randrange(40), i, float(rng.randrange(9)), None if rng.random() < 0.5 else float(i % 7)) for i in range(1500)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        out = lagged_ewma(frame(spark, data), ["k"], ORDER, ["x", "y"], 0.9, "skip", hot_rows=2, suffix="_s")
        assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().optimizedPlan().toString()
        got = {r.id: (r.x_s, r.y_s) for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for col, at in ((3, 0), (4, 1)):
        for i, w in reference(data, 0.9, "skip", col).items():
            assert (got[i][at] is None) == (w is None) and (w is None or math.isclose(got[i][at], w, rel_tol=1e-11))


def test_past_of_cold_keys_goes_on_from_batch_to_batch(spark):
    """One sorted pass: a batch may end amid a key, and no window sums the columns one by one."""
    data = rows(900)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = lagged_ewma(frame(spark, data), ["k"], ORDER, ["x", "y"], 0.9, hot_rows=10**6, suffix="_s")
        assert "sum(" not in out._jdf.queryExecution().optimizedPlan().toString()
        got = {r.id: (r.x_s, r.y_s) for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for col, at in ((3, 0), (4, 1)):
        for i, w in reference(data, 0.9, "poison", col).items():
            assert (got[i][at] is None) == (w is None) and (w is None or math.isclose(got[i][at], w, rel_tol=1e-11))


def test_hot_rows_are_gone_through_where_they_are_stored(spark):
    """Over several range partitions and gaps: the sequence, without an exchange after the one that sorts."""
    data = [(k, i, None if (k, i) == (1, 70) else float((i * 37 + k) % 11)) for k in (1, 2, 3) for i in range(100 if k < 3 else 1)]
    df = spark.createDataFrame(data, "k long, i long, x double").repartition(5)
    out = ordered._ewma_hot(df, ["k"], ["i"], ["x"], 0.94, 7, "poison").select("k", "i", F.col("_s_x").alias("x"))
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    got, state, gone = {(r.k, r.i): r.x for r in out.collect()}, {}, set()
    for k, i, x in data:
        want = None if k in gone else state.get(k)
        assert got[k, i] == (None if want is None else pytest.approx(want, rel=1e-12))
        gone |= {k} if x is None else set()
        state[k] = x if k not in state else 0.94 * state[k] + 0.06 * (x or 0.0)
