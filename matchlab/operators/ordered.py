"""Ordered per-key work (numbering, lag, exponentially weighted history) that survives hot keys.

A key of ordinary size is one window group: one exchange, one task per group. A key with more than
``hot_rows`` rows is never handed to one task. Its rows are range-partitioned on (key, order), which
splits the key itself, numbered from per-partition counts, and then worked on in groups
(key, position div width) of fixed size whose boundary values are passed on by an equi-join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlab.session import bounded_broadcast, cut

HOT_ROWS = 2_000_000  # rows of one key that a single task may still sort and scan
CHUNK_ROWS = 65_536  # group width on the hot path
BROADCAST_KEYS = 100_000  # hot keys (<= rows / hot_rows) that may be sent to every executor


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which a null key equals a null key; the right key columns are not kept."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & left[k].eqNullSafe(renamed[f"_r_{k}"])
    joined = left.join(renamed, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_r_{k}" for k in keys])


def keyed_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi-join that deals both sides by the first key only, so rows that are dealt by it already stay where they are."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in on})
    cond = left[on[0]] == renamed[f"_r_{on[0]}"]
    for k in on[1:]:  # as two bounds, for an equality would be dealt by
        cond = cond & (left[k] >= renamed[f"_r_{k}"]) & (left[k] <= renamed[f"_r_{k}"])
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in on])


def find_hot_keys(df: DataFrame, key: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Stored table of the keys with more than ``hot_rows`` rows (at most rows / hot_rows), if any."""
    hot = cut(df.groupBy(*key).count().filter(F.col("count") > hot_rows).select(*key))
    return None if hot.isEmpty() else hot


def split_hot(
    df: DataFrame,
    key: Sequence[str],
    rows_bound: int | None = None,
    hot_rows: int = HOT_ROWS,
    hot_keys: DataFrame | None = None,
) -> tuple[DataFrame | None, DataFrame | None]:
    """(ordinary rows, rows of hot keys); either may be None.

    ``rows_bound`` is any upper bound of the rows per key the caller knows (for instance the row count
    in the parquet footers): when it is small enough nothing is counted. ``hot_keys`` is a known table
    of hot keys over some of the key columns; rows of a key that is not hot may go either way.
    """
    if not key:
        return None, df
    if hot_keys is None:
        if rows_bound is not None and rows_bound <= hot_rows:
            return df, None
        hot_keys = find_hot_keys(df, key, hot_rows)
        if hot_keys is None:
            return df, None
    side = bounded_broadcast(hot_keys, BROADCAST_KEYS)
    by = hot_keys.columns
    return null_safe_join(df, side, by, "left_anti"), null_safe_join(df, side, by, "left_semi")


def scale_for(df: DataFrame, key: Sequence[str], scale: dict) -> dict:
    """Scale arguments for several steps on the same key: the keys are counted once."""
    hot_rows = scale.get("hot_rows", HOT_ROWS)
    if "hot_keys" in scale or scale.get("rows_bound", hot_rows + 1) <= hot_rows:
        return scale
    hot_keys = find_hot_keys(df, key, hot_rows)
    return {"rows_bound": 0} if hot_keys is None else {"hot_rows": hot_rows, "hot_keys": hot_keys}


def _both(cold: DataFrame | None, hot: DataFrame | None) -> DataFrame:
    if hot is None:
        return cold
    return hot if cold is None else cold.unionByName(hot)


def _ranged(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Stored rows sorted by (_hk, order) over range partitions, with ``_part`` and the running number ``_seq`` in it."""
    sort = [F.col("_hk")] + [F.col(o) if isinstance(o, str) else o for o in order]
    # The range bounds come from a sample, so the numbered rows are written once and never redrawn.
    return cut(
        df.withColumn("_hk", F.struct(*key) if key else F.lit(0))
        .repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumn("_seq", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_seq", 33))


def _number_hot(df: DataFrame, key: Sequence[str], order: Sequence[Column | str], out: str) -> DataFrame:
    """Rows with ``_hk``, the key as one never-null column, and their position within it.

    All that follows groups, windows and joins on _hk, so one exchange serves several steps.
    """
    ranged = _ranged(df, key, order)
    by = ["_hk", "_part"]
    runs = ranged.groupBy(*by).agg(F.min("_seq").alias("_start"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_hk").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_start")).alias("_shift")
    # One row per key and partition it touches: at most (hot keys + partitions) rows.
    runs = bounded_broadcast(cut(runs.select(*by, shift)), BROADCAST_KEYS)
    return ranged.join(runs, by).withColumn(out, F.col("_seq") + F.col("_shift")).drop("_seq", "_shift", "_part")


def number_rows(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[Column | str],
    out: str = "_pos",
    rows_bound: int | None = None,
    hot_rows: int = HOT_ROWS,
    hot_keys: DataFrame | None = None,
) -> DataFrame:
    """Zero-based position of each row within its key; ``order`` must be a total order."""
    cold, hot = split_hot(df, key, rows_bound, hot_rows, hot_keys)
    if cold is not None:
        w = Window.partitionBy(*key).orderBy(*order)
        cold = cold.withColumn(out, F.row_number().over(w).cast("long") - 1)
    if hot is not None:
        hot = _number_hot(hot, key, order, out).drop("_hk")
    return _both(cold, hot)


def lag_values(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[Column | str],
    values: dict[str, Column],
    rows_bound: int | None = None,
    hot_rows: int = HOT_ROWS,
    hot_keys: DataFrame | None = None,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Add, per name in ``values``, that expression's value in the previous row of the key."""
    cold, hot = split_hot(df, key, rows_bound, hot_rows, hot_keys)
    if cold is not None:
        w = Window.partitionBy(*key).orderBy(*order)
        cold = cold.withColumns({name: F.lag(v).over(w) for name, v in values.items()})
    if hot is not None:
        rows = (
            _number_hot(hot, key, order, "_ix")
            .withColumn("_chunk", F.floor(F.col("_ix") / chunk_rows))
            .withColumn("_now", F.struct(*[v.alias(name) for name, v in values.items()]))
        )
        by = ["_hk", "_chunk"]
        ends = rows.filter(F.col("_ix") % chunk_rows == chunk_rows - 1).select(
            "_hk", (F.col("_chunk") + 1).alias("_chunk"), F.col("_now").alias("_carry")
        )
        inside = F.lag("_now").over(Window.partitionBy(*by).orderBy("_ix"))
        rows = rows.withColumn("_prev", inside).join(ends, by, "left")
        prev = F.when(F.col("_ix") % chunk_rows == 0, F.col("_carry")).otherwise(F.col("_prev"))
        hot = (
            rows.withColumn("_prev", prev)
            .withColumns({name: F.col(f"_prev.{name}") for name in values})
            .drop("_ix", "_chunk", "_now", "_carry", "_prev", "_hk")
        )
    return _both(cold, hot)


def ewma_width(lam: float) -> int:
    """Rows per block: small enough for lam**-rows to stay finite, wide enough that lam**rows is nil."""
    return max(2, int(300 / -math.log(lam)))


# Wide column lists are written as SQL expressions: one short call per column when the plan is built.

_BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def _names(cols: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in cols)


def _groups(fresh):
    """Where the groups of a run of rows begin, their sizes, and whether the first goes on from the run before."""
    at = np.flatnonzero(fresh)
    inside = len(fresh) > 0 and not fresh[0]
    at = np.concatenate([[0], at]) if inside else at
    return at, np.diff(np.append(at, len(fresh))), inside


def _steps(at, size):
    """(groups, their rows) step by step: first rows of all groups, then second rows, and so on."""
    by_size = np.argsort(-size, kind="stable")
    active = len(size) - np.searchsorted(np.sort(size), np.arange(size.max(initial=0)), side="right")
    for i, n in enumerate(active):
        yield by_size[:n], at[by_size[:n]] + i


def _past(x, gap, fresh, lam, carry):
    """Poisoned form: states before each row of a run of keys, which of them are null, and what the next run goes on from."""
    at, size, inside = _groups(fresh)
    state, dead, begun = np.zeros((len(at), x.shape[1])), np.zeros((len(at), x.shape[1]), bool), np.zeros((len(at), 1), bool)
    if inside:
        state[0], dead[0], begun[0] = carry
    out, null = np.zeros(x.shape), np.zeros(x.shape, bool)
    for g, row in _steps(at, size):
        now, old, new = state[g], begun[g], x[row]
        out[row], null[row] = now, dead[g] | ~old
        state[g] = np.where(old, lam * now + (1.0 - lam) * new, new)
        dead[g] |= gap[row]
        begun[g] = True
    return out, null, (state[-1], dead[-1], begun[-1]) if len(at) else carry


def _ewma_cold(df, key, order, cols, lam, width, nulls):
    w_key = Window.partitionBy(*key).orderBy(*order)
    rows = df.withColumn("_ix", F.row_number().over(w_key).cast("long") - 1)
    if nulls == "skip":
        return _ewma_skip(rows, key, cols, lam, width).drop("_ix")

    # The rows arrive as the window leaves them, key after key in order, so a task goes through them batch by batch.
    def past(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        carry = None
        for b in batches:
            ix, *values = b.flatten()
            x = np.column_stack([v.fill_null(0.0).to_numpy(zero_copy_only=False) for v in values])
            gap = np.column_stack([v.is_null().to_numpy(zero_copy_only=False) for v in values])
            out, null, carry = _past(x, gap, ix.to_numpy() == 0, lam, carry)
            yield pa.StructArray.from_arrays([pa.array(out[:, i], mask=null[:, i]) for i in range(len(cols))], names=[f"c{i}" for i in range(len(cols))])

    states = F.arrow_udf(past, ", ".join(f"c{i} double" for i in range(len(cols)))).asNondeterministic()
    rows = rows.withColumn("_past", states(F.struct("_ix", *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)])))
    return rows.selectExpr("*", *[f"_past.c{i} AS `_s_{c}`" for i, c in enumerate(cols)]).drop("_ix", "_past")


# Null-skipping form as a scan. A value x turns the state S into lam * S + (1 - lam) * x and a null leaves it, so a run of
# rows is one affine map S -> lam**n * S + b, and runs compose. The first value f of a key is its state before that value.


def _ewma_skip(rows, key, cols, lam, width):
    """Lagged state from positions _ix, for any number of columns by one pair of windows, one aggregation and one join.

    Blocks of ``width`` rows of a key are summed up as (n, f, b) of all columns; the states at their starts are composed
    (_carried) and joined back once. A key within one block needs none.
    """
    by = [*key, "_blk"]
    over = f"(PARTITION BY {_names(by)} ORDER BY _ix {_BEFORE})"
    lit = f"{lam!r}D"
    rows = rows.withColumn("_blk", F.floor(F.col("_ix") / width))
    rows = rows.selectExpr(
        "*",
        *[f"count(`{c}`) OVER {over} AS `_n_{c}`" for c in cols],
        *[f"first_value(`{c}`) IGNORE NULLS OVER {over} AS `_f_{c}`" for c in cols],
    )
    rows = rows.selectExpr("*", *[f"`{c}` * (1D - {lit}) * pow({lit}, -(`_n_{c}` + 1)) AS `_t_{c}`" for c in cols])
    rows = rows.selectExpr("*", *[f"coalesce(sum(`_t_{c}`) OVER {over}, 0D) AS `_b_{c}`" for c in cols])
    hot = list(key) == ["_hk"]
    if hot:
        rows = cut(rows)  # read twice
    blocks = rows.groupBy(*by).agg(
        F.expr(f"array({', '.join(f'count(`{c}`)' for c in cols)}) AS n"),
        F.expr(f"array({', '.join(f'coalesce(min_by(`{c}`, _ix) FILTER (WHERE `{c}` IS NOT NULL), 0D)' for c in cols)}) AS f"),
        F.expr(f"array({', '.join(f'coalesce(sum(`_t_{c}`), 0D) * pow({lit}, count(`{c}`))' for c in cols)}) AS b"),
    )
    if hot:
        carried = _carried(blocks, key, lam).selectExpr(*by, *[f"IF(_known[{i}], _state[{i}], NULL) AS `_c_{c}`" for i, c in enumerate(cols)])
    else:  # at most hot_rows / width blocks of a key are in a list
        past = f"collect_list(struct(n, f, b)) OVER (PARTITION BY {_names(key)} ORDER BY _blk {_BEFORE}) AS past"
        step = "(s, x) -> IF(x.n[{i}] > 0, pow({lit}, x.n[{i}]) * coalesce(s, x.f[{i}]) + x.b[{i}], s)"
        start = [f"aggregate(past, CAST(NULL AS DOUBLE), {step.format(i=i, lit=lit)}) AS `_c_{c}`" for i, c in enumerate(cols)]
        carried = blocks.selectExpr(*by, "n", "f", "b", past).filter("_blk > 0").selectExpr(*by, *start)
    rows = null_safe_join(rows, carried, by, "left")
    state = [f"pow({lit}, `_n_{c}`) * (coalesce(`_c_{c}`, `_f_{c}`) + `_b_{c}`) AS `_s_{c}`" for c in cols]
    return rows.selectExpr("*", *state).drop("_blk", *[f"_{p}_{c}" for c in cols for p in "cnftb"])


def _compose(n, f, b, lam, known=None, state=None):
    """States before each of the blocks, in order, and after the last: (known, state), one more row than blocks."""
    held, now = np.zeros((len(n) + 1, n.shape[1]), bool), np.zeros((len(n) + 1, n.shape[1]))
    if known is not None:
        held[0], now[0] = known, state
    for i in range(len(n)):
        start = np.where(held[i], now[i], f[i])
        held[i + 1] = held[i] | (n[i] > 0)
        now[i + 1] = np.where(n[i] > 0, lam ** n[i].astype(float) * start + b[i], now[i])
    return held, now


def _arrays(pdf):
    return (np.vstack(pdf[c].to_numpy()) for c in ("n", "f", "b"))


def _states_before(n, f, b, lam, fresh, held, now, carry):
    """States before each block of a run of groups, all groups side by side, and the state after the last block.

    fresh: blocks that open a group, whose state is in that row of (held, now); a run that opens amid a group goes on from carry.
    """
    at, size, inside = _groups(fresh)
    known, state = held[at], now[at]
    if inside:
        known[0], state[0] = carry
    held, now = held.copy(), now.copy()
    for g, row in _steps(at, size):
        held[row], now[row] = known[g], state[g]
        has = n[row] > 0
        state[g] = np.where(has, lam ** n[row].astype(float) * np.where(known[g], state[g], f[row]) + b[row], state[g])
        known[g] |= has
    return held, now, (known[-1].copy(), state[-1].copy()) if len(at) else carry


def _scan(blocks: DataFrame, key: Sequence[str], lam: float, chunk: int) -> DataFrame:
    """key, _blk, _known and _state before each block. Groups are (key, _blk div chunk) and open with _known and _state, or unknown.

    A task goes through its sorted groups batch by batch: no work per group, and none is held whole.
    """
    kinds = ", ".join(f"`{k}` {blocks.schema[k].dataType.simpleString()}" for k in key)
    opened = "_known" in blocks.columns

    def read(batches):
        carry = None
        for x in batches:
            wide = lambda c, x=x: x.column(c).flatten().to_numpy(zero_copy_only=False).reshape(x.num_rows, -1)
            blk, n, f, b = x.column("_blk"), wide("n"), wide("f"), wide("b")
            held, now = (wide("_known"), wide("_state")) if opened else (np.zeros(n.shape, bool), np.zeros(n.shape))
            held, now, carry = _states_before(n, f, b, lam, blk.to_numpy() % chunk == 0, held, now, carry)
            ends = pa.array(np.arange(x.num_rows + 1) * n.shape[1], pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(v.ravel())) for v in (held, now)]
            yield pa.RecordBatch.from_arrays([*(x.column(k) for k in key), blk, *lists], names=[*key, "_blk", "_known", "_state"])

    blocks = blocks.select(*key, "_blk", F.floor(F.col("_blk") / chunk).alias("_up"), "n", "f", "b", *(["_known", "_state"] if opened else []))
    rows = blocks.repartition(*key, "_up").sortWithinPartitions(*key, "_blk")
    return rows.drop("_up").mapInArrow(read, f"{kinds}, _blk long, _known array<boolean>, _state array<double>")


def _carried(blocks: DataFrame, key: Sequence[str], lam: float, chunk: int = CHUNK_ROWS) -> DataFrame:
    """key, _blk, _known and _state before each block; more than ``chunk`` blocks of a key are composed chunk by chunk first."""
    kinds = ", ".join(f"`{k}` {blocks.schema[k].dataType.simpleString()}" for k in key)
    blocks = cut(blocks.withColumn("_up", F.floor(F.col("_blk") / chunk)))
    if (blocks.agg(F.max("_up")).first()[0] or 0) == 0:
        return _scan(blocks, key, lam, chunk)

    def whole(names, pdf):
        """A chunk as one block: its own first values, and the sum that the states leave when these count as zero."""
        n, f, b = _arrays(pdf.sort_values("_blk"))
        zero = np.zeros(n.shape[1])
        _, now = _compose(n, f, b, lam, zero == 0, zero)
        first = np.array([f[np.flatnonzero(n[:, c])[0], c] if n[:, c].any() else 0.0 for c in range(n.shape[1])])
        return pd.DataFrame({**{k: [v] for k, v in zip(key, _plain(names))}, "_blk": [names[-1]], "n": [n.sum(axis=0)], "f": [first], "b": [now[-1]]})

    chunks = blocks.groupBy(*key, "_up").applyInPandas(whole, f"{kinds}, _blk long, n array<long>, f array<double>, b array<double>")
    above = _carried(cut(chunks), key, lam, chunk)
    return _scan(blocks.join(above.withColumnRenamed("_blk", "_up"), [*key, "_up"]), key, lam, chunk)


def _plain(names: tuple) -> list:
    """Group names as values that pandas hands back: a struct arrives as a dict or row."""
    return [n.asDict(True) if hasattr(n, "asDict") else n for n in names]


def _long_past(x, lam, width, known, state):
    """States before each row of one run of a key, and after it; ``known``: rows of the key came before and left ``state``."""
    out = np.empty(x.shape)
    for i in range(0, len(x), width):
        v = x[i : i + width]
        j = np.arange(len(v), dtype=float)[:, None]
        w = np.full((len(v), 1), 1.0 - lam) * lam**-j  # relative to the first row: finite within a width
        if not known:
            state, w[0] = np.zeros(x.shape[1]), 1.0
        sums = np.cumsum(w * v, axis=0)
        out[i : i + width] = lam**j * state
        out[i + 1 : i + width] += lam ** (j[1:] - 1.0) * sums[:-1]
        state = lam ** float(len(v)) * state + lam ** float(len(v) - 1) * sums[-1]
        known = True
    return out, state


def _ewma_hot(df, key, order, cols, lam, width, nulls):
    if nulls == "skip":
        return _ewma_skip(_number_hot(df, key, order, "_ix"), ["_hk"], cols, lam, width).drop("_ix", "_hk")

    # A run is what a range partition holds of a key. Its rows leave lam**n times the state that they found, plus a weighted sum, and
    # runs compose; so the stored rows are summed up run by run and then gone through once where they are, without another exchange.
    rows, by, n = _ranged(df, key, order), ["_hk", "_part"], len(cols)
    ends = rows.groupBy(*by).agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_n"))
    ends = cut(ends)  # at most (hot keys + partitions) rows
    apart = ends.count() > BROADCAST_KEYS
    ends = ends if apart else F.broadcast(ends)
    at = "(_n - 1 - (_seq - _first))"
    runs = (
        rows.join(ends, by)
        .groupBy(*by, "_n")
        .agg(
            F.expr(f"array({', '.join(f'max(CASE WHEN _seq = _first THEN `{c}` END)' for c in cols)}) AS f"),
            F.expr(f"array({', '.join(f'coalesce(sum(`{c}` * {1.0 - lam!r}D * pow({lam!r}D, {at})), 0D)' for c in cols)}) AS b"),
            F.expr(f"array({', '.join(f'max(`{c}` IS NULL)' for c in cols)}) AS gap"),
        )
    )
    past = f"collect_list(struct(_n AS n, f, b, gap)) OVER (PARTITION BY _hk ORDER BY _part {_BEFORE}) AS past"
    # the first value of a key is the state that the rest of its first run, and itself, were weighted against
    step = "(s, x) -> pow({lam}, x.n) * coalesce(s, x.f[{i}]) + x.b[{i}]"
    step = step.replace("{lam}", f"{lam!r}D")
    opened = [f"aggregate(past, CAST(NULL AS DOUBLE), {step.format(i=i)})" for i in range(n)]
    dead = [f"exists(past, x -> x.gap[{i}])" for i in range(n)]
    runs = runs.selectExpr(*by, past).selectExpr(*by, "size(past) > 0 AS _known", f"array({', '.join(opened)}) AS _state", f"array({', '.join(dead)}) AS _dead")
    runs = cut(runs) if apart else F.broadcast(cut(runs))

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        carry = None
        for batch in batches:
            seq, first, known, state, dead, *values = batch.flatten()
            x = np.column_stack([v.fill_null(0.0).to_numpy(zero_copy_only=False) for v in values])
            gap = np.column_stack([v.is_null().to_numpy(zero_copy_only=False) for v in values])
            start = np.flatnonzero(seq.to_numpy() == first.to_numpy()).tolist()
            out, null = np.empty(x.shape), np.empty(x.shape, bool)
            cuts = sorted({0, *start, len(x)})
            for i, j in zip(cuts[:-1], cuts[1:]):
                if i in start:
                    opening = np.array([v or 0.0 for v in state[i].as_py()])
                    carry = known[i].as_py(), opening, np.array(dead[i].as_py(), bool)
                was, opening, gone = carry
                out[i:j], closing = _long_past(x[i:j], lam, width, was, opening)
                # a state is null from the row after a missing value on
                seen = np.logical_or.accumulate(gap[i:j], axis=0)
                null[i:j] = gone
                null[i + 1 : j] |= seen[:-1]
                if not was:
                    null[i] = True
                carry = True, closing, gone | seen[-1]
            yield pa.StructArray.from_arrays([pa.array(out[:, i], mask=null[:, i]) for i in range(n)], names=[f"c{i}" for i in range(n)])

    states = F.arrow_udf(scan, ", ".join(f"c{i} double" for i in range(n))).asNondeterministic()
    rows = rows.join(ends.drop("_n"), by).join(runs, by)
    rows = rows.sortWithinPartitions("_seq") if apart else rows
    rows = rows.withColumn("_past", states(F.struct("_seq", "_first", "_known", "_state", "_dead", *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(cols)])))
    rows = rows.selectExpr("*", *[f"_past.c{i} AS `_s_{c}`" for i, c in enumerate(cols)])
    return rows.drop("_hk", "_part", "_seq", "_first", "_known", "_state", "_dead", "_past")


def lagged_ewma(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[Column | str],
    cols: Sequence[str],
    lam: float = 0.94,
    nulls: str = "poison",
    rows_bound: int | None = None,
    hot_rows: int = HOT_ROWS,
    hot_keys: DataFrame | None = None,
    suffix: str = "",
) -> DataFrame:
    """Replace each column (or add ``<col><suffix>``) by its exponentially weighted past.

    S(1) = x(1), S(i) = lam * S(i-1) + (1 - lam) * x(i); a row receives S of the rows before it, so
    the first row of a key is null. ``nulls="poison"``: a null makes every later state null;
    ``"skip"``: nulls are passed over.
    """
    if not 0.0 < lam < 1.0:
        raise ValueError("lam must lie strictly between 0 and 1")
    if nulls not in ("poison", "skip"):
        raise ValueError("nulls must be 'poison' or 'skip'")
    width = ewma_width(lam)
    doubles = {c: f"CAST(`{c}` AS DOUBLE) AS `{c}`" for c in cols}
    df = df.selectExpr(*[doubles.get(c, f"`{c}`") for c in df.columns])
    cold, hot = split_hot(df, key, rows_bound, hot_rows, hot_keys)
    if cold is not None:
        cold = _ewma_cold(cold, key, order, cols, lam, width, nulls)
    if hot is not None:
        hot = _ewma_hot(hot, key, order, cols, lam, width, nulls)
    out = _both(cold, hot)
    named = {f"{c}{suffix}": f"`_s_{c}` AS `{c}{suffix}`" for c in cols}
    kept = [c for c in out.columns if c not in {f"_s_{c}" for c in cols}]
    added = [named[n] for n in named if n not in kept]
    return out.selectExpr(*[named.get(c, f"`{c}`") for c in kept], *added)


def carried_ewma(
    rows: DataFrame,
    state: DataFrame | None,
    key: Sequence[str],
    order: Sequence[Column | str],
    cols: Sequence[str],
    lam: float = 0.94,
    nulls: str = "poison",
    **scale,
) -> tuple[DataFrame, DataFrame]:
    """(rows with their exponentially weighted past, state after them) where ``state`` holds what came before.

    The state has one row per key with the columns as they stand after the last row: it goes before the new rows like a
    first value, and a row without values behind them reads off the next state. A null state means a poisoned column, or no value
    yet where nulls are passed over; both go on as such. Keys without new rows keep their state. All is stored once.
    """
    typed = {c: f"CAST(`{c}` AS DOUBLE) AS `{c}`" for c in cols}
    real = rows.selectExpr(*[typed.get(c, f"`{c}`") for c in rows.columns]).withColumn("_turn", F.lit(1))
    ends = real.select(*key) if state is None else real.select(*key).unionByName(state.select(*key))
    parts = [real, ends.distinct().withColumn("_turn", F.lit(2))]
    if state is not None:
        parts.append(state.select(*key, *cols).withColumn("_turn", F.lit(0)))
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p, allowMissingColumns=True)
    if "rows_bound" in scale:
        scale = {**scale, "rows_bound": scale["rows_bound"] + 2}
    out = cut(lagged_ewma(whole, key, ["_turn", *order], cols, lam, nulls, **scale))
    return out.filter("_turn = 1").drop("_turn"), out.filter("_turn = 2").select(*key, *cols)
