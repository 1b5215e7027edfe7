"""Temperature mixing of sources, realised as permutations of blocks."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlab.llm.storage import store
from matchlab.session import bounded_broadcast

#: Blocks of a source: the unit that a partial epoch takes or leaves.
BLOCKS = 256
#: Points per round of the search for the exponent.
POINTS = 15


def _number(text: Column) -> Column:
    """The first 8 hexadecimal digits of a text's MD5."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _placed(docs: DataFrame, source_col: str, text_col: str, id_col: str, seed: int) -> DataFrame:
    """docs with __src (the source with null apart) and __block, a hash of the id, or of the text where the id is null."""
    name = F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    return docs.withColumns(
        {
            "__src": F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("")),
            "__block": _number(F.concat_ws("|", F.lit(str(seed)), name)) % BLOCKS,
        }
    )


def sized_rows(docs: DataFrame, source_col: str, text_col: str, id_col: str, seed: int, keep: list[str] | None = None) -> DataFrame:
    """__src, __tokens (white-space words), __block, and the columns in `keep` as __k0, __k1, ...; a stored table without texts."""
    tokens = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    placed = _placed(docs, source_col, text_col, id_col, seed)
    return store(placed.select("__src", tokens.alias("__tokens"), "__block", *(F.col(c).alias(f"__k{i}") for i, c in enumerate(keep or []))), "sized")


def _search(sources: DataFrame, goal: Callable[[float, float, float, float], bool], lo: float, hi: float) -> float:
    """The smallest exponent in [lo, hi] that meets a monotone goal(Z, S, M, a): Z = sum p**a, S = sum p**a ln p, M = max p**(a - 1).

    Each round evaluates evenly spaced exponents in one aggregation over the sources and keeps the interval in which the goal
    changes, until it is as narrow as a double allows. Only the sums reach the driver.
    """
    while hi - lo > 1e-13 * max(1.0, hi):
        grid = [lo + (hi - lo) * k / (POINTS + 1) for k in range(1, POINTS + 1)]
        power = [F.exp(F.lit(a) * F.col("lnp")) for a in grid]
        row = sources.agg(
            *(F.sum(x).alias(f"z{k}") for k, x in enumerate(power)),
            *(F.sum(x * F.col("lnp")).alias(f"s{k}") for k, x in enumerate(power)),
            *(F.max(F.exp(F.lit(a - 1) * F.col("lnp"))).alias(f"m{k}") for k, a in enumerate(grid)),
        ).first()
        met = [goal(row[f"z{k}"], row[f"s{k}"], row[f"m{k}"], a) for k, a in enumerate(grid)]
        first = met.index(True) if True in met else POINTS
        bounds = [lo, *grid, hi]
        lo, hi = bounds[first], bounds[first + 1]
    return hi


def mixture(blocks: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None, budget_tokens: int | None = None, cover: bool = False) -> DataFrame:
    """Per source: src, tokens, weight and epochs (how often its tokens are used on average). blocks: src, block, tokens.

    Weights are token shares to the power a, normalised. With target_entropy (nats), a is the largest exponent in [0, 16] whose
    weights have at least that entropy; with max_repeats, the smallest in [0, 1] at which no source is used more often
    than that. The budget is budget_tokens (all tokens by default); with cover it is the least that uses every source once.
    Sources without tokens have weight and epochs 0 (1 with cover).
    """
    sources = store(blocks.groupBy("src").agg(F.sum("tokens").alias("tokens")), "sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    if not total:
        return sources.select("src", "tokens", F.lit(0.0).alias("weight"), F.lit(1.0 if cover else 0.0).alias("epochs"))
    shares = store(sources.where("tokens > 0").select((F.log(F.col("tokens") / F.lit(total))).alias("lnp")), "shares")
    ratio = (budget_tokens if budget_tokens is not None else total) / total
    low, top = shares.agg(F.min("lnp"), F.max("lnp")).first()
    once = lambda a: math.exp((a - 1) * (top if a <= 1 else low))  # noqa: E731  p**(a - 1) of the source that is used least
    if target_entropy is not None:
        # entropy falls with a: the goal is to have fallen below the target
        a = _search(shares, lambda z, s, m, a: math.log(z) - a * s / z < target_entropy, 0.0, 16.0)
    elif max_repeats is not None:
        a = _search(shares, lambda z, s, m, a: m / (once(a) if cover else z / ratio) <= max_repeats, 0.0, 1.0)
    else:
        a = 1.0
    z = shares.agg(F.sum(F.exp(F.lit(a) * F.col("lnp")))).first()[0]
    lnp = F.log(F.col("tokens") / F.lit(total))
    weight = F.when(F.col("tokens") > 0, F.exp(F.lit(a) * lnp) / F.lit(z)).otherwise(0.0)
    used = F.exp(F.lit(a - 1) * lnp) / F.lit(once(a) if cover else z / ratio)
    return sources.select("src", "tokens", weight.alias("weight"), F.when(F.col("tokens") > 0, used).otherwise(1.0 if cover else 0.0).alias("epochs"))


def schedule(blocks: DataFrame, mix: DataFrame, seed: int) -> DataFrame:
    """src, block, epoch, rank: in which epochs a block is used and at which place of the epoch's permutation.

    Whole epochs use every block in an order of their own. The last, partial epoch takes blocks in its order while they come nearer to the
    source's share of the budget, so a source misses it by at most half a block.
    """
    whole = F.floor(F.col("epochs") + 1e-9).cast("int")
    held = blocks.join(mix.select("src", "epochs", F.col("tokens").alias("all")), "src")
    use = held.withColumn("epoch", F.explode(F.sequence(F.lit(0), whole))).withColumn("partial", F.col("epoch") == whole)
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), "src", "epoch", "block"))
    run = Window.partitionBy("src", "epoch").orderBy(order, "block")  # at most BLOCKS rows
    placed = use.withColumn("rank", F.row_number().over(run) - 1).withColumn("ahead", F.sum("tokens").over(run) - F.col("tokens"))
    target = (F.col("epochs") - whole) * F.col("all")
    return placed.where(~F.col("partial") | ((F.col("ahead") + F.col("tokens") / 2) < target)).select("src", "block", "epoch", "rank")


def mixed(docs: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id", seed: int = 7, keep: list[str] | None = None, **target) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows with src, tokens, block and the columns in keep; mixture; schedule) — see mixture() for the targets.

    Texts are read once. A source, however large, is summed by block within tasks before anything is shuffled; the mixture and the
    schedule have a row per source, and per source, block and epoch. Null texts have no tokens; they are used as often as
    their block. A null source is one of its own. Null ids are placed by their text. Repeated rows share a block and are each
    used. Column names of docs don't clash with those used here. An empty table gives empty results.
    """
    rows = sized_rows(docs, source_col, text_col, id_col, seed, keep)
    blocks = store(rows.groupBy(F.col("__src").alias("src"), F.col("__block").alias("block")).agg(F.sum("__tokens").alias("tokens")), "blocks")
    mix = store(mixture(blocks, **target), "mixture")
    return rows, mix, store(schedule(blocks, mix, seed), "schedule")


def copies(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """Per row: id, source, n_tokens, block, copies (times it is used) and its source's weight."""
    rows, mix, plan = mixed(docs, source_col=source_col, id_col=id_col, keep=[id_col, source_col], **options)
    used = plan.groupBy("src", "block").agg(F.count("*").alias("copies"))
    held = rows.join(bounded_broadcast(used, 1_000_000), (F.col("__src") == F.col("src")) & (F.col("__block") == F.col("block")), "left").drop("src", "block")
    held = held.join(bounded_broadcast(mix.select("src", "weight"), 1_000_000), F.col("__src") == F.col("src"))
    return held.select(
        F.col("__k0").alias(id_col), F.col("__k1").alias(source_col), F.col("__tokens").alias("n_tokens"), F.col("__block").alias("block"), F.coalesce("copies", F.lit(0)).alias("copies"), "weight"
    )


def realised(docs: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id", seed: int = 7, **target) -> DataFrame:
    """The rows of docs, each as often as the schedule uses its block; all columns stay. Texts are read again, not stored."""
    _, _, plan = mixed(docs, source_col, text_col, id_col, seed, **target)
    plan = bounded_broadcast(plan.select(F.col("src").alias("__src"), F.col("block").alias("__block")), 1_000_000)
    return _placed(docs, source_col, text_col, id_col, seed).join(plan, ["__src", "__block"]).select(*docs.columns)
