"""Quality rules: text statistics, and robust multivariate outliers per language and source. DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlab.llm.storage import store
from matchlab.session import bounded_broadcast

BLANK = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
BASE = ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: Transformed statistics and the least spread (standard deviation) each is given, so that a statistic that is 0 in nearly all
#: rows of a group doesn't turn every other value into an outlier.
VECTOR = (
    ("ln(word_chars / n_words)", 0.08),
    ("sqrt(n_symbols / word_chars)", 0.10),
    ("sqrt(n_dup_lines / n_lines)", 0.20),
    ("sqrt(n_repeat_words / n_words)", 0.20),
)


def chi2_cdf(x: float, df: int) -> float:
    """Of an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(df // 2))


def chi2_quantile(share: float, df: int) -> float:
    lo, hi = 0.0, 1e4
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, df) < share else (lo, mid)
    return hi


def text_statistics(docs: DataFrame, text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """The columns in `keep` with n_words, BASE and n_lines (lines that hold a word) of each text.

    n_repeat_words counts the words in 3-word windows that are found twice or more in the text. Windows are sorted as
    64-bit values: a hash above, the window's place in the low bits (as many as the text needs), so windows that repeat are
    neighbours. For a text of n words two different windows meet with chance about n**3 / 2**65.
    """
    t = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(t, F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK + "+"))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step = docs.select(
        *keep,
        words.alias("__w"),
        lines.alias("__l"),
        (F.char_length(t) - F.regexp_count(t, F.lit(BLANK))).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    # the bits above those that hold a window's place
    step = step.withColumn("__m", F.expr("shiftleft(-1L, length(bin(cast(size(__w) AS BIGINT))))"))
    window = "xxhash64(__w[i], __w[i + 1], __w[i + 2])"
    step = step.select(
        *keep,
        F.size("__w").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("__l").cast("long").alias("n_lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        "__m",
        F.expr(f"CASE WHEN size(__w) < 3 THEN cast(array() AS array<bigint>) ELSE sort_array(transform(sequence(0, size(__w) - 3), i -> ({window} & __m) | cast(i AS bigint))) END").alias("__s"),
    )
    step = step.withColumn(
        "__p",
        F.expr(
            "sort_array(transform(filter(__s, (x, k) -> (k > 0 AND (__s[k - 1] & __m) = (x & __m)) OR (k + 1 < size(__s) AND (__s[k + 1] & __m) = (x & __m))), x -> x & ~__m))"
        ),
    )
    covered = "aggregate(transform(__p, (x, k) -> CASE WHEN k + 1 < size(__p) THEN least(3L, __p[k + 1] - x) ELSE 3L END), 0L, (a, v) -> a + v)"
    return step.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", F.expr(covered).alias("n_repeat_words"), "n_lines")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _name(c: str) -> Column:
    """A group name that keeps null apart from all texts."""
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))


def _pools(rows: DataFrame, least: int) -> DataFrame:
    """lang, source, pool: small groups of one language are pooled, and pools that are still small once more."""
    n = rows.where("use").groupBy("lang", "source").agg(F.count("*").alias("n"))
    n = n.withColumn("pool", F.when(F.col("n") >= least, F.concat_ws("\t", "lang", "source")))
    by_lang = n.where("pool IS NULL").groupBy("lang").agg(F.sum("n").alias("m"))
    named = n.join(by_lang, "lang", "left")
    return named.select("lang", "source", F.coalesce("pool", F.when(F.col("m") >= least, F.col("lang")), F.lit("*")).alias("pool"))


def _cholesky(p: int) -> list[str]:
    """SQL for the factor of the covariance columns c00, c10, c11, ...: named l00, l10, l11, ... in order."""
    out = []
    for i in range(p):
        for j in range(i + 1):
            rest = "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
            out.append((f"l{i}{j}", f"sqrt(c{i}{i}{rest})" if i == j else f"(c{i}{j}{rest}) / l{j}{j}"))
    return out


def _distance(p: int) -> list[tuple[str, str]]:
    """SQL for z = L**-1 (x - m), whose squares sum to the squared Mahalanobis distance."""
    return [(f"z{i}", f"(x{i} - m{i}{''.join(f' - l{i}{k} * z{k}' for k in range(i))}) / l{i}{i}") for i in range(p)]


def _factor(moments: DataFrame, p: int) -> DataFrame:
    for name, sql in _cholesky(p):
        moments = moments.withColumn(name, F.expr(sql))
    return moments.select("pool", *(f"m{i}" for i in range(p)), *(f"l{i}{j}" for i in range(p) for j in range(i + 1)))


def _squared(rows: DataFrame, model: DataFrame, p: int, how: str = "inner") -> DataFrame:
    held = rows.join(model, "pool", how)
    for name, sql in _distance(p):
        held = held.withColumn(name, F.expr(sql))
    return held.withColumn("d2", F.expr(" + ".join(f"z{i} * z{i}" for i in range(p)))).drop(*(f"z{i}" for i in range(p)))


def _moments(rows: DataFrame, floors: Sequence[float], scale: float, weight: str = "1") -> DataFrame:
    p = len(floors)
    s = rows.groupBy("pool").agg(
        F.count("*").alias("n"),
        *(F.avg(f"x{i}").alias(f"m{i}") for i in range(p)),
        *(F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}{j}") for i in range(p) for j in range(i + 1)),
    )
    return s.select(
        "pool", *(f"m{i}" for i in range(p)), *((F.col(f"c{i}{j}") * scale + (floors[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}") for i in range(p) for j in range(i + 1))
    )


def _bin() -> Column:
    """A fine logarithmic scale of distances; rows of one bin enter or leave a subset together."""
    return F.floor(F.log(F.greatest("d2", F.lit(1e-12))) * 64).cast("long")


def robust_model(rows: DataFrame, floors: Sequence[float], share: float = 0.75, steps: int = 12) -> DataFrame:
    """pool, location m and Cholesky factor l of the minimum-covariance-determinant estimate. rows: pool, x0, x1, ...

    The start are medians and scaled median deviations by column. Each concentration step takes, per pool, the
    smallest set of closest rows that holds at least `share` of it (whole bins of distance) and its mean and covariance, scaled to be right
    for normal rows, plus the squared floors. Steps go on until no subset changes, at most `steps` times. All that is
    shuffled are counts by pool and bin and sums by pool, so a pool of any size is a few rows per task.
    """
    p = len(floors)
    q = chi2_quantile(share, p)
    scale = share / chi2_cdf(q, p + 2)
    middle = store(rows.groupBy("pool").agg(*(F.percentile_approx(f"x{i}", 0.5, 10000).alias(f"m{i}") for i in range(p))), "medians")
    spread = rows.join(middle, "pool").groupBy("pool").agg(*(F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), 0.5, 10000).alias(f"s{i}") for i in range(p)))
    start = middle.join(spread, "pool").select(
        "pool", *(f"m{i}" for i in range(p)), *((F.pow(F.col(f"s{i}") * 1.4826, 2) + floors[i] ** 2 if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i in range(p) for j in range(i + 1))
    )
    model, cut = store(_factor(start, p), "model"), None
    for _ in range(steps):
        counts = _squared(rows, model, p).groupBy("pool", _bin().alias("bin")).agg(F.count("*").alias("n"))
        run = Window.partitionBy("pool").orderBy("bin")  # a pool has some 2,000 bins
        held = counts.select("pool", "bin", F.sum("n").over(run).alias("upto"), F.sum("n").over(Window.partitionBy("pool")).alias("all"))
        new = store(held.where(F.col("upto") >= F.col("all") * share).groupBy("pool").agg(F.min("bin").alias("cut"), F.min("upto").alias("upto")), "cuts")
        near = _squared(rows, model, p).join(new, "pool").where(_bin() <= F.col("cut"))
        model = store(_factor(_moments(near, floors, scale), p), "model")
        if cut is not None and new.exceptAll(cut).isEmpty():
            break
        cut = new
    return model


def judged(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", keep: Sequence[str] = ("doc_id",), least: int = 100, confidence: float = 0.999) -> DataFrame:
    """The columns in `keep` with n_words, BASE, base_failed, distance (squared, Mahalanobis) and kept.

    Rows that pass the base rules are measured by VECTOR against the robust model of their language and source; kept is false for
    base_failed and for distances beyond the chi-square quantile of `confidence`. Groups with fewer than `least` such rows are
    pooled by language, and those pools, if still small, with each other; in a last pool under `least` rows nothing is rejected.

    Null and empty texts have no words and fail. Null languages and sources are groups of their own. Repeated rows all count and
    get one verdict. Columns with other names in `keep` pass through, whatever they are called. An empty table gives no rows.
    """
    names = [f"k{i}" for i in range(len(keep))]
    own = docs.select(*(F.col(c).alias(f"__{n}") for c, n in zip(keep, names)), F.col(text_col).alias("__text"), _name(lang_col).alias("__lang"), _name(source_col).alias("__source"))
    stats = text_statistics(own, "__text", [f"__{n}" for n in names] + ["__lang", "__source"])
    p, floors = len(VECTOR), [f for _, f in VECTOR]
    rows = stats.withColumn("base_failed", base_failed())
    rows = rows.select(
        *(f"__{n}" for n in names), F.col("__lang").alias("lang"), F.col("__source").alias("source"), "n_words", *BASE, "base_failed", (~F.col("base_failed")).alias("use"),
        *(F.when(~F.col("base_failed"), F.expr(sql)).alias(f"x{i}") for i, (sql, _) in enumerate(VECTOR)),
    )
    rows = store(rows, "statistics")
    pools = store(_pools(rows, least), "pools")
    known = rows.join(pools, ["lang", "source"], "left").withColumn("pool", F.when(F.col("use"), F.col("pool")))
    points = known.where("use").select("pool", *(f"x{i}" for i in range(p)))
    small = points.where("pool = '*'").limit(least).count() < least
    model = robust_model(points.where("pool <> '*'") if small else points, floors)
    far = chi2_quantile(confidence, p)
    return _squared(known, model, p, "left").select(
        *(F.col(f"__{n}").alias(c) for n, c in zip(names, keep)), "n_words", *BASE, "base_failed", F.col("d2").alias("distance"),
        (~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= far)).alias("kept"),
    )


def accepted(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", **options) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns.

    A verdict follows from text, language and source, so it is joined by their hash; only the hashes of rejected
    rows are stored, and texts are neither stored nor, while those are few, shuffled.
    """
    key = "__verdict_key"
    named = docs.withColumn(key, F.xxhash64(text_col, lang_col, source_col))
    held = named.select(F.col(text_col).alias("__t"), F.col(lang_col).alias("__l"), F.col(source_col).alias("__s"), key)
    rejected = store(judged(held, "__t", "__l", "__s", keep=[key], **options).where("NOT kept").select(key).distinct(), "rejected")
    return named.join(bounded_broadcast(rejected, 1_000_000), key, "left_anti").drop(key)
