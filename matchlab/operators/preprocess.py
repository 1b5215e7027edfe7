"""Preprocessing fitted on training rows and kept as a table: what stays, which levels exist, what happens to the rest.

One row per numeric predictor and per level of a nominal one. The same table gives column expressions and a pipeline
stage, so a frame is prepared alike wherever it is.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlab.operators.model import gbt

RULES = "predictor string, kind string, level string, place int, keep boolean, feature string"
MAX_LEVELS = 10_000  # levels of all nominal predictors together; they become columns
NEW = "new"


def _feature(predictor: str, level: str) -> str:
    return f"{predictor}_{re.sub(r'[^0-9a-z]+', '_', level.lower()).strip('_') or 'blank'}"


def fit_rules(train: DataFrame, numeric: Sequence[str], nominal: Sequence[str] = ()) -> DataFrame:
    """The rules table of the training rows, before rows with missing values are left out.

    A predictor without at least two different values goes (missing values don't count). The levels of a nominal one
    are numbered in order of their text; the first is the reference and gets no column, and one column marks
    every level that was not there (`new`). More than MAX_LEVELS levels are an error, since each would be a column.
    """
    spark = train.sparkSession
    ranges = [F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in numeric]
    found = train.agg(*ranges, F.count(F.lit(1)).alias("_n")).first()  # one row
    rows = []
    for c in numeric:
        low, high = found[c]
        rows.append((c, "numeric", None, 0, low is not None and low != high, c))
    if nominal:
        pairs = train.select(F.explode(F.array(*[F.struct(F.lit(c).alias("predictor"), F.col(c).cast("string").alias("level")) for c in nominal])).alias("p")).select("p.*")
        levels = pairs.filter("level IS NOT NULL").distinct().limit(MAX_LEVELS + 1).collect()
        if len(levels) > MAX_LEVELS:
            raise ValueError(f"more than {MAX_LEVELS} levels in {list(nominal)}")
        for c in nominal:
            own, taken = sorted((r.level for r in levels if r.predictor == c), key=str.encode), set()
            for i, level in enumerate(own, 1):
                name = _feature(c, level)
                name = name if name not in taken and name != _feature(c, NEW) else f"{name}_{i}"
                taken.add(name)
                rows.append((c, "nominal", level, i, len(own) > 1, name))
            rows.append((c, "novel", None, len(own) + 1, len(own) > 1, _feature(c, NEW)))
    return spark.createDataFrame(rows, RULES)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def expressions(rules: DataFrame) -> dict[str, str]:
    """Feature -> SQL expression. A missing nominal value leaves all its columns missing, a missing number stays missing."""
    rows = rules.filter("keep").orderBy("predictor", "place").collect()  # at most predictors + MAX_LEVELS
    out = {r.feature: f"CAST(`{r.predictor}` AS DOUBLE)" for r in rows if r.kind == "numeric"}
    for r in rows:
        if r.kind == "nominal" and r.place > 1:
            out[r.feature] = f"CAST(CAST(`{r.predictor}` AS STRING) = {_text(r.level)} AS DOUBLE)"
        if r.kind == "novel":
            known = ", ".join(_text(x.level) for x in rows if x.predictor == r.predictor and x.kind == "nominal")
            out[r.feature] = f"CAST(CAST(`{r.predictor}` AS STRING) NOT IN ({known}) AS DOUBLE)"
    return out


def prepare(df: DataFrame, rules: DataFrame, keep: Sequence[str] = (), training: bool = False) -> DataFrame:
    """The kept columns and the features; only training leaves out rows with a missing feature."""
    made = expressions(rules)
    clash = [c for c in made if c in keep]
    if clash:
        raise ValueError(f"features named like kept columns: {clash}")
    out = df.selectExpr(*[f"`{c}`" for c in keep], *[f"{sql} AS `{name}`" for name, sql in made.items()])
    return out.dropna(subset=list(made)) if training else out


def prepared_pipeline(rules: DataFrame, params: Mapping[str, float] | None = None, trees: int = 1000, seed: int = 234) -> Pipeline:
    """The rules as a stage, then boosted trees. Stored and loaded, it prepares rows by the same expressions."""
    made = expressions(rules)
    names = {f: f"_p_{i}" for i, f in enumerate(made)}
    if not made:
        raise ValueError("no predictor varies")
    select = ", ".join(f"{sql} AS {names[f]}" for f, sql in made.items())
    return Pipeline(
        stages=[
            SQLTransformer(statement=f"SELECT *, {select} FROM __THIS__"),
            VectorAssembler(inputCols=list(names.values()), outputCol="features", handleInvalid="keep"),
            gbt(params, trees, seed),
        ]
    )
