"""Scans, sinks and keyed upserts of the match tables (CSV or parquet)."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlab.operators.keyed import first_per_key
from matchlab.operators.ordered import null_safe_join
from matchlab.session import bounded_broadcast, cut
from matchlab.sources.schemas import SCHEMAS


def snake_case(name: str) -> str:
    """``kicksGeneralPlay`` -> ``kicks_general_play``; digits stay attached to their word."""
    name = re.sub(r"[^0-9A-Za-z]+", "_", name)
    name = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", name)
    return re.sub(r"_+", "_", name).strip("_").lower()


def snake_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_case(c) for c in df.columns])


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Columns that a source names otherwise get their table's name; names that are right already stay."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns and new not in df.columns})


def read_table(
    spark: SparkSession,
    name_or_schema: str | T.StructType,
    path: str | Sequence[str],
    fmt: str = "parquet",
    row_names: bool = False,
) -> DataFrame:
    """Read a table with its declared schema.

    CSV columns are taken by their name in the header of their own file, in any order; further columns (such as
    an unnamed row-number column, ``row_names``) are dropped, a missing column or a value that its type
    cannot hold is an error. Date columns may hold UTC timestamps, which are cut to the day; timestamps may be
    ISO or day/month/year hour:minute.
    """
    schema = SCHEMAS[name_or_schema] if isinstance(name_or_schema, str) else name_or_schema
    paths = path if isinstance(path, str) else list(path)
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(paths)
    parts = [df for p in ([paths] if isinstance(paths, str) else paths) for df in csv_by_header(spark, p)]
    return reduce(DataFrame.unionByName, [_typed(df, schema, row_names) for df in parts])


def csv_by_header(spark: SparkSession, path: str) -> list[DataFrame]:
    """All columns as text, one scan per header: a scan of many files takes the first one's header for all.

    With more than one file the first line of each is looked up by a job, and files are grouped by it; folder columns
    (season=2020) stay. The paths of the files reach the driver, as they do for every scan.
    """
    whole = spark.read.csv(path, header=True, nullValue="NA")
    if len(whole.inputFiles()) <= 1:
        return [whole]
    groups = list(csv_headers(spark, path).groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).sort("header").collect())
    if len(groups) == 1:
        return [whole]
    return [spark.read.option("basePath", path).csv(g.paths, header=True, nullValue="NA") for g in groups]


def csv_headers(spark: SparkSession, path: str) -> DataFrame:
    """path and header (the first line) of every CSV file below a folder that is not empty."""
    lines = spark.read.text(path).select(
        "value", F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("path"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row")
    )
    return lines.filter("_block = 0").groupBy("path").agg(F.min_by("value", "_row").alias("header"))


def _typed(raw: DataFrame, schema: T.StructType, row_names: bool) -> DataFrame:
    names = raw.columns[1:] if row_names else raw.columns
    if missing := [f.name for f in schema if f.name not in names]:
        raise ValueError(f"columns missing from the header: {missing}; it has {raw.columns}")
    if twice := [f.name for f in schema if names.count(f.name) > 1]:
        raise ValueError(f"columns named more than once in the header: {twice}")

    def value(f: T.StructField) -> Column:
        text = F.col(f"`{f.name}`")
        if f.dataType == T.DateType():
            return F.to_date(F.substring(text, 1, 10))
        if f.dataType == T.TimestampType():
            day_first = F.coalesce(
                F.try_to_timestamp(text, F.lit("d/M/yyyy H:mm")), F.try_to_timestamp(text, F.lit("d/M/yyyy H:mm:ss"))
            )
            return F.when(text.contains("/"), day_first).otherwise(F.to_timestamp(text))
        if f.dataType in (T.LongType(), T.IntegerType()):  # whole numbers may be written as 1.0
            plain = F.regexp_replace(F.trim(text), r"\.0+$", "")
            return plain.cast(f.dataType)
        return text.cast(f.dataType)

    return raw.select(*[value(f).alias(f.name) for f in schema])


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Replace the whole table."""
    writer = df.write.mode("overwrite").format(fmt).partitionBy(*partition_by)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)


def append_log(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Add rows to a log; every CSV part file carries its own header."""
    writer = df.write.mode("append").format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)


def select_competitions(competitions: DataFrame, names: Sequence[str], first_season: int | None = None) -> DataFrame:
    """Competitions whose name contains one of the given texts, from a first season on."""
    hit = F.lit(False)
    for text in names:
        hit = hit | F.col("name").contains(text)
    chosen = competitions.filter(hit)
    return chosen if first_season is None else chosen.filter(F.col("season") >= first_season)


def played_rounds(results: DataFrame, score: str = "home_score") -> DataFrame:
    """Rounds in which some fixture already has a score."""
    return results.filter(F.col(score).isNotNull()).select("round").distinct()


def collect_extracts(
    frames: Sequence[DataFrame], required: Sequence[str] | None = None, **tags: Column
) -> DataFrame:
    """Union extracts by column name, in snake case, without the rows that lack a required value.

    ``required=None`` drops rows with any null (league tables); otherwise only the named columns
    count. A directory partitioned by season/round is one extract: read it once with its path.
    """
    whole = snake_columns(frames[0])
    for frame in frames[1:]:
        whole = whole.unionByName(snake_columns(frame), allowMissingColumns=True)
    whole = whole.withColumns(tags) if tags else whole
    return whole.dropna(subset=None if required is None else list(required))


def unnest_competition(df: DataFrame, col: str = "competition_id") -> DataFrame:
    """Weekly extracts nest the competition as a struct with an ``id``."""
    nested = isinstance(df.schema[col].dataType, T.StructType)
    return df.withColumn(col, F.col(f"{col}.id").cast("long")) if nested else df


MAX_NEW_KEYS = 1_000_000  # keys of an extract that may be broadcast against the history


def upsert(hist: DataFrame, new: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """hist plus new, where a row of ``new`` replaces the row with its key.

    Only the extract is deduplicated (the row that is smallest by ``prefer`` and then by its columns
    stays) and stored; the history, which has one row per key, is merely filtered by the extract's keys
    and not shuffled while those are few. A second run with the same input changes nothing.
    """
    rest = [c for c in new.columns if c not in (*keys, *prefer)]
    once = cut(first_per_key(new, keys, [F.col(c) for c in (*prefer, *rest)]))
    replaced = bounded_broadcast(once.select(*keys), MAX_NEW_KEYS)
    kept = null_safe_join(hist, replaced, keys, "left_anti")
    return kept.unionByName(once, allowMissingColumns=True)


def upsert_table(
    spark: SparkSession, path: str, schema: T.StructType, new: DataFrame, keys: Sequence[str], part: str = "season"
) -> None:
    """Upsert into a parquet table partitioned by ``part``, rewriting only the partitions of ``new``.

    ``part`` must be a function of the keys. ``new`` is stored once. Its distinct partition values are
    counted: while they are few they are broadcast and prune the scan. Dynamic overwrite replaces those
    partitions at job commit.
    """
    new = cut(new)
    try:
        hist = spark.read.schema(schema).parquet(path)
        hist.limit(0).count()
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        hist = spark.createDataFrame([], schema)
    touched = bounded_broadcast(cut(new.select(part).distinct()), MAX_NEW_KEYS)
    merged = upsert(hist.join(touched, part, "left_semi"), new, keys)
    (
        merged.repartition(part, *keys[:1])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(part)
        .parquet(path)
    )


def experiment_entry(
    spark: SparkSession, algorithm: str, feature_set: str, resample_scheme: str, logloss: float, notes: str = ""
) -> DataFrame:
    row = [(algorithm, feature_set, resample_scheme, float(logloss), notes)]
    df = spark.createDataFrame(
        row, "algorithm string, feature_set string, resample_scheme string, logloss double, notes string"
    )
    return df.select(F.current_timestamp().alias("timestamp"), "*")


def log_experiment(spark: SparkSession, path: str, **entry) -> None:
    append_log(experiment_entry(spark, **entry), path)
