"""Bulk load: landed folders of any number of seasons into the four stored tables, with a ledger of what was loaded.

    <landed>/season=<s>/round=<r>/<table>/*.csv or *.parquet     table: ladder, player_match, team_match
    <landed>/<table>/season=<s>/round=<r>/*.csv or *.parquet     the same
    <root>/tables/<table>                                        the stored tables, in versions
    <root>/tables/player_key                                     each player with the name it first played under
    <root>/tables/load_ledger                                    one row per loaded file
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlab.functions.fixed_values import LADDER_NAMES
from matchlab.operators.keyed import first_per_key
from matchlab.operators.names import canonical_team
from matchlab.operators.ordered import null_safe_join
from matchlab.operators.teams import ladder_position
from matchlab.session import cut
from matchlab.sources import tables as S
from matchlab.sources import versions as V
from matchlab.sources.schemas import KEYS, SCHEMAS

#: Names that a source gives a column of a table.
NAMES: Mapping[str, Mapping[str, str]] = {"ladder": LADDER_NAMES}
TABLES = ("ladder", "player_match", "team_match")
MADE = {"ladder": ["ladder_position"]}  # columns that no file holds

LEDGER = T.StructType().add("path", "string").add("modified", "timestamp").add("name", "string").add("season", "integer").add("round", "integer").add("fmt", "string").add("header", "string")


def stored_schema(name: str) -> T.StructType:
    """Schema of a stored table: all are partitioned by season."""
    schema = SCHEMAS[name]
    return schema if "season" in schema.names else T.StructType([*schema.fields, T.StructField("season", T.IntegerType())])


def landed_files(spark: SparkSession, landed: str) -> DataFrame:
    """path, modified, name, season, round and fmt of every landed file; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landed).select("path", F.col("modificationTime").alias("modified"))
    part = lambda pattern: F.regexp_extract("path", pattern, 1)
    return files.select(
        F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))).alias("path"),
        "modified",
        part(rf"/({'|'.join(TABLES)})/").alias("name"),
        part(r"/season=(\d+)/").try_cast("int").alias("season"),
        part(r"/round=(\d+)/").try_cast("int").alias("round"),
        part(r"\.(csv|parquet)$").alias("fmt"),
    ).filter((F.col("name") != "") & (F.col("fmt") != "") & F.col("season").isNotNull())


def _headers(spark: SparkSession, files: DataFrame, landed: str) -> DataFrame:
    """The files with the header of each CSV; parquet files carry their own names."""
    paths = [r.path for r in files.filter("fmt = 'csv'").select("path").collect()]  # of the files, not of rows
    if not paths:
        return files.withColumn("header", F.lit(""))
    first = S.csv_headers(spark, paths)
    return files.join(first, "path", "left").withColumn("header", F.when(F.col("fmt") == "csv", F.col("header")).otherwise(""))


def _scan(spark: SparkSession, name: str, fmt: str, paths: Sequence[str], landed: str) -> DataFrame:
    """The rows of files of one table and one header, typed, with season and round from their folders and their source."""
    reader = spark.read.option("basePath", landed)
    raw = reader.csv(paths, header=True, nullValue="NA") if fmt == "csv" else reader.option("mergeSchema", True).parquet(*paths)
    raw = V.file_source(raw)
    own = {c: S.snake_case(c) for c in raw.columns if c not in ("_at", "_from", "_block")}
    df = S.renamed(V.placed(raw.withColumnsRenamed(own)), NAMES.get(name, {}))
    if "competition_id" in df.columns:
        df = S.unnest_competition(df)
    full, made = stored_schema(name), MADE.get(name, [])
    missing = [f.name for f in full if f.name not in df.columns and f.name not in made]
    if missing:
        raise ValueError(f"{name}: columns missing from {paths[0]}: {missing}")

    def value(f: T.StructField) -> Column:
        if f.name in made:
            return F.lit(None).cast(f.dataType).alias(f.name)
        col = F.col(f.name)
        if f.dataType == T.DateType():
            col = F.to_date(F.substring(col.cast("string"), 1, 10))
        return col.cast(f.dataType).alias(f.name)

    return df.select(*[value(f) for f in full], "_at", "_from", "_place")


def load(spark: SparkSession, landed: str, root: str) -> DataFrame:
    """Load every landed file that the ledger does not hold as it is; returns the ledger rows of this call.

    Files are grouped by table and header, so columns are taken by name whatever their order. Of several rows of a key the
    one of the latest file wins, now and in later calls. Rows without a key value are left out. The ledger is written last: a call that
    broke off is repeated with the same result.
    """
    ledger = f"{root}/tables/load_ledger"
    done = V.read(spark, ledger, LEDGER)
    files = null_safe_join(landed_files(spark, landed), done.select("path", "modified"), ["path", "modified"], "left_anti")
    files = cut(_headers(spark, cut(files), landed))
    groups = files.groupBy("name", "fmt", "header").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    for name in TABLES:
        own = [_scan(spark, name, g.fmt, g.paths, landed) for g in groups if g.name == name]
        if not own:
            continue
        rows, keys, full = reduce(DataFrame.unionByName, own), KEYS[name], stored_schema(name)
        rows = rows.dropna(subset=keys)
        if name == "ladder":
            rows = rows.withColumn("team", canonical_team(F.col("team")))
        table = f"{root}/tables/{name}"
        before = max(V.versions(spark, table), default=0)
        V.merge(spark, table, full, rows, keys)
        if name == "ladder":  # positions depend on the whole round, corrections included
            touched = V.changed_parts(spark, table, before)
            if touched:
                V.replace(spark, table, full, ladder_position(V.read(spark, table, full, parts=touched, source=True)), "season", ["round"])
        if name == "player_match":
            names = SCHEMAS["player_key"].names
            pm = V.read(spark, table, full)
            first = first_per_key(pm.select(*names, "utc_start", "match_id"), ["player_id"], [F.col(c) for c in ("utc_start", "match_id", "firstname", "surname")])
            V.replace(spark, f"{root}/tables/player_key", SCHEMAS["player_key"], first.select(*names), None, ["player_id"])
    V.merge(spark, ledger, LEDGER, V.with_source(files, F.current_timestamp()), ["path"], part="name")
    return files.select(*LEDGER.names)
