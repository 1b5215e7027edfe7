"""Stored tables in versions, merged by key in source order.

A commit writes the partitions it changes into a folder of its own and then publishes a new list of partition
folders by one rename, which fails if another writer took the number. Readers see the old version or the new one; what a
broken run left behind is in no list. Every version can be read back until `forget` drops it. The file system must rename
atomically and refuse an existing target, as HDFS does.

    <table>/data/<version>-<id>/_part=<value>/   rows of one partition, with the time and name of their source
    <table>/versions/<version>/                   the list: partition, folder
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlab.session import cut

NO_PART = "__HIVE_DEFAULT_PARTITION__"

#: Where a row comes from: it decides which of several rows of a key is the latest.
SOURCE = T.StructType().add("_at", T.TimestampType()).add("_from", T.StringType())


class Conflict(RuntimeError):
    """Another writer published the version first."""


def file_source(df: DataFrame) -> DataFrame:
    """A scan or stream of files with file time (_at), path (_from) and block."""
    meta = {"_at": "file_modification_time", "_from": "file_path", "_block": "file_block_start"}
    return df.select(*df.columns, *[F.col(f"_metadata.{m}").alias(c) for c, m in meta.items()])


def placed(df: DataFrame) -> DataFrame:
    """Add _place, block and row within the file, to the rows of `file_source`.

    It orders the rows of one scan only, so it is not stored: a file that is read again brings the same latest rows.
    """
    return df.withColumn("_place", F.struct(F.col("_block").alias("block"), F.monotonically_increasing_id().alias("row"))).drop("_block")


def with_source(df: DataFrame, at: Column, name: str = "", place: Column | None = None) -> DataFrame:
    """The same for rows that a job made: later times win, within one time larger places."""
    return df.withColumns({"_at": at.cast("timestamp"), "_from": F.lit(name), "_place": F.lit(0) if place is None else place})


def latest_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last row of each key by _at, _from and _place, without _place; rows of one place are settled by a hash of their values.

    The rows are read and dealt by key once. Spark keeps the first row of a rank per task before it deals them, so a hot key costs one
    row per task.
    """
    scanned = isinstance(df.schema["_place"].dataType, T.StructType)  # block of the file, row: unique
    values = [c for c in df.columns if c not in (*keys, "_place")]
    places = [F.col("_place")] if scanned else [F.col("_place").cast("long"), F.xxhash64(*values)]
    last = Window.partitionBy(*keys).orderBy(*[o.desc() for o in (F.col("_at"), F.col("_from"), *places)])
    return df.withColumn("_turn", F.row_number().over(last)).filter("_turn = 1").drop("_turn", "_place")


# ---------------------------------------------------------------- versions


def _files(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    return hadoop, where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _names(spark: SparkSession, path: str) -> list[str]:
    _, fs, where = _files(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def _publish(spark: SparkSession, listed: DataFrame, table: str, version: int) -> None:
    """Write the list aside and rename it to its number; an existing number stays as it is."""
    hadoop, fs, target = _files(spark, f"{table}/versions/{version:010d}")
    aside = f"{table}/versions/_{uuid.uuid4().hex}"
    listed.coalesce(1).write.parquet(aside)
    context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    never = spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(hadoop.Path(aside), target, never)
    except Exception as e:
        fs.delete(hadoop.Path(aside), True)
        if "FileAlreadyExistsException" in str(e) or "already exists" in str(e):
            raise Conflict(f"version {version} of {table} exists") from e
        raise


def versions(spark: SparkSession, table: str) -> list[int]:
    return [int(n) for n in _names(spark, f"{table}/versions") if n.isdigit()]


def _listed(spark: SparkSession, table: str, version: int | None) -> dict[str | None, str]:
    """Partition value -> folder; one entry per partition."""
    if not version:
        return {}
    rows = spark.read.schema("part string, folder string").parquet(f"{table}/versions/{version:010d}").collect()
    return {r.part: r.folder for r in rows}


def read(spark: SparkSession, table: str, schema: T.StructType, version: int | None = None, parts: Sequence | None = None, source: bool = False) -> DataFrame:
    """Rows of a version (the newest if not named), of some partitions only if `parts` says so; no version gives no rows."""
    version = version if version is not None else max(versions(spark, table), default=0)
    listed = _listed(spark, table, version)
    folders = [f for p, f in listed.items() if parts is None or p in parts]
    full = T.StructType([*schema.fields, *SOURCE.fields])
    df = spark.read.schema(full).parquet(*folders) if folders else spark.createDataFrame([], full)
    return df if source else df.select(*schema.names)


def _part(part: str | None) -> Column:
    return F.lit("all") if part is None else F.col(part).cast("string")


def merge(spark: SparkSession, table: str, schema: T.StructType, new: DataFrame, keys: Sequence[str], part: str | None = "season", attempts: int = 5) -> int:
    """Merge an extract by key and publish a version; returns its number.

    Of several rows of a key in the extract the latest wins (latest_per_key); it replaces the stored row unless that one
    comes from a later source, so a correction wins in whatever order files arrive and a replay changes nothing.
    `part` (None: the table is one partition) must be a function of the keys: only the partitions in the extract are read and written. If another writer
    publishes first, the merge is done again on its version. An empty extract publishes nothing. Null keys are keys.
    """
    once = cut(latest_per_key(new.select(*schema.names, "_at", "_from", "_place"), keys))
    touched = [r[0] for r in once.select(_part(part)).distinct().collect()]  # partitions, not rows
    for _ in range(attempts):
        version = max(versions(spark, table), default=0)
        if not touched:
            return version
        try:
            return _commit(spark, table, schema, once, keys, part, touched, version)
        except Conflict:
            continue
    raise Conflict(f"{table}: {attempts} other writers were faster")


def _commit(spark, table, schema, once, keys, part, touched, version) -> int:
    listed = _listed(spark, table, version)
    stored = read(spark, table, schema, version, touched, source=True)
    rows = once.withColumn("_part", _part(part))
    if not any(p in listed for p in touched):
        return _write(spark, table, rows.repartition("_part", *keys[:1]), listed, version)
    # Stored and new rows of a key are dealt to the place they are written from, and settled there.
    rows = rows.withColumn("_new", F.lit(True)).unionByName(stored.withColumns({"_part": _part(part), "_new": F.lit(False)}))
    of_key, source = Window.partitionBy("_part", *keys), F.struct("_at", "_from")
    rows = rows.repartition("_part", *keys[:1]).withColumns(
        {"_offered": F.max(F.when(F.col("_new"), source)).over(of_key), "_held": F.max(F.when(~F.col("_new"), source)).over(of_key)}
    )
    stays = F.col("_offered").isNull() | F.coalesce(F.col("_held") > F.col("_offered"), F.lit(False))
    return _write(spark, table, rows.filter(F.col("_new") != stays).drop("_new", "_offered", "_held"), listed, version)


def _write(spark, table, rows, listed, version) -> int:
    """Rows with their _part, dealt by it, into a folder of their own."""
    folder = f"{table}/data/{version + 1:010d}-{uuid.uuid4().hex}"
    rows.write.partitionBy("_part").parquet(folder)
    for name in _names(spark, folder):
        if name.startswith("_part="):
            value = unquote(name[len("_part=") :])
            listed[None if value == NO_PART else value] = f"{folder}/{name}"
    _publish(spark, spark.createDataFrame(sorted(listed.items(), key=str), "part string, folder string"), table, version + 1)
    return version + 1


def replace(spark: SparkSession, table: str, schema: T.StructType, rows: DataFrame, part: str | None, spread: Sequence[str] = (), keep: Callable[[str | None], bool] = lambda p: True, attempts: int = 5) -> int:
    """Publish a version in which the partitions of ``rows`` hold just these rows; of the others those stay that ``keep`` says.

    Rows that carry their source (_at, _from) keep it, others are from now.
    """
    rows = rows.select(*schema.names, "_at", "_from") if "_at" in rows.columns else with_source(rows.select(*schema.names), F.current_timestamp()).drop("_place")
    for _ in range(attempts):
        version = max(versions(spark, table), default=0)
        listed = {p: f for p, f in _listed(spark, table, version).items() if keep(p)}
        try:
            return _write(spark, table, rows.withColumn("_part", _part(part)).repartition("_part", *spread), listed, version)
        except Conflict:
            continue
    raise Conflict(f"{table}: {attempts} other writers were faster")


def first_change(spark: SparkSession, table: str, schema: T.StructType, since: int, order: str):
    """Smallest ``order`` value of a row that two versions do not share, or None; only changed partitions are read."""
    parts = changed_parts(spark, table, since)
    if not parts:
        return None
    old, now = read(spark, table, schema, since, parts), read(spark, table, schema, None, parts)
    return now.exceptAll(old).unionByName(old.exceptAll(now)).agg(F.min(order)).first()[0]


def changed_parts(spark: SparkSession, table: str, since: int, version: int | None = None) -> list:
    """Partitions whose folder differs between two versions."""
    version = version if version is not None else max(versions(spark, table), default=0)
    old, now = _listed(spark, table, since), _listed(spark, table, version)
    return [p for p, f in now.items() if old.get(p) != f]


def forget(spark: SparkSession, table: str, keep: int = 10) -> None:
    """Drop all but the newest `keep` versions and the data folders that no remaining version lists.

    Data folders of the number that comes next may belong to a running writer and stay.
    """
    known = versions(spark, table)
    old, kept = known[:-keep], known[-keep:]
    hadoop, fs, _ = _files(spark, table)
    for v in old:
        fs.delete(hadoop.Path(f"{table}/versions/{v:010d}"), True)
    used = {f.rsplit("/", 2)[1] for v in kept for f in _listed(spark, table, v).values()}
    for name in _names(spark, f"{table}/data"):
        if name not in used and kept and int(name.split("-")[0]) <= kept[-1]:
            fs.delete(hadoop.Path(f"{table}/data/{name}"), True)


def exists(spark: SparkSession, table: str) -> bool:
    return bool(versions(spark, table))


def adopt(spark: SparkSession, table: str, schema: T.StructType, plain: str, keys: Sequence[str], part: str = "season") -> None:
    """Make the first version of a table from a plain parquet folder, if there is one and the table is new."""
    if exists(spark, table):
        return
    try:
        rows = spark.read.schema(schema).parquet(plain)
    except PySparkException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return
    merge(spark, table, schema, with_source(rows, F.lit("1970-01-01")), keys, part)
