"""Tables and files in the folder that the cluster shares (spark.checkpoint.dir)."""

from __future__ import annotations

import uuid

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession

from matchlab.session import ensure_checkpoint_dir


#: Texts may be long, so Spark hands Python tasks batches of few bytes and reads parquet in short vectors, unless the session says otherwise.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m", "spark.sql.parquet.columnarReaderBatchSize": "1024"}


def small_batches(spark: SparkSession) -> None:
    """Put BATCHES in force where the session has no setting of its own."""
    for name, value in BATCHES.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder name below spark.checkpoint.dir; a local session without one gets its own."""
    ensure_checkpoint_dir(spark)
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def store(df: DataFrame, what: str = "table", partitions: list[str] | None = None) -> DataFrame:
    """Write df as parquet to the shared folder and go on from there."""
    small_batches(df.sparkSession)
    spark, path, schema = df.sparkSession, shared_folder(df.sparkSession, what), df.schema
    writer = df.write
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
    return spark.read.schema(schema).parquet(path)


def filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri)


def put(uri: str, name: str):
    """Open folder/name for writing; close() ends the file. Names hold a fresh id, so attempts never meet."""
    fs, folder = filesystem(uri)
    fs.create_dir(folder, recursive=True)
    return fs.open_output_stream(f"{folder}/{name}", compression=None)
