"""Landed extracts as a file stream: every new file is upserted into its table once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from matchlab.sources.versions import file_source, merge, placed


def stream_upsert(
    spark: SparkSession,
    landed: str,
    table: str,
    schema: str | T.StructType,
    keys: Sequence[str],
    state: str,
    part: str = "season",
    fmt: str = "parquet",
) -> None:
    """Merge all files that arrived since the last call into a versioned table, then stop.

    ``state`` is the stream's checkpoint folder on shared storage. Rows carry the time and path of their file: of
    several rows of a key the one of the latest file wins, and of one file its last row, in one batch or over many.
    A batch that is replayed after a failure changes nothing.
    """
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def write(batch: DataFrame, _: int) -> None:
        merge(batch.sparkSession, table, struct, placed(batch), keys, part)

    files = file_source(spark.readStream.schema(struct).format(fmt).load(landed))
    query = (
        files.writeStream.foreachBatch(write)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
