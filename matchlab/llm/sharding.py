"""Contiguous shards of nearly equal byte size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlab.llm.storage import store


def byte_shards(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16) -> DataFrame:
    """Cut the rows, in ascending id order, into n_shards runs of nearly equal size.

    size is the UTF-8 length of the text plus `overhead`. Rows are dealt to range partitions without their
    texts and stored; per-partition totals give every partition its starting byte and row, so no window
    spans more than one partition. A row goes to the shard in which its middle byte falls, so each cut lies
    within half a row of its target. Returns id, size, text_crc32, shard, slot (place in the shard) and start (bytes before the row).

    A null text has no bytes (crc32 0). A null id sorts first; equal ids are ordered by size and crc32, and
    equal rows are interchangeable. An empty table gives no rows. A row longer than a target fills its shard
    alone and may leave a neighbour empty. Other columns are not carried.
    """
    sized = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long") + F.lit(overhead)).alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("crc"),
    )
    order = ["id", "size", "crc"]
    dealt = store(sized.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "shards")
    totals = dealt.groupBy("part").agg(F.sum("size").alias("part_bytes"), F.count("*").alias("part_rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    everything = Window.partitionBy(F.lit(0))
    offsets = totals.select(
        "part",
        F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("byte0"),
        F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("row0"),
        F.sum("part_bytes").over(everything).alias("total"),
    )
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        dealt.withColumn("ahead", F.coalesce(F.sum("size").over(within), F.lit(0)))
        .withColumn("row_in_part", F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1)
        .join(F.broadcast(offsets), "part")  # as many rows as partitions
        .withColumn("start", F.col("byte0") + F.col("ahead"))
        .withColumn("row", F.col("row0") + F.col("row_in_part"))
        .withColumn("shard", F.least(F.lit(n_shards - 1), F.expr(f"((2 * start + size) * {int(n_shards)}L) div (2 * total)")).cast("int"))
    )
    heads = placed.groupBy("shard").agg(F.min("row").alias("head"))
    return placed.join(F.broadcast(heads), "shard").select(  # n_shards rows
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("row") - F.col("head")).alias("slot"), "start"
    )
