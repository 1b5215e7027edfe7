"""The registered queries of this package: thin wrappers with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchlab.llm.decontam import overlaps

    return overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchlab.llm.sharding import byte_shards

    rows = byte_shards(_table(spark, sf_dir, "documents"), 40)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchlab.llm.tokenfile import token_table

    return token_table(_table(spark, sf_dir, "documents"), _vocabulary(), end_id=1)


def op4_jaccard_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchlab.llm.jaccard import jaccard_classes

    return jaccard_classes(_table(spark, sf_dir, "documents")).drop("n_links")


def op5_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchlab.llm.quality import judged

    return judged(_table(spark, sf_dir, "documents"))


def op6_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchlab.llm.lm import lm_scores

    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return lm_scores(_table(spark, sf_dir, "documents"), _vocabulary(), end_id=49407, held_out=held_out)


def op7_secret_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchlab.llm.secrets import joined, secret_spans

    rows = secret_spans(_table(spark, sf_dir, "documents"), owner=F.col("source"), repo=F.concat_ws("/", "source", "lang"))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return rows.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        "n_live",
        "n_copied",
    )


def op8_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchlab.llm.storage import store
    from matchlab.llm.warc import page_rows, read_archives, write_archives

    # The stored rows hold the gaps too: quarantine(records) is their log.
    records = store(read_archives(write_archives(_table(spark, sf_dir, "pages")), blocks=False), "warc-records")
    return page_rows(records)


def op9_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchlab.llm.licenses import license_scan

    return license_scan(_table(spark, sf_dir, "documents"))


def op10_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchlab.llm.mixing import copies

    rows = copies(_table(spark, sf_dir, "documents"), max_repeats=1.25)
    return rows.withColumn("weight", F.round("weight", 6)).withColumn("copies", F.col("copies").cast("long"))


def op11_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from matchlab.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0, payload=False)


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchlab.llm.centroids import clusters

    return clusters(_table(spark, sf_dir, "embeddings"), k=40, rounds=5)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from matchlab.llm.phrases import collocations

    return collocations(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_spaced_seeds": op1_spaced_seeds,
    "op2_byte_shards": op2_byte_shards,
    "op3_token_files": op3_token_files,
    "op4_jaccard_tiles": op4_jaccard_tiles,
    "op5_robust_outliers": op5_robust_outliers,
    "op6_attention_scores": op6_attention_scores,
    "op7_secret_owners": op7_secret_owners,
    "op8_warc_salvage": op8_warc_salvage,
    "op9_license_notices": op9_license_notices,
    "op10_temperature_mix": op10_temperature_mix,
    "op11_balanced_packing": op11_balanced_packing,
    "op12_centroids": op12_centroids,
    "op13_collocations": op13_collocations,
}
