"""From raw documents to token files: five stages, each over all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that run() writes as Parquet to the shared folder and
reads again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchlab.llm.decontam import clean_of
from matchlab.llm.jaccard import one_of_each
from matchlab.llm.mixing import realised
from matchlab.llm.quality import accepted
from matchlab.llm.storage import store
from matchlab.llm.tokenfile import token_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that fail the base rules or are outliers of their language and source go."""
    return accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of linked texts the row with the smallest id stays."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that share a run of words with a benchmark item go."""
    return clean_of(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated, the smallest up to twice as often as the largest; every text is used at least once."""
    return realised(docs, max_repeats=2.0, cover=True)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids in Arrow files in id order, read back: doc_id, start, n_tokens, ids_crc32."""
    import public_tokenizers

    return token_table(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", source_mixture),
    ("token-ID output", token_files),
]

#: SQL cannot express the robust estimates, the fuzzy seeds or the tokenizer; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), "stage")
    return docs
