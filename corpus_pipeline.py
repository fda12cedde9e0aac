"""From documents to token ids: the stages of the corpus pipeline.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet in the shared folder and read again as the next stage's documents.
All but the last return the columns of documents. No SQL expresses a trained
classifier or zstandard frames, so the pipeline has a brute-force test instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docledger.llm import decontaminate, jaccard, langid, mixing, tokenids
from docledger.llm.registry import held_out
from docledger.llm.words import scratch_folder, ship_package, written

TOKENIZER = "byte_bpe_50k.json"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model accepts."""
    ship_package(spark)
    return langid.accepted(docs, langid.fit(docs, ~held_out()))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words a shingle, similarity 0.8 or more."""
    return jaccard.one_of_each(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32, read back from the written files."""
    import public_tokenizers

    folder = tokenids.write_token_ids(docs, scratch_folder(spark, "tokenids"), public_tokenizers.path(TOKENIZER))
    return tokenids.read_token_ids(spark, folder)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix),
    ("token_ids", token_ids),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
