"""A corpus pipeline of five stages over the documents, each written as Parquet and read again by the next.

1. quality: documents that the quality classifier rejects go.
2. near_duplicates: of documents that 5-word shingles at a similarity of 0.8 connect, the one with the smallest id stays.
3. personal_data: spans found in the text are masked.
4. mixing: sources are mixed to their target weights; rows are in training order and repeated as often as taken.
5. tokens: each row is encoded; the last result has token counts and digests.

All but the last return the columns of ``documents``. Each stage works on all rows its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowtide.llm import bpe, jaccard, mixing, pii, quality
from rowtide.llm.common import batch_rows, shelve, table

SHINGLE, SIMILARITY = 5, 80


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    batch_rows(spark)  # for all stages: workers keep what one of them held
    return quality.accept(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.first_of_each(docs, percent=SIMILARITY, n=SHINGLE)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).drop("position")


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("tokens", encode_tokens),
]

#: The classifier and the encoder can't be told in SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = shelve(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
