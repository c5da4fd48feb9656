"""A corpus pipeline: documents in, token ids of the clean ones out.

Each stage works on all that the stage before kept, as a stored table: texts of
low quality go, texts in no language go, one text of each group of
near-duplicates stays, texts that hold a benchmark window go, and what is left
is encoded. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanledger.llm import bag_minhash, byte_bpe, language, positional_index, quality, queries
from spanledger.session import stored


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rule ensemble accepts."""
    model = queries.quality_model(spark, sf_dir, docs)
    return docs.where(model.score(F.col("text")) >= quality.THRESHOLD)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are in a language."""
    return language.known_language(docs, language.sample(docs, queries.fold(3) != 1))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return bag_minhash.deduplicate(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a window of a benchmark item."""
    return positional_index.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Count and digests of the token ids of every document, and of what they decode to."""
    return byte_bpe.digests(docs, public_tokenizers.path(queries.RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("byte_bpe", encoding_stage),
]

#: Fitted models and signatures have no SQL form; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of a folder; each but the last is stored and read again."""
    docs = queries.documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
