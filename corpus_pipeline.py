"""The corpus pipeline: documents in, token ids out, one written table a stage.

quality rules -> near duplicates -> secrets -> source mixing -> byte BPE.
Every stage works on all that the stage before kept; all but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallymart.llm import bpe, mix, quality, secrets, simhash
from tallymart.llm.common import table
from tallymart.session import materialize

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Whole texts travel to Python in batches of at most so many, beside what the
#: stages before have left in an executor; and what the encoder may remember.
BATCH_ROWS, MEMORY = 1024, 24 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _small_batches(spark: SparkSession) -> None:
    """A setting of the application's session, in force when a stage runs."""
    if not 0 < int(spark.conf.get(_BATCH_CONF)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the certified rules keep."""
    return quality.filter_quality(docs, table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    _small_batches(spark)
    return simhash.one_of_each(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked and ``n_chars`` brought up to date."""
    return secrets.redact(docs, length_col="n_chars")


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mix.emit(docs)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document taken, and whether they decode to its text."""
    _small_batches(spark)
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    return bpe.encode_checked(docs, path, pattern, keep=["doc_id", "source", "lang"], memory=MEMORY)


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_dedup", dedup_stage),
    ("secret_scan", secrets_stage),
    ("source_mix", mix_stage),
    ("byte_bpe", tokens_stage),
]

#: XXH64 fingerprints and BPE merges are beyond SQL: tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
