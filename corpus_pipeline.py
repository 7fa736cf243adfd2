"""A corpus in five stages: toxic documents go, one of each group of near copies stays, personal data is
masked, sources are mixed to their weights, and what is left is cut into pieces.

Each stage reads what its predecessor has written. All but the last return the columns of ``documents``;
the last returns doc_id, sample, ids, log_prob and log_inclusion, two distinct samples of a text (one where it has no
other). A document that the mix sends more than once is in its result as often.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shoplens.llm import mixing, pii, segment, simhash, toxicity
from shoplens.llm.tables import table
from shoplens.scratch import materialize

#: Rows of texts that an executor and its Python workers hold at once. Spark's own 10,000 are tens of MB on either side.
BATCH_ROWS = 256
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _small_batches(spark: SparkSession) -> None:
    """Lowers the session's rows per Arrow batch, which Spark reads when a stage's result is written; a lower setting stays."""
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return simhash.one_of_each(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return pii.mask_texts(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    found = segment.sampled(docs)
    return found.select(found["key"].alias("doc_id"), "sample", "ids", "log_prob", "log_inclusion")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("pii", mask_personal_data),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode),
]

#: Models, fingerprints and samples are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
