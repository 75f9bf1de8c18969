"""A corpus from raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet in the shared folder and
reads it again as the next stage's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glasslake.llm.common import materialize, without
from glasslake.llm.decontam import contaminated
from glasslake.llm.packing import pack
from glasslake.llm.quality import fit_quality, score_quality
from glasslake.llm.secrets import redact
from glasslake.llm.simhash import similar_groups

#: A document stays with this quality score or a higher one.
QUALITY_KEEP = 0.3
#: Bytes of rows that go to a Python worker at once. Spark's default of 64 MB is held twice by the executor and twice by the
#: worker; another setting of the session stays.
SPARKS_BYTES, BATCH_BYTES = f"{64 << 20}b", 4 << 20


def _small_batches(spark: SparkSession) -> None:
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == SPARKS_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; null texts count as empty, rows without an id and repeated rows
    are scored by their text like any other."""
    _small_batches(spark)
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, model, score_col="__quality").where(F.col("__quality") >= QUALITY_KEEP).drop("__quality")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group at a similarity of 0.8 of five-word shingles or more.

    Texts without words (null, empty) are copies of one another; rows without an id stay; repeated rows of one id
    are one document and stay or go together.
    """
    _small_batches(spark)
    groups = similar_groups(docs)
    return without(docs, groups.where("doc_id <> component_id"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; null texts and rows without an id stay, repeated rows go together."""
    _small_batches(spark)
    return without(docs, contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced in their texts; null texts stay null, repeated rows are changed alike."""
    _small_batches(spark)
    return redact(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens; null texts are one token, repeated rows and rows
    without an id are packed once each."""
    _small_batches(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", secrets), ("packing", packing)]

#: SQL cannot express the classifier, the tokenizers or the shingle verification: tests compare stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
