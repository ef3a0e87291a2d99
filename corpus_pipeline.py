"""Corpus pipeline: documents to packed training sequences.

Stages: quality selection, near-duplicate removal, secret redaction, mixing of
sources, packing.  Each takes (spark, docs, sf_dir) and gives a DataFrame; all
but the last give the columns they got.  ``run`` writes every stage's result as
Parquet in the shared folder and feeds it to the next.

Nulls, empty and very long texts, repeated rows and extra columns pass through:
quality judges a null text as an empty one, deduplication keeps one row of equal
fingerprints (repeated rows included), redaction leaves null texts null, mixing
counts them as size 0, packing gives them a single end token.  Empty tables give
empty results.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from valuora.llm import mixing, packing, quality, secrets, simhash
from valuora.llm.common import files_alone, materialize
from valuora.llm.queries import WORD_TOKENIZER, quality_model
from valuora.session import drop_scratch, scratch_made

#: Scratch tables of the last stage, by application.  Its result may be lazy, so they stay until
#: the next stage gets that result reread from files.
_LEFT: dict[str, list[str]] = {}


def _stage(function):
    """A stage that drops the scratch tables of the one before it, once its input is a table of its own."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        left = _LEFT.pop(application, [])
        if files_alone(docs) and not any(p in f for p in left for f in docs.inputFiles()):
            drop_scratch(spark, left)
            left = []
        with scratch_made() as made:
            out = function(spark, docs, sf_dir)
        _LEFT[application] = left + made
        return out

    return run_stage


@_stage
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose tail probability of a good grade passes the calibrated threshold."""
    model = quality_model(spark, docs, sf_dir)
    return docs.where(quality.score(model, F.col("text")).getField("keep"))


@_stage
def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (3-word shingles, at most 2 bits)."""
    return simhash.drop_near_duplicates(docs)


@_stage
def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every found secret replaced by a mark; n_chars follows the text."""
    clean = docs.withColumn("text", secrets.redacted(F.col("text"), WORD_TOKENIZER))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return clean


@_stage
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as often as the 5:2:1 mix of the sources takes them."""
    return mixing.mix(docs)


@_stage
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and offset."""
    return packing.pack(packing.token_pieces(docs, WORD_TOKENIZER))


STAGES = [
    ("quality", quality_stage),
    ("simhash_near_dedup", dedup_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Model fits, SimHash and tokenizers have no SQL form; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
