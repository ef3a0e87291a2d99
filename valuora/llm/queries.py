"""Registered queries ``opN_<name>``: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuora.llm import fingerprints, mixing, negatives, packing, pii, quality, secrets, sharding, simhash, topk, toxicity, trie, warc
from valuora.llm.common import addressed, map_columns, materialize, repeated, table

#: Tokenizer files; the operators take paths, the queries name these.
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into sequences of at most 4096 tokens."""
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), WORD_TOKENIZER)
    return packing.pack(pieces)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    fps = simhash.fingerprints(table(spark, sf_dir, "documents"))
    rows = simhash.near_duplicates(fps)
    return rows.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the 5:2:1 mix takes of every document."""
    rows = mixing.decide(mixing.sized(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op4_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records, found through the capture index and read back."""
    pages = table(spark, sf_dir, "pages")
    captures, directory, archives, index = warc.archive(pages)

    def make():
        return lambda c: {"key": [warc.url_key(u) for u in c["url"]]}

    keys = map_columns(pages.select("url").distinct(), make, T.StructType([T.StructField("key", T.StringType())]))
    found = warc.lookup(keys, directory, index)
    return warc.read_records(found, archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard, slot and shard after growth of every document."""
    return sharding.shard(table(spark, sf_dir, "documents"), 16)


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.OrdinalModel:
    """Ordinal model fitted on a bounded sample of rated documents of ``docs``."""
    ratings = quality.graded(table(spark, sf_dir, "labels"))
    return quality.train(docs.select("doc_id", "text").join(ratings, "doc_id"))


def op6_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, tail probability and selection of every document."""
    docs = table(spark, sf_dir, "documents")
    model = quality_model(spark, docs, sf_dir)
    graded = docs.select("doc_id", quality.score(model, F.col("text")).alias("q"))
    return graded.select("doc_id", "q.expected_grade", F.col("q.tail").alias("tail_probability"), F.col("q.keep").alias("selected"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    return secrets.scan(table(spark, sf_dir, "documents"), WORD_TOKENIZER)


def op8_bottom_k_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's sketch against its edited text's and the next document's."""
    out = fingerprints.compare_with_next(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_chars", "edited_sha256", fingerprints.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_sketch")).alias("edited_fingerprint"), "near_edited", "near_next")


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 best inner products of every twentieth vector against all others."""
    return topk.search(topk.quantized(table(spark, sf_dir, "embeddings")))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """The join of ``docs`` (doc_id, text, lang) with one label by doc_id.  Only ids and places are shuffled;
    the tasks that read the texts pick the labelled ones."""
    rows, file, place = addressed(docs, "labelled-documents")
    rows = rows.select("doc_id", "text", "lang", file, place)
    marks = rows.select("doc_id", file, place).join(labels.select("doc_id", label), "doc_id").groupBy(file, place, label).agg(F.count("*").alias("copies"))
    return materialize(repeated(rows, file, place, marks, "label-marks", [label]), "labelled-texts")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from rows outside the held-out part."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = toxicity.train(labelled_texts(docs, labels.where(~held), "toxic"))
    rows = docs.select("doc_id", held.alias("held_out"), "lang", toxicity.scored(model, F.col("text")).alias("score"))
    limit = toxicity.language_threshold(model, F.col("lang"))
    return rows.select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"),
        limit.alias("lang_threshold"), (F.col("score") >= limit).cast("int").alias("lang_predicted"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    return pii.scan(table(spark, sf_dir, "documents"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations, with its subtree sums."""
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First negatives inside the score window of every anchor's positives."""
    return negatives.hard_negatives(negatives.mining_rows(table(spark, sf_dir, "embeddings")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline of ``corpus_pipeline.py``."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_best_fit_packing, op2_simhash_near_dedup, op3_source_mixing, op4_warc_index, op5_jump_sharding,
             op6_ordinal_quality, op7_secret_scan, op8_bottom_k_fingerprints, op9_exact_topk, op10_toxicity,
             op11_personal_data, op12_conversation_trie, op13_hard_negatives, pipeline]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    from valuora.llm.oracles import ORACLES

    return dict(ORACLES)
