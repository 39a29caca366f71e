"""Queries of the operators on texts, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from smogline.llm.common import table
from smogline.llm.contexts import lm_scores
from smogline.llm.exactdedup import dedup_digest
from smogline.llm.frames import fim_digest
from smogline.llm.jaccard import jaccard_components
from smogline.llm.licenses import license_scan
from smogline.llm.linededup import line_digest
from smogline.llm.packing import pack, pieces_of
from smogline.llm.periodic import run_digest
from smogline.llm.segmenter import encoding_digest
from smogline.llm.sharding import shard_digest
from smogline.llm.simhash import edited_fingerprints
from smogline.llm.topk import quantised, top_k
from smogline.llm.toxicity import toxicity_digest


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled segmentation of every document, decoded again."""
    return encoding_digest(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences."""
    return pack(pieces_of(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json")))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of every document and of its edited text."""
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word and context-tree score of every document."""
    return lm_scores(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document after the external shuffle."""
    return shard_digest(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines without repeated and nearly repeated ones."""
    return line_digest(table(spark, sf_dir, "documents"), exact_chars=1)


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and altered license texts per document."""
    return license_scan(table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with similar sets of word shingles."""
    return jaccard_components(table(spark, sf_dir, "documents"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best candidates of every hundredth vector."""
    return top_k(quantised(table(spark, sf_dir, "embeddings")))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labels outside fold 0."""
    return toxicity_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document, and the row of it that stays."""
    return dedup_digest(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document, and its text without the repeats."""
    return run_digest(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle form of every document, and the text restored from it."""
    return fim_digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sentencepiece, op2_packing, op3_fingerprints, op4_lm_scores, op5_sharding,
        op6_line_dedup, op7_licenses, op8_jaccard_join, op9_topk, op10_toxicity,
        op11_exact_dedup, op12_periodic_runs, op13_fill_in_middle,
    )
}
ORACLE: dict[str, str] = {}
