"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipcast.llm import classifier, conversations, decontaminate, exact_dedup, html_extract, line_dedup, pieces, pii, quality_rules, sharding, simhash, spelling, url_filters
from shipcast.llm.common import table
from shipcast.llm.oracle import ORACLE  # noqa: F401

PIECE_MODEL = "piece_bpe_32k.model"


def model_path(name: str = PIECE_MODEL) -> str:
    """The place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 16 shards that match the mixture of sources."""
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition measures and verdict of every document."""
    return quality_rules.judged(table(spark, sf_dir, "documents"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return url_filters.judged(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What line deduplication leaves of every document."""
    lines = F.col("lines")
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", lines["n_lines"].alias("n_lines"), lines["n_dropped"].alias("n_dropped"), F.sha2(lines["kept"], 256).alias("kept_sha256"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in benchmark windows."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extracted(table(spark, sf_dir, "pages"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms for personal values."""
    return pii.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return classifier.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and the decoded text of every document."""
    return pieces.round_trip(table(spark, sf_dir, "documents"), model_path())


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of every word of the documents."""
    return spelling.spelling_variants(spelling.counted_words(table(spark, sf_dir, "documents")))


def op12_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every conversation, after damage."""
    return conversations.repaired(conversations.damaged(table(spark, sf_dir, "conversations")), F.col("present"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal texts of every document and the row that stays."""
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of ``corpus_pipeline`` over the documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_sharding, op2_quality_rules, op3_url_filters, op4_line_dedup, op5_simhash, op6_decontamination, op7_html_extraction, op8_pii, op9_quality_classifier, op10_sentencepiece, op11_spelling, op12_conversations, op13_exact_dedup, pipeline)}
