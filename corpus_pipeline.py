"""Corpus pipeline: quality classifier, line dedup, near-duplicate removal,
benchmark decontamination, sentencepiece encoding and decoding.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written
as Parquet and read again as the next stage's documents, so a lost executor
or a failed stage costs that stage at most. Stages but the last keep the
columns of ``documents``; documents and lines that a stage rejects are gone
from its result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipcast.llm import classifier, decontaminate, line_dedup, pieces, simhash
from shipcast.llm.common import saved, table
from shipcast.llm.queries import model_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good (score 0.5
    or more). It learns from the labelled rows among ``docs``."""
    weights = classifier.quality_weights(docs, table(spark, sf_dir, "labels"))
    return docs.where(classifier.score_column(docs, F.col("text"), weights) >= 0.5)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that a smaller doc_id holds; text and
    n_chars are those of the lines left (a null text stays null)."""
    out = line_dedup.dedup_lines(docs.withColumnRenamed("lines", "_own_lines") if "lines" in docs.columns else docs)
    cut = F.col("lines")["n_dropped"] > 0
    new = {"text": F.when(cut, F.col("lines")["kept"]).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(cut, F.char_length(F.col("lines")["kept"]).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    own = [new.get(c, F.col("_own_lines") if c == "lines" else F.col(f"`{c}`")).alias(c) for c in docs.columns]
    return out.select(*own)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near-duplicates: that of the smallest
    doc_id, and of rows without an id one only where no other is in it."""
    return simhash.distinct_documents(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lies in
    benchmark windows, without the spans of those windows; text and n_chars
    are those of what is left, and documents without hits stay as they are."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"), cut_spans=True)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of each document left."""
    return pieces.round_trip(docs, model_path())


STAGES = [("quality classifier", quality), ("line dedup", lines), ("simhash near-dedup", near_duplicates),
          ("benchmark decontamination", benchmark), ("sentencepiece", encoded)]

#: The classifier and the encoder are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
