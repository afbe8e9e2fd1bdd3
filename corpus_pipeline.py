"""Corpus pipeline: the stages a document collection runs through.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read back as the next stage's docs. All but the last
return the columns of ``docs``.

Defined cases, for all stages: a NULL text counts as empty; rows without a
doc_id, or with one that repeats, are judged by their own text; of rows equal in
both the near-duplicate stage keeps one; ties go to the smaller id, then the
smaller hash of the text; very long texts are processed whole; an empty table
gives an empty result; further columns pass through under any name.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidmill.llm import (line_dedup, minhash_dedup, mixing, quality_cnn, sentencepiece_viterbi)
from bidmill.llm.store import WORD, stored


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte convolution accepts (score of at least 0.7); all
    of them if no label to learn from speaks against any."""
    labels = spark.read.parquet(os.path.join(sf_dir, "labels.parquet"))
    model = quality_cnn.train(docs, labels)
    # a constant other than 0 comes without label 0 (0.5 without any label)
    if model.get("constant", 0) > 0:
        return docs
    scored = quality_cnn.score(docs, model)
    return scored.where(F.col("score") >= quality_cnn.THRESHOLD).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs go, and with them the documents that consist
    of nothing else."""
    cut = line_dedup.remove_repeated_lines(docs)
    text = F.when(F.col("cut.removed") > 0, F.col("cut.text")).otherwise(F.col("row.text"))
    left = cut.where((F.col("cut.removed") == 0) | F.col("cut.text").rlike(WORD))
    return left.select(*[
        text.alias(c) if c == "text" else
        F.when(F.col("cut.removed") > 0, F.length("cut.text")).otherwise(F.col("row.n_chars"))
        .cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"row.`{c}`")
        for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group stays;
    rows that share an id, or have none, are judged by their own text."""
    return minhash_dedup.first_rows(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, by document."""
    return mixing.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and the piece ids of each text."""
    encoded = sentencepiece_viterbi.encode(docs.select("doc_id", "source", "text"),
                                           sentencepiece_viterbi.load())
    return encoded.select("row.doc_id", "row.source",
                          F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_classifier", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("source_mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

# a learned classifier and a tokenizer have no SQL form; tests hold line dedup
# and near-dedup against plain versions, and pieces against their texts
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
