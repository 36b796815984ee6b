"""Corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

Toxic documents go; later copies of repeated line runs are cut out of the
texts; one document of each SimHash group stays; documents with benchmark
passages go; the rest is encoded.  Null ids, null, empty and very long
texts, repeated rows and empty tables have the results that the operators
define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm import decontam, linededup, simhash, spm, toxicity
from reviewlake.llm.common import Scratch, table, unused


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from labels not held out, does not reject."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; later copies of repeated line runs are cut, and n_chars follows the text."""
    lines, removed = unused(docs, "n_lines"), unused(docs, "n_removed")
    cut = linededup.dedup(docs, counts=(lines, removed))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(F.col(removed) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash neighbours: four-word shingles, four bits."""
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang and source with the token ids, their number, and whether they decode to the text."""
    return spm.encode(docs, [c for c in ("doc_id", "lang", "source") if c in docs.columns])


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("simhash", drop_copies),
    ("decontamination", drop_benchmark),
    ("sentencepiece", tokens),
]

ORACLE_SQL = None  # a trained classifier and XXH64 are beyond SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; what the others return is stored in the shared folder."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return made
        docs = scratch.store(made, name)
        if k:
            scratch.drop(STAGES[k - 1][0])
    return docs
