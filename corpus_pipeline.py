"""A training-text pipeline: five stages, each a DataFrame of documents to the next.

toxicity -> line dedup -> n-gram Jaccard join -> source mixing -> byte-level BPE

Every stage reads all documents that the one before it kept.  All but the last return the
columns of ``documents``; the last returns the token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import bpe, chosen_path, line_dedup, mixing, toxicity
from eventide.session import materialize, prepare


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network scores below 0.5."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    weights = toxicity.fit(docs, labels)
    return toxicity.score_texts(docs, weights).where(F.col("score") < 0.5).select(docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat, or nearly repeat, an earlier line; n_chars follows the text."""
    prepare(spark)
    changed = line_dedup.dedup_lines(docs.withColumn("_length", F.length("text")))
    n_chars = F.when(F.length("text").eqNullSafe(F.col("_length")), F.col("n_chars")).otherwise(F.length("text"))
    return changed.withColumn("n_chars", n_chars.cast("long")).select(docs.columns)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    prepare(spark)
    return chosen_path.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, each as often as its source's target takes it.

    Rows leave in training order, but the next stage reads them as Parquet splits in any order, and
    positions are not among the columns: only which documents and how often reaches the last stage.
    """
    prepare(spark)
    return mixing.mixed(docs).select(docs.columns)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of every row."""
    prepare(spark)
    # A smaller cache than by itself: this stage's JVM also holds the ids that it writes.
    ids = bpe.encode_texts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                           units_kept=1 << 17)
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("toxicity", toxicity_stage), ("line_dedup", line_dedup_stage), ("ngram_jaccard", near_copies_stage),
          ("source_mixing", mixing_stage), ("bpe", bpe_stage)]

#: The learned first stage and the sketches of the third have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
