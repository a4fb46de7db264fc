"""From raw documents to tokens in training order: five stages over the whole corpus.

Each stage is a function of (session, documents, data folder); its result is
written as Parquet and read again as the next one's documents, so that lost
executors cost at most the stage at work.

Every stage takes nulls in any column, empty and very long texts, ties, repeated rows
and no rows at all; what it makes of them is said below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import bpe, jaccard, langid, mixing, substring
from wardline.llm.exchange import stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; learned from the labels of four fifths of them.

    Texts that are null or without a letter have none and go; rows with equal texts are
    judged alike; a tie between languages is not clear, and goes.
    """
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.keep_identified(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by similar shingle sets: that of the smallest id, null last.

    Texts without words are linked with nothing and stay; rows equal in id and text are one.
    """
    return jaccard.keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of windows that stand in several places.

    Documents that nothing is taken from keep their text as it is, null included; one
    that is repeated as a whole stays with an empty text; repeated rows are each other's repeats.
    """
    cut = substring.remove_repeats(docs.withColumn("whole", F.col("text")))
    text = F.when(F.col("n_removed") > 0, F.col("text")).otherwise(F.col("whole"))
    return cut.withColumn("text", text).withColumn(
        "n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    ).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order of training, each as often as the mix of sources meets it.

    Texts without words are not met; a null source is a source; ties go by id and text.
    The order is that of the files and of the rows in them, which the next stage names.
    """
    return mixing.training_order(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, a digest of what they decode to, and its ``position`` in training.

    ``docs`` is read from files; positions ascend with the files' numbers and the rows in
    them.  A null text has no tokens; repeated rows are coded each for itself.
    """
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).try_cast("long")
    place = F.shiftleft(F.coalesce(part, F.lit(0)), 40) + F.col("_metadata.row_index")
    rows = docs.select("doc_id", "lang", "source", "text", place.alias("position"))
    coded = bpe.round_trip(rows, bpe.byte_bpe_path())
    return coded.select(
        "doc_id", "lang", "source", "position", "n_tokens", "ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("mixture", mixture),
    ("tokens", tokens),
]

#: SQL cannot express learning a language model or byte-pair merging.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
