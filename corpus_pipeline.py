"""The corpus pipeline: toxic documents go, one of each group of near copies stays, repeated passages and
personal data are taken out, and what is left is packed into sequences. Each stage takes
(spark, docs, sf_dir) and reads what the one before has written."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm import packing, pii, suffix_dedup, toxicity
from kinfold.llm.common import cut, real_id, table
from kinfold.llm.minhash_join import first_copies

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to the labelled ones, scores below 0.5."""
    docs = docs.select(*COLUMNS)
    weights = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, weights, [*COLUMNS]).filter("score < 0.5").select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a similarity of 0.8 on five-word shingles, the one of the smallest doc_id."""
    return first_copies(docs.select(*COLUMNS), shingle=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that start earlier as well, cut between characters."""
    out = suffix_dedup.cut_out(docs.select(*COLUMNS), length=100, whole_characters=True, keep=("lang", "source"))
    text = F.col("kept").cast("string")
    return out.select(real_id(), text.alias("text"), "lang", "source", F.char_length(text).cast("long").alias("n_chars"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by the name of its kind."""
    out = pii.detect(docs.select(*COLUMNS))
    text = F.when(F.col("text").isNotNull(), pii.redacted(F.col("text"), F.col("pii.spans")))
    return out.select("doc_id", text.alias("text"), "lang", "source").withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 4096 tokens."""
    return packing.pack(docs.select(*COLUMNS), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("suffix_arrays", cut_repeats),
    ("personal_data", redact),
    ("packing", pack),
]

#: Classifiers, tokenisation and packing can't be put in SQL; tests/llm holds stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
