"""A training corpus from ``documents``: five stages, each over all that the one before kept.

Toxic documents go, one document of each group of near copies stays, documents that hold a
benchmark item go, personal data is replaced by its kind in brackets, and what is left is
packed into token sequences. Models are trained for each run: the toxicity field on labelled
documents that are not held out, the personal-data field on a small labelled table of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewise.llm import decontaminate, packing, pii, simhash, toxicity
from sitewise.llm.common import table
from sitewise.session import settle, tune


def clean_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = toxicity.training_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, toxicity.train(rows))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = pii.redact(docs, pii.train(pii.labelled_rows()))
    if "n_chars" not in docs.columns:
        return masked
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    placed = packing.pack_documents(docs, packing.word_vocabulary())
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", clean_toxicity),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]
# Trained models and a tokenizer are not SQL: tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
