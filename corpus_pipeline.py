"""A corpus pipeline of five stages over ``documents``.

toxicity -> quality rules -> near-duplicates -> personal data -> packing. Each stage
gets what its predecessor kept, as a table read from Parquet; the first four return the
columns of ``documents`` (the fourth with personal data replaced by marks such as
``<email>`` and ``n_chars`` counted anew), the last returns the pieces of the packed
sequences. Stages read nothing else but ``labels``, for the toxicity model.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import packing, pii, quality, superminhash, toxicity
from tessera.llm.common import documents
from tessera.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network rejects go."""
    return toxicity.keep_clean(docs, documents(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def drop_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays: the one with the smallest id."""
    return superminhash.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data is replaced by its kind."""
    return pii.redact_documents(docs, pii.train(pii.training_texts(docs))).withColumn("n_chars", F.length("text").cast("bigint"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed sequences, one row per piece."""
    pieces = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_poor),
    ("near_duplicates", drop_duplicates),
    ("personal_data", redact_personal_data),
    ("packing", pack),
]

#: No stage can be written in SQL (models, compression, tokens): tests compare ``run``
#: with the operators applied one document at a time.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
