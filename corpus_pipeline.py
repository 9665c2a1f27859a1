"""A corpus pipeline: each stage is one operator of ``meshfeed.llm``, written and read again.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. All but the
last return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meshfeed.llm import decontaminate, packing, pii, queries, simhash, toxicity
from meshfeed.session import delete_folder, shared_folder, temporary_tables

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.3 or more go. The model learns from labels as in the operator's query."""
    model = queries.toxicity_model(spark, docs, sf_dir)
    return toxicity.drop_toxic(docs, model, threshold=0.3).select(*COLUMNS)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near copies stays."""
    return simhash.drop_near_duplicates(docs, shingle_words=3, radius=2).select(*COLUMNS)


def remove_benchmark_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item, or a whole shorter one, go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminate(docs, benchmark, window=10).select(*COLUMNS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows the new text."""
    found = pii.fit_and_redact(docs)
    length = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
    return found.withColumn("n_chars", length.cast("long")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their places in sequences."""
    return packing.pack_documents(
        docs,
        public_tokenizers.path("word_bpe_49k.json"),
        capacity=4096,
        end_id=1,
        content={"ids_crc32": F.crc32("ids")},
    )


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", keep_one_of_near_copies),
    ("decontamination", remove_benchmark_documents),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

#: SQL has neither the models nor the hash of the shingles nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next reads it.

    What a stage staged itself goes when it is written, and its input when its output is. The result
    reads the last but one stage's output and the tables of the last, which stay.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, step in STAGES[:-1]:
        written = shared_folder(spark, f"pipeline-{name}")
        with temporary_tables(spark):
            out = step(spark, docs, sf_dir)
            out.write.parquet(written)
        if before:
            delete_folder(spark, before)
        docs, before = spark.read.schema(out.schema).parquet(written), written
    return STAGES[-1][1](spark, docs, sf_dir)
