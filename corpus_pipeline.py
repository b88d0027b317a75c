"""From raw documents to packed training sequences, in five stages.

Each stage is a function (spark, docs, folder) -> frame that works on all rows its
predecessor kept; ``run`` writes each result to the shared folder and reads it again, so a
lost executor costs a task, not the stages before. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.llm.common import table
from tidewatch.llm.line_dedup import LEAST_PAGES, RATIO, drop_boilerplate
from tidewatch.llm.mixing import SEED, example_weights, mix_sources
from tidewatch.llm.near_dup import keep_one_per_group
from tidewatch.llm.packing import SEQUENCE_TOKENS, pack_documents, tokenizer_path
from tidewatch.llm.quality_zstd import document_model, reject_low_quality
from tidewatch.sources.work import WorkTables


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the compression classifier rejects go; it learns from the labels at hand."""
    return reject_low_quality(docs, document_model(spark, folder, docs))


def line_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Boilerplate lines of each source go; ``n_chars`` follows. No document goes."""
    cleaned = drop_boilerplate(docs, host="source", ratio=RATIO, least_pages=LEAST_PAGES)
    length = F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long"))
    return cleaned.withColumn("n_chars", F.coalesce(length, "n_chars")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the smallest id."""
    return keep_one_per_group(docs)


def mixing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents in the number of copies the mixture asks for, in a global shuffled order."""
    return mix_sources(docs, example_weights(docs), seed=SEED).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Places of all documents' pieces in sequences of at most 2,048 tokens."""
    return pack_documents(docs, tokenizer_path(), SEQUENCE_TOKENS)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("near-duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

# A trained classifier and a tokenizer are beyond SQL; tests hold the stages to plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs, tables = table(spark, folder, "documents"), WorkTables(spark)
    for number, (_, stage) in enumerate(STAGES):
        docs = tables.write(stage(spark, docs, folder), f"stage-{number}")
    return docs
