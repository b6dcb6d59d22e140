"""From raw documents to packed training sequences, stage by stage.

quality -> lines -> near_duplicates -> decontamination -> packing. The first four return documents with all their
columns; the last one returns pieces of documents with their places in sequences.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scarmap.cluster import checkpoint_folder
from scarmap.llm.decontaminate import clean_documents
from scarmap.llm.lines import without_boilerplate
from scarmap.llm.minhash import near_duplicates
from scarmap.llm.packing import pack
from scarmap.llm.quality import select_documents
from scarmap.llm.shared import fresh, table

#: similarity in percent, on five-word shingles, from which documents are near duplicates here
ALIKE = 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the rated ones, takes for good."""
    return select_documents(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, lines that many sources share taken out of their texts."""
    return without_boilerplate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest doc_id.

    Rows that repeat a doc_id are one document and stay or go together; rows without doc_id stay.
    """
    gone = near_duplicates(docs, percent=ALIKE).where("not kept and doc_id is not null").select(F.col("doc_id").alias(name := fresh(docs, "gone"))).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of a benchmark item."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences and offsets."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


#: (name, function of (spark, docs, sf_dir)); what a stage returns is written as Parquet and read again by the next
STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near), ("decontamination", decontamination), ("packing", packing)]

#: no SQL can state the trained classifier and the packing search; tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other, from the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
