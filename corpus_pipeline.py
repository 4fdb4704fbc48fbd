"""A training corpus from raw documents: quality, line dedup, near-dedup, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as Parquet and read
again as the documents of the next one. All but the last keep the columns of documents, whatever
further columns there are and however they are called: operators see names of the pipeline's own.

Null texts are empty texts. Rows with null or repeated ids are judged by their own text; a repeated
row of one id and text goes in near_dedup. Texts of any length are used whole. Empty tables stay empty."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm.common import saved
from tallyworks.llm.decontamination import without_contaminated
from tallyworks.llm.line_dedup import dedup_lines
from tallyworks.llm.packing import packed
from tallyworks.llm.quality import accepted, train
from tallyworks.llm.simhash import RADIUS, SHINGLE, one_of_each


OWN = ("doc_id", "text", "n_chars")


def _renamed(docs: DataFrame) -> DataFrame:
    """The columns that stages read under their own names, the others as column_0, column_1, ..."""
    return docs.toDF(*[c if c in OWN else f"column_{i}" for i, c in enumerate(docs.columns)])


def _named_like(kept: DataFrame, docs: DataFrame) -> DataFrame:
    return kept.select(*_renamed(docs).columns).toDF(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    plain = _renamed(docs)
    return _named_like(accepted(plain, train(plain, labels)), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat an earlier one; n_chars counts what is left."""
    cleaned = dedup_lines(_renamed(docs))
    if "n_chars" in docs.columns:
        length = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
        cleaned = cleaned.withColumn("n_chars", F.coalesce(length, "n_chars"))
    return _named_like(cleaned, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints of three-word shingles differ in at most two bits."""
    return _named_like(one_of_each(_renamed(docs), radius=RADIUS, size=SHINGLE), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _named_like(without_contaminated(_renamed(docs), items), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# The classifier is trained, and tokens come from a vocabulary file: no SQL says that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = saved(docs, f"pipeline-{name}")
    return docs
