"""The training-data pipeline: quality, exact dedup, near duplicates, decontamination, packing.

Each stage is a function of (spark, docs, sf_dir) whose result is written as Parquet and
read again as the next stage's ``docs``; all but the last return the columns of
``documents``. Documents that the quality model rejects go, of equal texts one stays, of
near duplicates one stays, documents that hold a benchmark item go, and the rest is packed
into windows of 2048 tokens. Every stage works on all that its predecessor kept; an empty
table passes through, and what happens to nulls, ties and repeated rows is stated in the
operators' modules. No SQL expresses the model, the edit matching or the tokenizer, so
``ORACLE_SQL`` is None and the tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fundlens.llm import decontamination, exact_dedup, ngram_join, packing, quality
from fundlens.llm.catalog import tokenizer_file
from fundlens.llm.common import read_table, ship
from fundlens.session import scratch_dir


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the additive model scores at its threshold or above."""
    return quality.keep_good(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the largest id, of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near duplicates."""
    return ngram_join.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item within the edit budget."""
    return decontamination.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def packing_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in windows of 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"), with_ids=False,
                                  max_pieces=packing.FEW_PIECES).drop("ids")


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_leaks),
    ("packing", packing_windows),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again."""
    ship(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_dir(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
