"""The bounded sample of labelled rows that classifiers learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.llm.common import crc_fold, text_or_empty

#: Labelled rows that a classifier learns from, at most (chosen by a hash of the id).
MAX_ROWS = 20_000


def training_rows(docs: DataFrame, labels: DataFrame, target: str, max_rows: int = MAX_ROWS,
                  hold_out: int | None = 0) -> DataFrame:
    """``doc_id, text, y`` of labelled documents: rows without an id or label are left out, a
    document with several labels takes the largest, and of more than ``max_rows`` those of the
    smallest id hashes are taken. With ``hold_out``, rows whose crc32(id) mod 5 equals it stay out."""
    own = labels.filter(F.col("doc_id").isNotNull() & F.col(target).isNotNull())
    if hold_out is not None:
        own = own.filter(crc_fold() != hold_out)
    own = own.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(target).cast("int").alias("y"))
    own = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return texts.join(F.broadcast(own), "doc_id")  # at most max_rows rows of two numbers
