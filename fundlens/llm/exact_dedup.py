"""Exact dedup by content-defined chunk recipes (DataFrame functions only).

1. Every text is cut at content-defined places: a cut follows three characters of
   fixed classes (about one place in a thousand in prose), at least ``MIN_CHUNK`` and at
   most ``MAX_CHUNK`` characters after the last cut. Cuts depend on nearby characters
   alone, so equal passages give equal chunks wherever they stand; the chunks of a text
   always add up to the whole text.
2. A chunk's identifier is its 64-bit hash. The identifiers are verified: one
   aggregation per hash compares the smallest and the largest chunk text. The chunk
   bytes move once (combined on the map side, so a chunk that thousands of documents
   share moves once per task). A hash with two different texts is a collision, and the
   chunks under it get their SHA-256 as a further identifier.
3. Texts are equal exactly when their ordered identifier lists are equal. Lists (8
   bytes per thousand characters) are grouped and joined instead of the texts.

A group of copies that holds a third of all rows is combined map-side when it is
counted, and the join back reads two written tables over plain exchanges, which
adaptive execution splits. Null text counts as empty; empty texts equal each other. Of
rows repeating the largest ``doc_id`` one stays (the largest row number); a null
``doc_id`` ranks below every other. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.llm.common import staged, text_or_empty, without
from fundlens.sources.names import unused_names

MIN_CHUNK = 512
MAX_CHUNK = 4096

#: The three character classes that end a chunk, a part of the letters each, in any script.
_CUT = r"(?<=[aenAENа-к一-拿][dhlsDHLS !а-к挀-瓿][befmtBEFMTр-ъ甀-迿])"


def chunk_pattern(min_chunk: int = MIN_CHUNK, max_chunk: int = MAX_CHUNK) -> str:
    return rf"(?s).{{{min_chunk},{max_chunk}}}?{_CUT}|(?s).{{1,{max_chunk}}}"


def chunks(text: Column, min_chunk: int = MIN_CHUNK, max_chunk: int = MAX_CHUNK) -> Column:
    """The content-defined chunks of a text in order; they concatenate to the text."""
    return F.regexp_extract_all(text, F.lit(chunk_pattern(min_chunk, max_chunk)), F.lit(0))


def recipes(docs: DataFrame, hashed: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per document: ``row_no, doc_id, text_sha256, ids, extra``.

    ``ids`` is the ordered list of chunk hashes; ``extra`` the SHA-256 of the chunks whose
    hash stands for several texts, in order (empty without collisions). Equal texts and
    no others have equal ``(ids, extra)``.
    """
    text = text_or_empty()
    base = staged(docs.select(F.monotonically_increasing_id().alias("row_no"), F.col("doc_id"), text.alias("text"))
                  .select("row_no", "doc_id", F.sha2("text", 256).alias("text_sha256"),
                          F.transform(chunks(F.col("text")), lambda c: hashed(c)).alias("ids")), "recipes")
    cut = docs.select(text.alias("text")).filter(F.col("text") != "") \
        .select(F.explode(chunks(F.col("text"))).alias("chunk")) \
        .select(hashed(F.col("chunk")).alias("id"), "chunk")
    bad = staged(cut.groupBy("id").agg(F.min("chunk").alias("lo"), F.max("chunk").alias("hi"))
                 .filter(F.col("lo") != F.col("hi")).select("id"), "collisions")
    # Documents under a collision get the SHA-256 of those chunks; found by text hash, as row
    # numbers of two scans need not agree. Without collisions `bad` is empty and nothing runs.
    fixes = (docs.select(F.sha2(text, 256).alias("text_sha256"), F.posexplode(chunks(text)).alias("pos", "chunk"))
             .select("text_sha256", "pos", hashed(F.col("chunk")).alias("id"), "chunk")
             .join(bad, "id")
             .select("text_sha256", "pos", F.sha2("chunk", 256).alias("sha")).distinct()
             .groupBy("text_sha256").agg(F.array_sort(F.collect_list(F.struct("pos", "sha"))).alias("found"))
             .select("text_sha256", F.transform("found", lambda x: x["sha"]).alias("extra")))
    if bad.isEmpty():
        return base.withColumn("extra", F.array().cast("array<string>"))
    return staged(base.join(fixes, "text_sha256", "left")
                  .withColumn("extra", F.coalesce("extra", F.array().cast("array<string>"))), "recipes-fixed")


def exact_dedup(docs: DataFrame, hashed: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256, n_chunks, row_no``."""
    rows = recipes(docs, hashed).withColumn("recipe_hash", F.xxhash64("ids", "extra"))
    keys = ["recipe_hash", "ids", "extra"]
    groups = staged(rows.groupBy(*keys).agg(F.max(F.struct("doc_id", "row_no")).alias("keep"),
                                            F.count(F.lit(1)).alias("group_size"))
                    .filter(F.col("group_size") > 1)
                    .select(*keys, F.col("keep.doc_id").alias("keep_id"), F.col("keep.row_no").alias("keep_row"),
                            "group_size"), "copies")
    return (rows.join(groups, keys, "left")
            .select("doc_id",
                    F.when(F.col("keep_row").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                    F.coalesce(F.col("row_no") == F.col("keep_row"), F.lit(True)).alias("kept"),
                    "text_sha256", F.size("ids").alias("n_chunks"), "row_no"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of every group of equal texts, all columns and names as they are."""
    found = staged(exact_dedup(docs).select("doc_id", "text_sha256", "kept"), "dedup-marks")
    (row,) = unused_names(docs.columns, 1)
    if found.groupBy("doc_id", "text_sha256").count().filter("count > 1").limit(1).count() == 0:
        return without(docs, [F.col("doc_id"), F.sha2(text_or_empty(), 256)], found.filter("NOT kept").select("doc_id", "text_sha256"))
    # Rows repeat an id with its text: number the rows in a written table and keep by number.
    stable = staged(docs.withColumn(row, F.monotonically_increasing_id()), "dedup-input")
    by_row = exact_dedup(stable.select(F.struct("doc_id", F.col(row).alias("row")).alias("doc_id"), "text")).filter("kept")
    return stable.join(by_row.select(F.col("doc_id.row").alias(row)), row, "left_semi").drop(row)
