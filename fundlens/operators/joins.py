"""Dimension joins with a checked broadcast, orphan checks and miss audits.

A broadcast hint is given only after the dimension's row count is measured
and found under a bound; beyond it the join is left to the planner
(sort-merge, with AQE free to demote it to a broadcast from runtime sizes and
to split skewed partitions). Left joins keep every fact row as long as the
dimension key is unique, which ``operators.quality.unique_keys`` checks.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlens.sources.names import unused_names

log = logging.getLogger(__name__)

# Largest dimension broadcast to every executor: a row bound and a byte bound
# (rows times the schema's estimated row width).
DEFAULT_BROADCAST_MAX_ROWS = 2_000_000
DEFAULT_BROADCAST_MAX_BYTES = 256 * 1024 * 1024


# Estimated bytes per value, as Spark's defaults per type (fixed values).
_TYPE_WIDTH = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "date": 4, "float": 4, "long": 8,
               "double": 8, "timestamp": 8, "timestamp_ntz": 8, "string": 20, "binary": 100}
# Bytes taken for a text column whose lengths are not measured: the model's longest limit (100 characters).
_UNMEASURED_TEXT = 128


def row_width(df: DataFrame) -> int:
    """Estimated bytes per row from the schema (decimals 8 or 16, nested types 100)."""
    total = 8
    for f in df.schema.fields:
        t = f.dataType
        if isinstance(t, T.DecimalType):
            total += 8 if t.precision <= 18 else 16
        else:
            total += _TYPE_WIDTH.get(t.typeName(), 100)
    return total


def measured_size(dim: DataFrame, counted: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``dim``, from one scan of ``counted``, a frame with the same rows:
    fixed widths from the schema plus the measured bytes of the text columns."""
    texts = [f.name for f in counted.schema.fields if isinstance(f.dataType, T.StringType) and f.name in dim.columns]
    sums = [F.sum(F.octet_length(c)).alias(f"_b{i}") for i, c in enumerate(texts)]
    row = counted.agg(F.count(F.lit(1)).alias("_n"), *sums).first()
    others = sum(isinstance(f.dataType, T.StringType) for f in dim.schema.fields) - len(texts)
    text_width = _TYPE_WIDTH["string"]
    fixed = row_width(dim) - (len(texts) + others) * text_width + len(texts) * 16 + others * _UNMEASURED_TEXT
    return row["_n"], row["_n"] * fixed + sum(row[f"_b{i}"] or 0 for i in range(len(texts)))


def broadcast_if_bounded(dim: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
                         name: str = "dimension", force: bool | None = None,
                         max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES,
                         rows_from: DataFrame | None = None) -> DataFrame:
    """``broadcast(dim)`` when its measured row count is at most ``max_rows`` and
    rows x estimated row width (of ``dim``) is at most ``max_bytes``.

    Text columns count with their measured bytes (summed in the same scan as the rows).
    ``force=True`` skips the count for a side whose bound is known by
    construction; ``force=False`` never hints. The count is one scan of the
    dimension only; ``rows_from`` names a cheaper frame with the same rows to
    count instead (the left side of the left joins on unique keys that built
    ``dim``, e.g. the asset table for asset + issuer).
    """
    if force is True:
        return F.broadcast(dim)
    if force is False:
        return dim
    return F.broadcast(dim) if fits_broadcast(dim, max_rows, name, max_bytes, rows_from) else dim


def fits_broadcast(dim: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS, name: str = "dimension",
                   max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES, rows_from: DataFrame | None = None) -> bool:
    """Whether the measured size of ``dim`` is within the bounds of :func:`broadcast_if_bounded`."""
    n, size = measured_size(dim, rows_from if rows_from is not None else dim)
    small = n <= max_rows and size <= max_bytes
    log.info("%s has %d rows (~%d bytes): %s", name, n, size, "broadcast" if small else "shuffle join")
    return small


# Hot-key splitting: a key is hot above this many fact rows (about one task's
# worth at 100-byte rows and 128 MB). The threshold stays there up to a fact of
# DEFAULT_HOT_MIN_ROWS x DEFAULT_MAX_HOT_KEYS rows (10^12), where the list of hot
# keys reaches the bound that keeps it broadcastable (a few tens of bytes each).
DEFAULT_HOT_MIN_ROWS = 1_000_000
DEFAULT_MAX_HOT_KEYS = 1_000_000
# Buckets of key hashes counted before the keys themselves: a bucket of at most the hot threshold holds no hot key.
HOT_BUCKETS = 8192


def hot_keys(fact: DataFrame, keys: Sequence[str], min_rows: int = DEFAULT_HOT_MIN_ROWS,
             max_keys: int = DEFAULT_MAX_HOT_KEYS) -> DataFrame:
    """``(*keys, _salts)`` for every key holding more than ``t = max(min_rows, rows / max_keys)``
    fact rows, with ``_salts = ceil(rows of the key / t)``.

    The keys are counted exactly, but only those of heavy buckets: rows are first counted by a hash of
    their keys (at most ``HOT_BUCKETS`` counts a task, and the total), and a key in a bucket of at most ``t`` rows
    cannot be hot. So the near unique keys of a fact without hot keys are not shuffled. ``fact`` may hold
    more rows per key than the join's (a key wrongly taken for hot is only split needlessly). Each hot key
    holds more than ``t`` rows, so there are fewer than ``max_keys`` of them: the list has a proven size bound.
    """
    keys = list(keys)
    rows = fact.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(HOT_BUCKETS)).alias("_bucket"))
    heavy = _above(rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows")), "_rows", min_rows, max_keys)
    # at most HOT_BUCKETS rows
    counts = (rows.join(F.broadcast(heavy.select("_bucket", "_t")), "_bucket")
              .groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.max("_t").alias("_t")))
    return _salts(counts.filter(F.col("_n") > F.col("_t")), keys, "_n")


def hot_from_counts(counts: DataFrame, keys: Sequence[str], count_col: str,
                    min_rows: int = DEFAULT_HOT_MIN_ROWS, max_keys: int = DEFAULT_MAX_HOT_KEYS) -> DataFrame:
    """:func:`hot_keys` from an aggregate the plan already has: ``counts`` holds one row
    per key and ``count_col``, the key's fact rows or an upper bound of them (a key
    wrongly taken for hot is only split needlessly)."""
    keys = list(keys)
    return _salts(_above(counts, count_col, min_rows, max_keys), keys, count_col)


def _above(counts: DataFrame, count_col: str, min_rows: int, max_keys: int) -> DataFrame:
    """The rows of ``counts`` above ``t``, in ``_t``. The total is joined (one row), not a scalar subquery: plans that
    hold a subquery are never recognised as equal, and a frame used twice would be computed twice."""
    total = counts.agg(F.sum(count_col).alias("_total"))
    t = F.greatest(F.lit(min_rows).cast("long"), F.ceil(F.col("_total") / F.lit(max_keys)).cast("long"))
    return (counts.filter(F.col(count_col) > min_rows).crossJoin(F.broadcast(total))
            .withColumn("_t", t).drop("_total").filter(F.col(count_col) > F.col("_t")))


def _salts(hot: DataFrame, keys: Sequence[str], count_col: str) -> DataFrame:
    return hot.select(*keys, F.ceil(F.col(count_col) / F.col("_t")).cast("int").alias("_salts"))


def salted_join(fact: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "left",
                hot: DataFrame | None = None, min_rows: int = DEFAULT_HOT_MIN_ROWS,
                max_keys: int = DEFAULT_MAX_HOT_KEYS) -> DataFrame:
    """``fact.join(side, keys, how)`` with the fact's hot keys split over several tasks.

    Adaptive execution can split a hot shuffle partition only when both join
    inputs are plain shuffles; when one side is an aggregate whose partitioning
    the join reuses (a deduplicated price table, distinct parent keys), or when
    the hot rows come from one upstream task, it cannot. Here the rows of each hot
    key (``hot``, by default :func:`hot_keys` of ``fact``) get a salt
    ``hash(row) mod _salts`` and the side's rows of that key are repeated once per
    salt value; every other key has salt 0 on both sides. The join on
    ``(keys, salt)`` gives every fact row exactly the partners it has in the plain
    join (``how`` in left, inner, left_semi, left_anti), and a hot key's rows spread
    over up to ``_salts`` tasks of about the hot threshold each (identical rows
    share a salt).
    """
    keys = list(keys)
    hot = hot_keys(fact, keys, min_rows, max_keys) if hot is None else hot
    salted_fact = (_with_salts(fact, hot, keys)
                   .withColumn("_salt", F.when(F.col("_salts").isNotNull(),
                                               F.pmod(F.xxhash64(*fact.columns), F.col("_salts")))
                               .otherwise(F.lit(0)).cast("int"))
                   .drop("_salts"))
    replicas = F.when(F.col("_salts").isNotNull(), F.sequence(F.lit(0), F.col("_salts") - 1)) \
        .otherwise(F.array(F.lit(0)))
    salted_side = (_with_salts(side, hot, keys)
                   .withColumn("_salt", F.explode(replicas))
                   .drop("_salts"))
    return salted_fact.join(salted_side, [*keys, "_salt"], how).drop("_salt")


def _with_salts(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` plus the ``_salts`` of its key (NULL when not hot). The lookup is
    null-safe, so a hot group of NULL keys, which matches nothing in the join but
    would still land in one shuffle partition, is spread as well."""
    h = hot.select(*[F.col(k).alias(f"_h_{k}") for k in keys], "_salts")
    on = [df[k].eqNullSafe(h[f"_h_{k}"]) for k in keys]
    # fewer than max_keys rows by construction (see hot_from_counts)
    return df.join(F.broadcast(h), on, "left").drop(*[f"_h_{k}" for k in keys])


def left_enrich(fact: DataFrame, dim: DataFrame, keys: Sequence[str] | str,
                flag: str | None = None) -> DataFrame:
    """Left join keeping every fact row; ``flag`` adds a boolean 'dimension matched'."""
    if flag:
        dim = dim.withColumn(flag, F.lit(True))
    out = fact.join(dim, on=keys, how="left")
    if flag:
        out = out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    return out


def left_lookup(fact: DataFrame, side: DataFrame, keys: Sequence[str], flag: str | None = None) -> DataFrame:
    """:func:`left_enrich` with a ``side`` of at most one row per key, when both lie hash-partitioned by the same some of ``keys``.

    A join shuffles both sides again unless they are partitioned by all of its keys. A window may use a partitioning by some
    of them: the rows of both are put together and sorted by key, the side's row first, and each fact row takes the first
    row's columns. Nothing is shuffled and the result lies as before, in the order of ``keys`` (a union keeps the partitioning of
    its sides since Spark 4.1; otherwise its rows are shuffled, with the same result). Not for hot keys: the rows of a key are
    one task's work.
    """
    keys, columns = list(keys), fact.columns
    wanted = [c for c in side.columns if c not in keys]
    (from_side,) = unused_names([*columns, *side.columns, *([flag] if flag else [])], 1)
    # NULL keys match nothing
    known = reduce(and_, [F.col(k).isNotNull() for k in keys])
    both = fact.withColumn(from_side, F.lit(False)).unionByName(
        side.filter(known).withColumn(from_side, F.lit(True)), allowMissingColumns=True)
    first = Window.partitionBy(*keys).orderBy(F.col(from_side).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = [F.first(c).over(first).alias(c) for c in wanted] + ([F.first(from_side).over(first).alias(flag)] if flag else [])
    out = both.select(*columns, from_side, *found).filter(~F.col(from_side))
    return out.select(*keys, *[c for c in columns if c not in keys], *wanted, *([flag] if flag else []))


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose foreign key has no parent (NULL keys are not orphans).

    An anti join only tests existence, so the parent keys are not deduplicated:
    both inputs stay plain shuffles, which lets adaptive execution split a hot
    child key (a fund holding a third of the positions)."""
    p = parent.select(F.col(parent_key).alias("_pk"))
    return (child.filter(F.col(child_key).isNotNull())
                 .join(p, F.col(child_key) == F.col("_pk"), "left_anti"))


def count_orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str,
                  relation: str) -> DataFrame:
    return (orphans(child, child_key, parent, parent_key)
            .agg(F.count(F.lit(1)).alias("n_orfaos"))
            .select(F.lit(relation).alias("relacao"), "n_orfaos"))


def new_keys(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows whose natural key is absent from ``target`` (an existence test: the
    target's keys are not deduplicated, so both inputs stay plain shuffles)."""
    return batch.join(target.select(*keys), on=list(keys), how="left_anti")
