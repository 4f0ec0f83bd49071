"""Global order without a single-task window.

``Window.orderBy(...)`` with no ``partitionBy`` moves every row into one task.
``ordered_scan`` gives the same global position and running sums with the
work spread out:

1. ``repartitionByRange(n, order)`` and a sort inside each partition: partition
   ``p`` holds a contiguous slice of the order. Every row gets its partition id
   and its index there (``monotonically_increasing_id``: partition id in the
   upper bits, row index in the lower 33), and the rows are written once.
2. Per-partition totals (at most ``n`` rows, a bound fixed by the caller) come
   from the written rows, so they belong to the very rows they number; two
   separately sampled range partitionings never meet. They become offsets and
   grand totals and are broadcast back.
3. Running sums use a window per written partition.

The order must be total (end it with a unique column) for a deterministic
position.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlens.session import written


def _partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ordered_scan(df: DataFrame, order: Sequence[Column], sums: Mapping[str, Column] | None = None,
                 position: str = "posicao", totals: bool = False,
                 n_partitions: int | None = None) -> DataFrame:
    """Add ``position`` (1-based rank in ``order``) and, for each ``sums`` entry,
    a running total up to and including the row. ``totals=True`` also adds
    ``total_<name>``, the grand total of each summed column."""
    sums = dict(sums or {})
    n = _partitions(df, n_partitions)
    index = F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("long"), 33)
    ranged = written(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                     .withColumn("_pid", F.spark_partition_id()).withColumn("_lpos", index + 1), "ordered")
    scanned = ranged
    if sums:
        running = Window.partitionBy("_pid").orderBy("_lpos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        for name, c in sums.items():
            scanned = scanned.withColumn(f"_l_{name}", F.sum(c).over(running))

    per_part = ranged.groupBy("_pid").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_s_{name}") for name, c in sums.items()])
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = per_part.select(
        "_pid",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off_n"),
        *[F.sum(f"_s_{name}").over(before).alias(f"_off_{name}") for name in sums],
        *[F.sum(f"_s_{name}").over(everything).alias(f"_tot_{name}") for name in sums],
    )
    out = scanned.join(F.broadcast(offsets), "_pid", "left")
    out = out.withColumn(position, (F.col("_off_n") + F.col("_lpos")).cast("long"))
    for name in sums:
        out = out.withColumn(name, F.coalesce(F.col(f"_off_{name}") + F.col(f"_l_{name}"), F.col(f"_l_{name}")))
        if totals:
            out = out.withColumn(f"total_{name}", F.col(f"_tot_{name}"))
    helper = ["_pid", "_lpos", "_off_n"] + [f"_l_{k}" for k in sums] + [f"_off_{k}" for k in sums] \
        + [f"_tot_{k}" for k in sums]
    return out.drop(*helper)


def with_previous(df: DataFrame, order: Sequence[Column], cols: Sequence[str], prefix: str = "prev_",
                  n_partitions: int | None = None) -> DataFrame:
    """``lag(c)`` over the global ``order`` for each of ``cols`` (``prefix + c``,
    NULL on the first row) without a single-task window: rows get their global
    position from :func:`ordered_scan` and meet their predecessor through an
    equi-join on ``position - 1``."""
    scanned = ordered_scan(df, order, position="_gpos", n_partitions=n_partitions)
    prev = scanned.select((F.col("_gpos") + 1).alias("_gpos"), *[F.col(c).alias(prefix + c) for c in cols])
    return scanned.join(prev, "_gpos", "left").drop("_gpos")


def first_reaching(scanned: DataFrame, running_col: str, threshold: float | int | Column,
                   position: str = "posicao") -> DataFrame:
    """The first row (smallest position) whose running value reaches ``threshold``."""
    t = threshold if isinstance(threshold, Column) else F.lit(threshold)
    hits = scanned.filter(F.col(running_col) >= t)
    return hits.orderBy(position).limit(1)


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """First ``k`` rows in ``order`` (per-partition top-k, then one small merge)."""
    return df.orderBy(*order).limit(k)
