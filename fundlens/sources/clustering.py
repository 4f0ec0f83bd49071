"""Row order for data skipping: rows near each other in several columns at once.

Parquet readers skip files, row groups and pages whose minimum and maximum exclude a filter's value. Sorting by
(fund, asset) lets only filters on the fund skip. ``interleaved`` gives every row the interleaved bits of
its ranks in all clustering columns, and files cut along that order hold a small range of each.

The rank of a value is its place in the column's order counted in rows, so each rank range holds about the same number of
rows however the values are spread. It comes from a count per value (combined map-side) numbered by
``ordered_scan``; nothing of the rows themselves is sorted for it, and a value on a third of the
rows is one entry. Ranks rise with the values, so the least value of each rank, at most 2^bits of them, says the rank of every
value: a row finds its rank by a binary search in that list and is neither joined nor shuffled for it, however many values there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlens.operators.ordered import ordered_scan
from fundlens.sources.names import unused_names

#: Bits of a rank: 4,096 ranges a column.
BITS = 12


def value_ranks(df: DataFrame, col: str, bits: int = BITS) -> DataFrame:
    """``valor, faixa``: the range (0 to 2^bits - 1) of rows, in the order of ``col``, in which each value starts."""
    counts = df.groupBy(F.col(col).alias("valor")).agg(F.count(F.lit(1)).alias("n"))
    placed = ordered_scan(counts, [F.col("valor").asc_nulls_first()], {"ate": F.col("n")}, totals=True)
    return placed.select("valor", F.floor((F.col("ate") - F.col("n")) * F.lit(1 << bits) / F.col("total_ate")).cast("long").alias("faixa"))


def interleave(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of the ranks in turn, the highest first."""
    out = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for r in ranks:
            out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(r, bit).bitwiseAND(F.lit(1).cast("long")))
    return out


def _ranked(df: DataFrame, col: str) -> Column:
    """``col`` in a type whose values come to the driver and go back unchanged, in the same order (times and others: as text)."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.BinaryType):
        return F.hex(col)
    return F.col(col) if isinstance(kind, (T.StringType, T.BooleanType, T.DateType, T.NumericType)) else F.col(col).cast("string")


def rank_of(df: DataFrame, col: str, bits: int = BITS) -> Column:
    """The rank (see :func:`value_ranks`) of each row's ``col``: that of the last rank whose least value is not above it."""
    value = _ranked(df, col)
    ranks = value_ranks(df.select(value.alias("v")), "v", bits)
    # at most 2^bits rows; NULL comes first, so its rank is 0
    starts = sorted(ranks.filter("valor IS NOT NULL").groupBy("faixa").agg(F.min("valor").alias("valor")).collect())
    least = F.array(*[F.lit(r["valor"]) for r in starts]).cast(T.ArrayType(ranks.schema["valor"].dataType))
    # Binary search for the last start not above the value (-1: none). Beyond the list and for NULL the comparison is
    # NULL, which is no step further.
    steps = F.array(*[F.lit(1 << b) for b in range(len(starts).bit_length() - 1, -1, -1)]).cast("array<int>")
    found = F.aggregate(steps, F.lit(-1), lambda at, step: F.when(F.get(least, at + step) <= value, at + step).otherwise(at))
    return F.get(F.array(*[F.lit(n).cast("long") for n in [0, *(r["faixa"] for r in starts)]]), found + 1)


def interleaved(df: DataFrame, cols: Sequence[str], out: str, bits: int = BITS) -> DataFrame:
    """``df`` with the interleaved ranks of ``cols`` (at most five) in ``out``."""
    if not 1 <= len(cols) * bits <= 62:
        raise ValueError("the ranks of all columns must fit into 62 bits")
    columns = df.columns
    names = unused_names([*columns, out], len(cols))
    ranked = df.select(*columns, *[rank_of(df, c, bits).alias(n) for c, n in zip(cols, names, strict=True)])
    return ranked.select(*columns, interleave([F.col(n) for n in names], bits).alias(out))


def clustered(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str], n_parts: int) -> DataFrame:
    """``df`` in about ``n_parts`` range partitions, sorted along the interleaved order inside each partition value.
    The range key ends in the columns themselves, so a hot rank is still cut."""
    (key,) = unused_names(df.columns, 1)
    order = [*partition_by, key, *cluster_by]
    return interleaved(df, cluster_by, key).repartitionByRange(max(1, n_parts), *order).sortWithinPartitions(*order).drop(key)
