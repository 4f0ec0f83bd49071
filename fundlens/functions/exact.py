"""Exact decimal ratios.

Shares, percentages and unit prices are quotients of DECIMAL sums. Spark's
decimal division rounds to an engine-chosen scale and doubles drift in the last
bit, so "round(100 * a / b, 2)" can differ by one unit between engines or
between two plans. ``round_ratio`` computes the HALF_UP rounded quotient with
integer division on exact decimals (``div``), so the result is the same
whatever the partitioning, the summation order or the engine.

``sql_round_ratio`` writes the same computation as DuckDB SQL text; it is used
only to build the oracle queries of ``__spark_entry__``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def round_ratio(num: Column, den: Column, scale: int, times: int = 1,
                precision: int = 38) -> Column:
    """HALF_UP ``round(times * num / den, scale)`` as ``decimal(precision, scale)``.

    NULL when ``den`` is NULL or zero (instead of the ANSI division error).
    """
    n = F.abs(num)
    d = F.abs(den)
    q = F.call_function("div", n * F.lit(2 * times * 10 ** scale) + d, d * F.lit(2))
    q = F.when(d > 0, q)
    signed = q * F.when((num < 0) != (den < 0), F.lit(-1)).otherwise(F.lit(1))
    unit = F.lit(Decimal(1).scaleb(-scale)) if scale else F.lit(Decimal(1))
    return (signed.cast(T.DecimalType(20, 0)) * unit).cast(T.DecimalType(precision, scale))


def sql_round_ratio(num: str, den: str, scale: int, times: int = 1, num_scale: int = 2,
                    den_scale: int = 2, precision: int = 38) -> str:
    """DuckDB text of :func:`round_ratio`; operands are exact decimals of the given scales."""
    s = max(num_scale, den_scale)
    n = f"CAST(abs({num}) * {10 ** s} AS HUGEINT)"
    d = f"CAST(abs({den}) * {10 ** s} AS HUGEINT)"
    q = f"(({n}) * {2 * times * 10 ** scale} + ({d})) // (2 * ({d}))"
    signed = (f"CASE WHEN ({d}) IS NULL OR ({d}) = 0 THEN NULL "
              f"WHEN (({num}) < 0) <> (({den}) < 0) THEN -({q}) ELSE {q} END")
    unit = f"CAST('{Decimal(1).scaleb(-scale):f}' AS DECIMAL({max(scale, 1)},{scale}))"
    return f"CAST(CAST({signed} AS DECIMAL(20,0)) * {unit} AS DECIMAL({precision},{scale}))"


def sum_exact(col: str | Column, scale: int, precision: int = 38) -> Column:
    """``sum`` of a decimal column, typed ``decimal(precision, scale)``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c).cast(T.DecimalType(precision, scale))


def sum_small(col: str, type_: T.DecimalType) -> Column:
    """``sum(col)`` as ``type_``, the type of the column, of at most 18 digits: its unscaled values are summed as
    integers, a third of the bytes of a decimal sum in a shuffle. A sum beyond ``type_`` is an error either way."""
    unit = F.lit(Decimal(1).scaleb(-type_.scale))
    total = F.sum((F.col(col).cast(type_) * F.lit(10 ** type_.scale)).cast("long"))
    return (total.cast(T.DecimalType(20, 0)) * unit).cast(type_)


def millions(v: Column, scale: int = 2) -> Column:
    """Money in millions, HALF_UP to ``scale`` places (exact: a decimal shift)."""
    return round_ratio(v, F.lit(1_000_000), scale)
