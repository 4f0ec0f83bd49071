"""Numeric helpers: tolerant parsing, sign classes, money products."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Sign classes of a difference (fixed values).
POSITIVE = "positivo"
NEGATIVE = "negativo"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_decimal(c: str | Column, precision: int = 18, scale: int = 6) -> Column:
    """Text to decimal; ``N/A`` or any malformed text becomes NULL (ANSI-safe)."""
    return _c(c).try_cast(T.DecimalType(precision, scale))


def money_product(a: str | Column, b: str | Column, scale: int = 2) -> Column:
    """``a * b`` rounded HALF_UP to ``scale`` (exact decimal product, then one rounding)."""
    return (_c(a) * _c(b)).cast(T.DecimalType(38, scale))


def sign_class(v: str | Column) -> Column:
    """``positivo`` for >= 0, ``negativo`` below; NULL stays NULL."""
    x = _c(v)
    return F.when(x >= 0, F.lit(POSITIVE)).when(x < 0, F.lit(NEGATIVE))
