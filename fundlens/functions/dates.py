"""Date helpers: ISO text, tolerant parsing, business-day spines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

ISO_DATE = "yyyy-MM-dd"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_date(c: str | Column) -> Column:
    """Date rendered as ``yyyy-MM-dd``."""
    return F.date_format(_c(c), ISO_DATE)


def parse_date(c: str | Column) -> Column:
    """Text to date; malformed text becomes NULL instead of failing the job."""
    return F.try_to_date(_c(c), ISO_DATE)


def is_weekday(c: str | Column) -> Column:
    """Monday to Friday (``weekday`` is 0 for Monday)."""
    return F.weekday(_c(c)) < 5


def last_weekday_on_or_before(c: str | Column) -> Column:
    d = _c(c)
    wd = F.weekday(d)
    return F.when(wd == 5, F.date_sub(d, 1)).when(wd == 6, F.date_sub(d, 2)).otherwise(d)


def business_day_spine(keys: DataFrame, end_col: str, n_days: int, out_col: str = "data") -> DataFrame:
    """``n_days`` weekdays ending on ``end_col`` (or on the weekday before it), one row each.

    ``keys`` holds one row per series (e.g. per asset) with its end date; each
    key explodes into a bounded calendar range, so the output grows linearly
    with the number of keys. When ``n_days`` is a multiple of five the range is
    exact (any ``7 * n_days / 5`` consecutive days hold ``n_days`` weekdays) and
    no ranking is needed; otherwise the newest ``n_days`` weekdays of a slightly
    longer range are kept with a window over groups of bounded size.
    """
    end = last_weekday_on_or_before(end_col)
    exact = n_days % 5 == 0
    span = 7 * n_days // 5 - 1 if exact else 7 * (n_days // 5 + 2)
    exploded = (keys
                .withColumn("_end", end)
                .withColumn(out_col, F.explode(F.sequence(F.date_sub(F.col("_end"), span), F.col("_end"))))
                .filter(is_weekday(out_col)))
    if exact:
        return exploded.drop("_end", end_col)
    key_cols = [c for c in keys.columns if c != end_col]
    w = Window.partitionBy(*key_cols).orderBy(F.col(out_col).desc())
    return (exploded
            .withColumn("_k", F.row_number().over(w))
            .filter(F.col("_k") <= n_days)
            .drop("_k", "_end", end_col))
