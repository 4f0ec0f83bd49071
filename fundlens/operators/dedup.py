"""Keep one row per key.

``first_per_key`` is an aggregate (the least of a struct), not a
``row_number`` window: the aggregate is combined map-side, so a key that holds
a third of all rows still ships one candidate row per map task instead of
sorting the whole key inside one reducer. Its buffer (a struct) is not
fixed-width, so Spark runs it as a sort-based aggregate, partial and final:
each task sorts its own rows by key (spilling if needed), never a whole key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per ``keys``: the row whose ``order`` tuple is smallest.

    ``order`` must make the choice total (end it with a unique column) for a
    deterministic result; NULLs sort first inside the tuple. When it is given as column names alone,
    the candidate is one struct that begins with them, so a column is not shuffled twice, as rank and as value;
    all columns must be orderable then.
    """
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    if all(isinstance(o, str) for o in order):
        first = [o for o in order if o not in keys]
        rest = [c for c in payload if c not in first]
        picked = df.groupBy(*keys).agg(F.min(F.struct(*first, *rest)).alias("_row"))
    else:
        rank = F.struct(*[(F.col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order)])
        picked = df.groupBy(*keys).agg(F.min_by(F.struct(*payload), rank).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in payload])
