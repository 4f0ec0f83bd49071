"""Price-source priority.

The priority is data (a small, fixed table), so it is applied as a map
lookup rather than a chain of string comparisons; unknown sources get the
fallback rank.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Source priority, lower wins (fixed values).
SOURCE_PRIORITY: dict[str, int] = {
    "ANBIMA": 1,
    "B3": 2,
    "CETIP": 3,
    "BLOOMBERG": 4,
    "BACEN": 5,
}
UNKNOWN_SOURCE_PRIORITY = 99


def source_priority(source: str | Column, priorities: dict[str, int] | None = None,
                    unknown: int = UNKNOWN_SOURCE_PRIORITY) -> Column:
    table = SOURCE_PRIORITY if priorities is None else priorities
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    s = F.col(source) if isinstance(source, str) else source
    return F.coalesce(F.try_element_at(m, s), F.lit(unknown)).cast("int")


def sql_source_priority(source: str, priorities: dict[str, int] | None = None,
                        unknown: int = UNKNOWN_SOURCE_PRIORITY) -> str:
    table = SOURCE_PRIORITY if priorities is None else priorities
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in table.items())
    return f"(CASE {source} {whens} ELSE {unknown} END)"
