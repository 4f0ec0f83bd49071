"""Helper column names that clash with no column of the data."""

from __future__ import annotations

from collections.abc import Sequence


def unused_names(columns: Sequence[str], count: int) -> list[str]:
    """``count`` column names that clash with none of ``columns``."""
    taken = {c.lower() for c in columns}
    free = (f"_h{i}" for i in range(len(taken) + count))
    return [n for n in free if n not in taken][:count]
