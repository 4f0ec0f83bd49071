"""Text helpers: short names, placeholders, formatted money, rating buckets.

All are native Column expressions (no Python UDF), so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundlens.functions.exact import millions

# Placeholders of the rendered flat view (fixed values).
NA = "N/A"
UNDEFINED_MATURITY = "INDEFINIDO"
NOT_RATED = "NR"

# Fund-name suffixes dropped by the short name: FI, FIM, FIA, FIE (fixed values).
FUND_SUFFIX_PATTERN = r" (FI|FIM|FIA|FIE)$"

# Rating buckets of the credit charts; any other rating falls in "other" (fixed values).
RATING_BUCKETS = ("AAA", "AA", "A+", "BBB+", "NR")
RATING_OTHER = "OUTROS"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def with_placeholder(c: str | Column, placeholder: str) -> Column:
    """NULL rendered as a fixed placeholder (``N/A``, ``NR``, ``INDEFINIDO``)."""
    return F.coalesce(_c(c), F.lit(placeholder))


def fund_short_name(name: str | Column, drop_prefix: str | None = None) -> Column:
    """Fund name without its legal suffix (`` FI``/`` FIM``/`` FIA``/`` FIE``).

    Only a whole trailing suffix is removed, so ``... Macro FIM`` becomes
    ``... Macro`` (not ``... MacroM``). ``drop_prefix`` optionally strips a
    leading house name such as ``"Casa "``.
    """
    out = F.regexp_replace(_c(name), FUND_SUFFIX_PATTERN, "")
    if drop_prefix:
        out = F.when(F.startswith(out, F.lit(drop_prefix)),
                     F.substring(out, len(drop_prefix) + 1, 1 << 20)).otherwise(out)
    return out


def issuer_short_name(name: str | Column, width: int = 22, cut_dash: bool = True) -> Column:
    """Issuer name cut before `` S.A.`` (and, with ``cut_dash``, before `` -``),
    then to ``width`` characters."""
    cut = F.substring_index(_c(name), " S.A.", 1)
    if cut_dash:
        cut = F.substring_index(cut, " -", 1)
    return F.substring(cut, 1, width)


def truncate(c: str | Column, width: int) -> Column:
    return F.substring(_c(c), 1, width)


def rating_bucket(rating: str | Column) -> Column:
    """Rating grouped for the credit charts: AAA, AA (any AA grade), A+, BBB+, NR, else OUTROS."""
    r = with_placeholder(rating, NOT_RATED)
    return (F.when(r == "AAA", "AAA")
             .when(F.startswith(r, F.lit("AA")), "AA")
             .when(r == "A+", "A+")
             .when(r == "BBB+", "BBB+")
             .when(r == NOT_RATED, NOT_RATED)
             .otherwise(RATING_OTHER))


def lookup(mapping: dict[str, str], key: str | Column, default: str) -> Column:
    """Map lookup with a default; ``try_element_at`` so an absent key is not an error."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(m, _c(key)), F.lit(default))


def money_text(v: str | Column, decimals: int = 2) -> Column:
    """``R$ 1,234,567.89`` style text."""
    return F.concat(F.lit("R$ "), F.format_number(_c(v), decimals))


def millions_text(v: str | Column, decimals: int = 1) -> Column:
    """``R$ 12.3M`` style text; rounded HALF_UP on the exact decimal, not on a double."""
    return F.concat(F.lit("R$ "), millions(_c(v), decimals).cast("string"), F.lit("M"))


def percent_text(v: str | Column, decimals: int = 1) -> Column:
    """``69.0%`` style text; rounded HALF_UP on the exact decimal, not on a double."""
    return F.concat(F.round(_c(v).cast("decimal(38,6)"), decimals).cast("string"), F.lit("%"))


def count_text(n: str | Column) -> Column:
    """``1,234,567`` style text."""
    return F.format_number(_c(n), 0)


def contains(c: str | Column, needle: str) -> Column:
    return F.contains(_c(c), F.lit(needle))
