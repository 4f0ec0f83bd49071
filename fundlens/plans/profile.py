"""Profiling of the flat view: descriptive statistics, NULL profile, typing of text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens import schemas
from fundlens.functions.dates import parse_date
from fundlens.functions.numeric import parse_decimal
from fundlens.operators.quantiles import describe

NUMERIC = ("preco_unitario", "preco_mercado", "valor_financeiro", "percentual_pl")
# Numeric columns of the text view and their decimal types (fixed contract).
TEXT_NUMERIC = {"quantidade": (18, 6), "preco_unitario": (18, 6), "preco_mercado": (18, 6),
                "valor_financeiro": (18, 2), "percentual_pl": (9, 6)}


def describe_flat(flat: DataFrame, cols: Sequence[str] = NUMERIC, approx: bool = False) -> DataFrame:
    """count, mean, std, min, quartiles (linear, exact unless ``approx``), max of the numeric
    columns, 2 places."""
    return describe(flat, cols, approx=approx)


def shape(df: DataFrame) -> tuple[int, int]:
    """(rows, columns): one count action; the column count is metadata."""
    return df.count(), len(df.columns)


def shape_of(df: DataFrame) -> DataFrame:
    """``shape`` as a one-row DataFrame (rows counted by the cluster, columns from the schema)."""
    return df.agg(F.count(F.lit(1)).alias("n_linhas")).withColumn("n_colunas", F.lit(len(df.columns)))


def table_rows(frames: dict[str, DataFrame]) -> DataFrame:
    """``(tabela, n_linhas)`` for every table: one global count per table, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_linhas")).select(F.lit(name).alias("tabela"), "n_linhas")
             for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def null_profile(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """NULL count of every column in one aggregate pass; by default only columns with NULLs."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    entries = [F.struct(F.lit(c).alias("coluna"), F.col(c).cast("long").alias("n_nulos")) for c in df.columns]
    out = counts.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")
    return out.filter(F.col("n_nulos") > 0) if only_missing else out


def typed_from_text(text: DataFrame) -> DataFrame:
    """The text flat view with dates and numbers parsed back; ``N/A`` and bad text become NULL."""
    cols = []
    for c in schemas.FLAT_COLUMNS:
        if c == "data_posicao":
            cols.append(parse_date(c).alias(c))
        elif c in TEXT_NUMERIC:
            p, s = TEXT_NUMERIC[c]
            cols.append(parse_decimal(c, p, s).alias(c))
        else:
            cols.append(F.col(c))
    return text.select(*cols)
