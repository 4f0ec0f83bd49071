"""Table schemas, the flat-view contract and ``conform``.

Surrogate keys are 64-bit: a fact table at 100 TB holds far more rows than a
32-bit SERIAL can number, so ids are read as ``long`` whatever the source type.
Money and quantities stay DECIMAL end to end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID = T.LongType()
TEXT = T.StringType()
QTY = T.DecimalType(18, 6)
PRICE = T.DecimalType(18, 6)
MONEY = T.DecimalType(18, 2)
PCT = T.DecimalType(9, 6)
DATE = T.DateType()
TS = T.TimestampType()


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, nullable) for name, dtype, nullable in fields])


EMISSOR = _struct(
    ("id_emissor", ID, False),
    ("nome_emissor", TEXT, False),
    ("cnpj_emissor", TEXT, False),
    ("setor", TEXT, True),
    ("rating", TEXT, True),
    ("criado_em", TS, True),
    ("atualizado_em", TS, True),
)

ATIVO = _struct(
    ("id_ativo", ID, False),
    ("codigo_ativo", TEXT, False),
    ("nome_ativo", TEXT, False),
    ("classe_ativo", TEXT, False),
    ("indexador", TEXT, True),
    ("data_vencimento", DATE, True),
    ("id_emissor", ID, False),
    ("criado_em", TS, True),
    ("atualizado_em", TS, True),
)

FUNDO = _struct(
    ("id_fundo", ID, False),
    ("cnpj_fundo", TEXT, False),
    ("nome_fundo", TEXT, False),
    ("tipo_fundo", TEXT, False),
    ("data_inicio", DATE, False),
    ("status", TEXT, False),
    ("criado_em", TS, True),
    ("atualizado_em", TS, True),
)

POSICAO = _struct(
    ("id_posicao", ID, False),
    ("data_posicao", DATE, False),
    ("id_fundo", ID, False),
    ("id_ativo", ID, False),
    ("quantidade", QTY, False),
    ("preco_unitario", PRICE, False),
    ("valor_financeiro", MONEY, False),
    ("percentual_pl", PCT, False),
    ("criado_em", TS, True),
)

OPERACAO = _struct(
    ("id_operacao", ID, False),
    ("data_operacao", DATE, False),
    ("id_fundo", ID, False),
    ("id_ativo", ID, False),
    ("tipo_operacao", TEXT, False),
    ("quantidade", QTY, False),
    ("preco_operacao", PRICE, False),
    ("valor_operacao", MONEY, False),
    ("criado_em", TS, True),
)

PRECO = _struct(
    ("id_preco", ID, False),
    ("data_referencia", DATE, False),
    ("id_ativo", ID, False),
    ("preco_mercado", PRICE, False),
    ("fonte_preco", TEXT, False),
    ("criado_em", TS, True),
)

TABLES: dict[str, T.StructType] = {
    "emissor": EMISSOR,
    "ativo": ATIVO,
    "fundo": FUNDO,
    "posicao_carteira": POSICAO,
    "operacao": OPERACAO,
    "preco_mercado": PRECO,
}

# Columns the flat-view transform needs from each input (fixed contract).
REQUIRED_COLUMNS: dict[str, tuple[str, ...]] = {
    "posicao_carteira": ("id_posicao", "data_posicao", "id_fundo", "id_ativo",
                         "quantidade", "preco_unitario", "valor_financeiro", "percentual_pl"),
    "fundo": ("id_fundo", "cnpj_fundo", "nome_fundo", "tipo_fundo"),
    "ativo": ("id_ativo", "codigo_ativo", "nome_ativo", "classe_ativo",
              "indexador", "data_vencimento", "id_emissor"),
    "emissor": ("id_emissor", "nome_emissor", "cnpj_emissor", "setor", "rating"),
    "preco_mercado": ("data_referencia", "id_ativo", "preco_mercado", "fonte_preco"),
}

# Natural keys (unique constraints of the source model).
NATURAL_KEYS: dict[str, tuple[str, ...]] = {
    "emissor": ("cnpj_emissor",),
    "ativo": ("codigo_ativo",),
    "fundo": ("cnpj_fundo",),
    "posicao_carteira": ("data_posicao", "id_fundo", "id_ativo"),
    "preco_mercado": ("data_referencia", "id_ativo", "fonte_preco"),
}

# Output contract of the flat view, in column order (fixed values).
FLAT_COLUMNS: tuple[str, ...] = (
    "data_posicao",
    "cnpj_fundo",
    "nome_fundo",
    "tipo_fundo",
    "codigo_ativo",
    "nome_ativo",
    "classe_ativo",
    "indexador",
    "data_vencimento",
    "nome_emissor",
    "cnpj_emissor",
    "setor_emissor",
    "rating_emissor",
    "quantidade",
    "preco_unitario",
    "preco_mercado",
    "valor_financeiro",
    "percentual_pl",
    "fonte_preco",
)

# Typed flat view: NULL stays NULL here; placeholders are applied at rendering.
FLAT_TYPED = _struct(
    ("data_posicao", DATE, False),
    ("cnpj_fundo", TEXT, True),
    ("nome_fundo", TEXT, True),
    ("tipo_fundo", TEXT, True),
    ("codigo_ativo", TEXT, True),
    ("nome_ativo", TEXT, True),
    ("classe_ativo", TEXT, True),
    ("indexador", TEXT, True),
    ("data_vencimento", DATE, True),
    ("nome_emissor", TEXT, True),
    ("cnpj_emissor", TEXT, True),
    ("setor_emissor", TEXT, True),
    ("rating_emissor", TEXT, True),
    ("quantidade", QTY, False),
    ("preco_unitario", PRICE, False),
    ("preco_mercado", PRICE, True),
    ("valor_financeiro", MONEY, False),
    ("percentual_pl", PCT, False),
    ("fonte_preco", TEXT, True),
)

FLAT_STRING = T.StructType([T.StructField(c, TEXT, True) for c in FLAT_COLUMNS])

# Fields that must never be NULL in the rendered flat view (fixed values of the contract).
FLAT_CRITICAL = ("data_posicao", "cnpj_fundo", "nome_fundo", "codigo_ativo",
                 "quantidade", "valor_financeiro", "percentual_pl")

_AUDIT = {"criado_em", "atualizado_em"}


def missing_columns(df: DataFrame, table: str) -> list[str]:
    """Required columns of ``table`` absent from ``df`` (metadata only, no job)."""
    have = set(df.columns)
    return [c for c in REQUIRED_COLUMNS[table] if c not in have]


def require_columns(frames: dict[str, DataFrame]) -> None:
    """Raise ``ValueError`` naming every table and column that is missing."""
    problems = {name: missing_columns(df, name) for name, df in frames.items()
                if name in REQUIRED_COLUMNS}
    problems = {k: v for k, v in problems.items() if v}
    if problems:
        detail = "; ".join(f"{k}: {sorted(v)}" for k, v in sorted(problems.items()))
        raise ValueError(f"missing required columns -> {detail}")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: keep declared columns, cast each one.

    Audit columns absent from the source are added as NULL; any other absent
    column raises. Casting enforces the declared types the source may not have
    (JDBC metadata, CSV text, driver doubles). Nullability is checked by the
    quality rules, not here, so that the check is one aggregate pass.
    """
    have = set(df.columns)
    absent = [f.name for f in schema.fields if f.name not in have and f.name not in _AUDIT]
    if absent:
        raise ValueError(f"missing columns {absent}")
    cols = []
    for f in schema.fields:
        if f.name in have:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)
