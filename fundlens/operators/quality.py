"""Declarative data-quality rules.

A rule is a boolean Column that is true on a bad row. All rules of one table
are evaluated in a single aggregate pass (``count_if`` per rule), so checking
twenty rules costs one scan, not twenty jobs. Uniqueness and referential
rules need a shuffle by key and are separate, key-partitioned aggregates.

The result is a DataFrame ``(regra, tabela, coluna, descricao, n_invalidos,
aprovado)``; ``assert_passed`` turns it into the strict behaviour (raise).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlens import schemas
from fundlens.operators.joins import orphans

# Limits and domains of the source model (fixed values).
FUND_STATUS = ("ATIVO", "ENCERRADO", "SUSPENSO", "EM_LIQUIDACAO")
TRADE_TYPES = ("COMPRA", "VENDA", "AMORTIZACAO", "VENCIMENTO", "TRANSFERENCIA")
MAX_LENGTH: dict[str, dict[str, int]] = {
    "emissor": {"nome_emissor": 100, "cnpj_emissor": 20, "setor": 50, "rating": 10},
    "ativo": {"codigo_ativo": 20, "nome_ativo": 100, "classe_ativo": 50, "indexador": 30},
    "fundo": {"cnpj_fundo": 20, "nome_fundo": 100, "tipo_fundo": 50, "status": 20},
    "operacao": {"tipo_operacao": 20},
    "preco_mercado": {"fonte_preco": 50},
}
FOREIGN_KEYS = (
    ("ativo", "id_emissor", "emissor", "id_emissor"),
    ("posicao_carteira", "id_fundo", "fundo", "id_fundo"),
    ("posicao_carteira", "id_ativo", "ativo", "id_ativo"),
    ("operacao", "id_fundo", "fundo", "id_fundo"),
    ("operacao", "id_ativo", "ativo", "id_ativo"),
    ("preco_mercado", "id_ativo", "ativo", "id_ativo"),
)
NON_NEGATIVE = {"posicao_carteira": ("quantidade", "preco_unitario", "percentual_pl"),
                "preco_mercado": ("preco_mercado",)}
POSITIVE = {"operacao": ("quantidade", "preco_operacao")}

RESULT = T.StructType([
    T.StructField("regra", T.StringType()),
    T.StructField("tabela", T.StringType()),
    T.StructField("coluna", T.StringType()),
    T.StructField("descricao", T.StringType()),
    T.StructField("n_invalidos", T.LongType()),
    T.StructField("aprovado", T.BooleanType()),
])


@dataclass(frozen=True)
class Rule:
    regra: str
    tabela: str
    coluna: str
    bad: Column
    descricao: str


def not_null(table: str, schema: T.StructType) -> list[Rule]:
    return [Rule("V06", table, f.name, F.col(f.name).isNull(), "not null")
            for f in schema.fields if not f.nullable]


def non_negative(table: str, cols: Iterable[str]) -> list[Rule]:
    return [Rule("V09", table, c, F.col(c) < 0, ">= 0") for c in cols]


def positive(table: str, cols: Iterable[str]) -> list[Rule]:
    return [Rule("V10", table, c, F.col(c) <= 0, "> 0") for c in cols]


def domain(rule: str, table: str, col: str, values: Sequence[str]) -> Rule:
    return Rule(rule, table, col, ~F.col(col).isin(*values), "in " + ",".join(values))


def max_length(table: str, limits: dict[str, int]) -> list[Rule]:
    return [Rule("V13", table, c, F.length(c) > n, f"length <= {n}") for c, n in limits.items()]


def decimal_fits(table: str, schema: T.StructType) -> list[Rule]:
    return [Rule("V13", table, f.name,
                 F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(),
                 f"fits {f.dataType.simpleString()}")
            for f in schema.fields if isinstance(f.dataType, T.DecimalType)]


def evaluate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All ``rules`` of one table in one aggregate pass -> one result row each."""
    counts = df.agg(*[F.count_if(r.bad).alias(f"_r{i}") for i, r in enumerate(rules)])
    entries = [F.struct(F.lit(r.regra).alias("regra"), F.lit(r.tabela).alias("tabela"),
                        F.lit(r.coluna).alias("coluna"), F.lit(r.descricao).alias("descricao"),
                        F.col(f"_r{i}").cast("long").alias("n_invalidos"))
               for i, r in enumerate(rules)]
    return (counts.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")
            .withColumn("aprovado", F.col("n_invalidos") == 0))


def unique_keys(df: DataFrame, table: str, keys: Sequence[str], rule: str = "V07") -> DataFrame:
    """Rows beyond the first for each duplicated key (0 when the key is unique)."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return (dup.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("n_invalidos"))
            .select(F.lit(rule).alias("regra"), F.lit(table).alias("tabela"),
                    F.lit(",".join(keys)).alias("coluna"), F.lit("unique").alias("descricao"),
                    "n_invalidos", (F.col("n_invalidos") == 0).alias("aprovado")))


def foreign_key(child: DataFrame, table: str, col: str, parent: DataFrame, parent_table: str,
                parent_col: str, rule: str = "V08") -> DataFrame:
    return (orphans(child, col, parent, parent_col)
            .agg(F.count(F.lit(1)).cast("long").alias("n_invalidos"))
            .select(F.lit(rule).alias("regra"), F.lit(table).alias("tabela"), F.lit(col).alias("coluna"),
                    F.lit(f"references {parent_table}.{parent_col}").alias("descricao"),
                    "n_invalidos", (F.col("n_invalidos") == 0).alias("aprovado")))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def table_rules(table: str) -> list[Rule]:
    """Column rules of the source model for ``table`` (V06, V09-V13)."""
    schema = schemas.TABLES[table]
    rules = not_null(table, schema)
    rules += non_negative(table, NON_NEGATIVE.get(table, ()))
    rules += positive(table, POSITIVE.get(table, ()))
    if table == "fundo":
        rules.append(domain("V11", table, "status", FUND_STATUS))
    if table == "operacao":
        rules.append(domain("V12", table, "tipo_operacao", TRADE_TYPES))
    rules += max_length(table, MAX_LENGTH.get(table, {}))
    rules += decimal_fits(table, schema)
    return rules


def source_report(frames: dict[str, DataFrame]) -> DataFrame:
    """Every source-model rule over the given tables (names as in ``schemas.TABLES``)."""
    parts = [evaluate(df, table_rules(name)) for name, df in frames.items()]
    for name, df in frames.items():
        keys = schemas.NATURAL_KEYS.get(name)
        if keys:
            parts.append(unique_keys(df, name, keys))
    for child, col, parent, pcol in FOREIGN_KEYS:
        if child in frames and parent in frames:
            parts.append(foreign_key(frames[child], child, col, frames[parent], parent, pcol))
    return union_all(parts)


def flat_report(flat: DataFrame) -> DataFrame:
    """Output checks of the flat view in one pass: critical fields not NULL (V03), not empty (V04)."""
    rules = [Rule("V03", "carteira_flat", c, F.col(c).isNull(), "critical not null")
             for c in schemas.FLAT_CRITICAL]
    counts = flat.agg(*[F.count_if(r.bad).alias(f"_r{i}") for i, r in enumerate(rules)],
                      F.count(F.lit(1)).alias("_rows"))
    entries = [F.struct(F.lit(r.regra).alias("regra"), F.lit(r.tabela).alias("tabela"),
                        F.lit(r.coluna).alias("coluna"), F.lit(r.descricao).alias("descricao"),
                        F.col(f"_r{i}").cast("long").alias("n_invalidos"))
               for i, r in enumerate(rules)]
    entries.append(F.struct(F.lit("V04").alias("regra"), F.lit("carteira_flat").alias("tabela"),
                            F.lit("*").alias("coluna"), F.lit("not empty").alias("descricao"),
                            F.when(F.col("_rows") == 0, 1).otherwise(0).cast("long").alias("n_invalidos")))
    return (counts.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")
            .withColumn("aprovado", F.col("n_invalidos") == 0))


def contract_problems(df: DataFrame, expected: Sequence[str] = schemas.FLAT_COLUMNS,
                      all_strings: bool = False) -> list[str]:
    """Schema checks on metadata only (V02 columns equal the contract; V05 strings)."""
    problems = []
    have, want = list(df.columns), list(expected)
    if set(have) != set(want):
        problems.append(f"missing {sorted(set(want) - set(have))}, extra {sorted(set(have) - set(want))}")
    elif have != want:
        problems.append("column order differs from the contract")
    if all_strings:
        bad = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.StringType)]
        if bad:
            problems.append(f"non-string columns {bad}")
    return problems


def assert_passed(report: DataFrame) -> None:
    """Raise ``ValueError`` listing failed rules (collects the small report only)."""
    failed = report.filter(~F.col("aprovado")).collect()
    if failed:
        detail = "; ".join(f"{r.regra} {r.tabela}.{r.coluna} ({r.descricao}): {r.n_invalidos}"
                           for r in failed)
        raise ValueError(f"data quality failed -> {detail}")


def percent_sums(positions: DataFrame, tolerance: float = 0.5) -> DataFrame:
    """V14: per (date, fund), the sum of ``percentual_pl`` and whether it is within tolerance of 100."""
    return (positions.groupBy("data_posicao", "id_fundo")
            .agg(F.sum("percentual_pl").alias("soma_percentual"))
            .withColumn("aprovado", F.abs(F.col("soma_percentual") - F.lit(100)) <= F.lit(tolerance)))


def consistency_rules(positions: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """V15: quantity x unit price equals the financial value within ``tolerance``."""
    tol = F.lit(tolerance).cast("decimal(10,2)")
    diff = F.abs((F.col("quantidade") * F.col("preco_unitario")).cast("decimal(38,2)") - F.col("valor_financeiro"))
    return evaluate(positions, [Rule("V15", "posicao_carteira", "valor_financeiro", diff > tol,
                                     f"quantidade x preco_unitario within {tolerance}")])


def maturity_rule(flat: DataFrame, as_of: str | None = None) -> DataFrame:
    """V15: no position in an asset that has matured by its own date, or by ``as_of`` if given."""
    day = F.col("data_posicao") if as_of is None else F.lit(as_of).cast("date")
    what = "data_posicao" if as_of is None else as_of
    return evaluate(flat, [Rule("V15", "carteira_flat", "data_vencimento", F.col("data_vencimento") < day,
                                f"not before {what}")])
