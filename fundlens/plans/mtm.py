"""Unit price versus market price, and the mark-to-market impact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.functions.exact import round_ratio
from fundlens.functions.numeric import money_product, sign_class
from fundlens.functions.text import NA, with_placeholder
from fundlens.operators.dedup import first_per_key

FIXED_INCOME = "Renda Fixa"


def unit_vs_market(flat: DataFrame) -> DataFrame:
    """One row per asset (its first position in output order: date, fund CNPJ):
    unit price, market price and their percent difference (HALF_UP, 4 places)."""
    cols = flat.select("codigo_ativo", "nome_ativo", "classe_ativo", "preco_unitario", "preco_mercado",
                       "fonte_preco", "data_posicao", "cnpj_fundo")
    first = first_per_key(cols, ["codigo_ativo"], [F.col("data_posicao"), F.col("cnpj_fundo")])
    return first.select(
        "codigo_ativo", "nome_ativo", "classe_ativo", "preco_unitario", "preco_mercado",
        round_ratio(F.col("preco_mercado") - F.col("preco_unitario"), F.col("preco_unitario"), 4, times=100)
        .alias("diferenca_pct"),
        with_placeholder("fonte_preco", NA).alias("fonte_preco"))


def mtm_impact(flat: DataFrame, asset_class: str = FIXED_INCOME) -> DataFrame:
    """Per position of ``asset_class``: custody value (quantity x unit price), market
    value (quantity x market price), their difference and its sign."""
    f = flat.filter(F.col("classe_ativo") == asset_class)
    custody = money_product("quantidade", "preco_unitario")
    market = money_product("quantidade", "preco_mercado")
    return f.select(
        "data_posicao", "cnpj_fundo", "codigo_ativo", "quantidade", "preco_unitario", "preco_mercado",
        custody.alias("valor_custodia"), market.alias("valor_mercado"),
        (market - custody).alias("diferenca_valor"),
        sign_class(market - custody).alias("sinal"))
