"""The fund model as a bundle of DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Star:
    """The six tables of the fund model, conformed to ``fundlens.schemas``."""

    fundo: DataFrame
    ativo: DataFrame
    emissor: DataFrame
    posicao: DataFrame
    preco: DataFrame
    operacao: DataFrame | None = None
    # True when ``posicao`` is the daily sum of ``operacao`` (the driver adapter):
    # staging then re-derives positions from the written trades instead of
    # evaluating the trade join twice.
    positions_from_trades: bool = False
    # ``data_posicao, id_ativo`` with at least as many rows of each key as ``posicao``, when it
    # is cheaper to read: the price join looks for hot keys there.
    position_keys: DataFrame | None = None
    # Set when ``posicao`` and ``preco`` are hash-partitioned by ``id_ativo``, each aggregated in one shuffle: the
    # most rows that an asset may hold there. Joins by asset, or by date and asset, then move none of these rows again.
    asset_rows: int | None = None

    def frames(self) -> dict[str, DataFrame]:
        out = {"fundo": self.fundo, "ativo": self.ativo, "emissor": self.emissor,
               "posicao_carteira": self.posicao, "preco_mercado": self.preco}
        if self.operacao is not None:
            out["operacao"] = self.operacao
        return out
