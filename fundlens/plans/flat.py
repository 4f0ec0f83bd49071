"""The flat view of fund positions (``carteira_flat``).

``flat_typed`` keeps types and NULLs (for analysis); ``render_flat`` turns it
into the 19-column text contract with placeholders (for CSV consumers).
Neither runs a job except the dimension size checks behind the broadcast
hints.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens import schemas
from fundlens.functions.dates import iso_date
from fundlens.functions.text import NA, NOT_RATED, UNDEFINED_MATURITY, with_placeholder
from fundlens.operators.joins import DEFAULT_BROADCAST_MAX_ROWS, DEFAULT_HOT_MIN_ROWS, broadcast_if_bounded, \
    hot_keys, left_enrich, left_lookup, salted_join
from fundlens.plans.prices import prices_by_priority
from fundlens.model import Star

OUTPUT_ORDER = ("data_posicao", "cnpj_fundo", "codigo_ativo")


def forced(broadcast: bool | Mapping[str, bool] | None, table: str) -> bool | None:
    """The broadcast decision for one dimension: one flag for all, or one per table."""
    return broadcast.get(table) if isinstance(broadcast, Mapping) else broadcast


def scope_star(star: Star, as_of: str | None = None, date_from: str | None = None, date_to: str | None = None,
               fund: str | None = None) -> Star:
    """The star restricted to a date (``"latest"``: the newest position date), a date window or
    a fund, before anything is joined or counted, so every scan of positions and prices
    carries the filter and a date-partitioned table is pruned."""
    def dated(df: DataFrame, col: str) -> DataFrame:
        if day is not None:
            df = df.filter(F.col(col) == F.lit(day).cast("date"))
        if date_from is not None:
            df = df.filter(F.col(col) >= F.lit(date_from).cast("date"))
        return df if date_to is None else df.filter(F.col(col) <= F.lit(date_to).cast("date"))

    day = star.posicao.agg(F.max("data_posicao")).first()[0] if as_of == "latest" else as_of
    positions = dated(star.posicao, "data_posicao")
    if fund is not None:
        ids = star.fundo.filter(F.col("nome_fundo") == fund).select("id_fundo")
        positions = positions.join(ids, "id_fundo", "left_semi").select(*star.posicao.columns)
    return replace(star, posicao=positions, preco=dated(star.preco, "data_referencia"))


def asset_dimension(ativo: DataFrame, emissor: DataFrame, broadcast: bool | Mapping[str, bool] | None = None,
                    max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Asset joined with its issuer (snowflake folded into one dimension).

    Joining dimension to dimension first means the fact is joined once for
    both, and the issuer join runs on dimension-sized data.
    """
    a = ativo.select("id_ativo", "codigo_ativo", "nome_ativo", "classe_ativo", "indexador",
                     "data_vencimento", "id_emissor")
    e = emissor.select("id_emissor", "nome_emissor", "cnpj_emissor",
                       F.col("setor").alias("setor_emissor"), F.col("rating").alias("rating_emissor"))
    e = broadcast_if_bounded(e, max_rows, "emissor", force=forced(broadcast, "emissor"))
    return left_enrich(a, e, "id_emissor", flag="_hit_emissor")


def enriched_positions(star: Star, broadcast: bool | Mapping[str, bool] | None = None,
                       max_rows: int = DEFAULT_BROADCAST_MAX_ROWS, split_hot_keys: bool = True,
                       hot_min_rows: int = DEFAULT_HOT_MIN_ROWS, steps: int = 4) -> DataFrame:
    """Every position with fund, asset, issuer and the priority price of its date.

    Left joins only: the output has exactly one row per position when the
    dimension keys are unique (rule V07). ``_hit_*`` flags record each match.
    The price join comes first, while the rows are narrow: it and the join with an asset
    table too large to broadcast are the shuffles of the positions, and the texts of
    the dimensions are in neither. Adaptive execution cannot split a hot (date, asset) in the
    price join, whose price side is an aggregate; ``split_hot_keys`` salts the
    (date, asset) keys holding more than ``hot_min_rows`` positions instead
    (``operators.joins.salted_join``). Streams pass ``False``: their micro-batches
    are bounded and a stream cannot join back its own aggregate. A star that lies by asset (``Star.asset_rows``)
    has been shuffled for all of this already. ``steps`` stops after
    the fund (1), asset (2), issuer (3) or price join (4).
    """
    schemas.require_columns(star.frames())
    fundo = star.fundo.select("id_fundo", "cnpj_fundo", "nome_fundo", "tipo_fundo")
    fundo = broadcast_if_bounded(fundo, max_rows, "fundo", force=forced(broadcast, "fundo"))
    fact = star.posicao.select("data_posicao", "id_fundo", "id_ativo", "quantidade", "preco_unitario",
                               "valor_financeiro", "percentual_pl")
    if steps == 4:
        fact = _with_prices(star, fact, split_hot_keys, hot_min_rows)
    out = left_enrich(fact, fundo, "id_fundo", flag="_hit_fundo")
    if steps == 1:
        return out
    if steps == 2:
        assets = star.ativo.drop("id_emissor")
        return left_enrich(out, broadcast_if_bounded(assets, max_rows, "ativo", force=forced(broadcast, "ativo")),
                           "id_ativo", flag="_hit_ativo")
    # Rows counted on the asset table: the issuer is a left join on its unique key
    # (rule V07), and counting the joined dimension would evaluate the issuer side.
    assets = broadcast_if_bounded(asset_dimension(star.ativo, star.emissor, broadcast, max_rows),
                                  max_rows, "ativo", force=forced(broadcast, "ativo"), rows_from=star.ativo)
    out = left_enrich(out, assets, "id_ativo", flag="_hit_ativo")
    return out.withColumn("_hit_emissor", F.coalesce(F.col("_hit_emissor"), F.lit(False)))


def _with_prices(star: Star, fact: DataFrame, split_hot_keys: bool, hot_min_rows: int) -> DataFrame:
    """``fact`` with the priority price of its (date, asset).

    Exact date match (no as-of carry-forward); the price side grows with the
    data, so this is a shuffle join, with hot (date, asset) keys split. Positions and prices that lie by asset
    already (``Star.asset_rows``) hold no hot key and stay where they are; the asset comes first in their
    order, which the asset join then finds."""
    quotes = star.preco.select("data_referencia", "id_ativo", "preco_mercado", "fonte_preco", "id_preco")
    prices = prices_by_priority(quotes).select(
        F.col("data_referencia").alias("data_posicao"), "id_ativo", "preco_mercado", "fonte_preco")
    keys = ["data_posicao", "id_ativo"]
    if star.asset_rows is not None and star.asset_rows <= hot_min_rows:
        return left_lookup(fact, prices, ["id_ativo", "data_posicao"], flag="_hit_preco")
    if not split_hot_keys:
        return left_enrich(fact, prices, keys, flag="_hit_preco")
    counted = fact if star.position_keys is None else star.position_keys
    priced = salted_join(fact, prices.withColumn("_hit_preco", F.lit(True)), keys, "left",
                         hot=hot_keys(counted, keys, hot_min_rows))
    return priced.withColumn("_hit_preco", F.coalesce(F.col("_hit_preco"), F.lit(False)))


def flat_typed(star: Star, broadcast: bool | Mapping[str, bool] | None = None,
               max_rows: int = DEFAULT_BROADCAST_MAX_ROWS, split_hot_keys: bool = True,
               hot_min_rows: int = DEFAULT_HOT_MIN_ROWS) -> DataFrame:
    """Typed 19-column flat view (``schemas.FLAT_TYPED``), NULLs kept."""
    e = enriched_positions(star, broadcast, max_rows, split_hot_keys, hot_min_rows)
    return e.select(*schemas.FLAT_COLUMNS)


def render_flat(typed: DataFrame) -> DataFrame:
    """19 text columns with the placeholders of the output contract."""
    return typed.select(
        iso_date("data_posicao").alias("data_posicao"),
        "cnpj_fundo", "nome_fundo", "tipo_fundo", "codigo_ativo", "nome_ativo", "classe_ativo",
        with_placeholder("indexador", NA).alias("indexador"),
        with_placeholder(iso_date("data_vencimento"), UNDEFINED_MATURITY).alias("data_vencimento"),
        "nome_emissor", "cnpj_emissor",
        with_placeholder("setor_emissor", NA).alias("setor_emissor"),
        with_placeholder("rating_emissor", NOT_RATED).alias("rating_emissor"),
        F.col("quantidade").cast("string").alias("quantidade"),
        F.col("preco_unitario").cast("string").alias("preco_unitario"),
        with_placeholder(F.col("preco_mercado").cast("string"), NA).alias("preco_mercado"),
        F.col("valor_financeiro").cast("string").alias("valor_financeiro"),
        F.col("percentual_pl").cast("string").alias("percentual_pl"),
        with_placeholder("fonte_preco", NA).alias("fonte_preco"),
    )


def sort_output(df: DataFrame) -> DataFrame:
    """Output order: date, fund CNPJ, asset code (ascending, NULLs first)."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in OUTPUT_ORDER])


def carteira_flat(star: Star, broadcast: bool | Mapping[str, bool] | None = None, sort: bool = True,
                  max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """The rendered, ordered flat view (what the CSV sink writes). Typed rows are sorted, which are narrower than
    their text and have the same order."""
    typed = flat_typed(star, broadcast, max_rows)
    return render_flat(sort_output(typed) if sort else typed)
