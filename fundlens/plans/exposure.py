"""Exposure and composition queries on the typed flat view.

Grouping keys use the rendered placeholders (``N/A`` indexer or sector,
``NR`` rating) so that missing values form their own bucket instead of
silently dropping out of the totals. Sums stay DECIMAL; shares are exact
HALF_UP ratios.

``as_of``: ``None`` sums every snapshot in the view (the notebook behaviour);
``"latest"`` keeps the newest position date; a date string keeps that date
(partition pruning when the positions are partitioned by date).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlens.functions.exact import millions, round_ratio, sum_exact
from fundlens.functions.dates import iso_date
from fundlens.functions.text import NA, NOT_RATED, count_text, fund_short_name, issuer_short_name, \
    millions_text, money_text, rating_bucket, with_placeholder
from fundlens.operators.joins import DEFAULT_HOT_MIN_ROWS, hot_from_counts, salted_join
from fundlens.operators.ordered import top_k
from fundlens.session import written

VALUE = "valor_financeiro"
CLASSES = ("Renda Fixa", "Renda Variavel")


def scope(flat: DataFrame, as_of: str | None = None) -> DataFrame:
    if as_of is None:
        return flat
    if as_of == "latest":
        newest = flat.select(F.max("data_posicao")).scalar()
        return flat.filter(F.col("data_posicao") == newest)
    return flat.filter(F.col("data_posicao") == F.lit(as_of).cast("date"))


def with_share(grouped: DataFrame, value: str = "valor_total", out: str = "pct_total",
               scale: int = 2) -> DataFrame:
    """``value`` as a percent of its column total (scalar subquery, no single-task window)."""
    total = grouped.select(F.sum(value)).scalar()
    # The total is bound to a column once, so the subquery appears once in the plan.
    return (grouped.withColumn("_total", total)
            .withColumn(out, round_ratio(F.col(value), F.col("_total"), scale, times=100))
            .drop("_total"))


def total_by(flat: DataFrame, keys: Sequence[str | Column], share: bool = False,
             as_of: str | None = None, value: str = VALUE) -> DataFrame:
    g = scope(flat, as_of).groupBy(*keys).agg(sum_exact(value, 2).alias("valor_total"))
    # The groups are used twice, for themselves and for their total: written, they are summed once.
    return with_share(written(g, "totals")) if share else g


#: log2 of a sketch's registers: a relative standard error of about 0.8 %.
SKETCH_LG_K = 14


def kpi_sketches(flat: DataFrame, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """Per position date what the KPIs of any set of dates can be merged from: distinct-count sketches of
    funds, assets and issuers, total PL, positions. A row of a few 10 KB per date, to be kept and
    extended day by day; the positions are not read again."""
    return flat.groupBy("data_posicao").agg(
        F.hll_sketch_agg("nome_fundo", F.lit(lg_k)).alias("sk_fundos"),
        F.hll_sketch_agg("codigo_ativo", F.lit(lg_k)).alias("sk_ativos"),
        F.hll_sketch_agg("nome_emissor", F.lit(lg_k)).alias("sk_emissores"),
        sum_exact(VALUE, 2).alias("pl_total"), F.count(F.lit(1)).alias("n_posicoes"))


def overview_approx(sketches: DataFrame, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """:func:`overview` of a date window from :func:`kpi_sketches`: distinct counts are estimates (standard
    error about 1.04 / sqrt(2^lg_k)), the rest is exact."""
    if date_from is not None:
        sketches = sketches.filter(F.col("data_posicao") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        sketches = sketches.filter(F.col("data_posicao") <= F.lit(date_to).cast("date"))
    return sketches.agg(
        *[F.hll_sketch_estimate(F.hll_union_agg(f"sk_{c}")).alias(f"n_{c}") for c in ("fundos", "ativos", "emissores")],
        F.sum("pl_total").cast("decimal(38,2)").alias("pl_total"), F.sum("n_posicoes").alias("n_posicoes"),
        F.min("data_posicao").alias("data_inicial"), F.max("data_posicao").alias("data_final"))


def overview(flat: DataFrame, as_of: str | None = None) -> DataFrame:
    """Fund, asset and issuer counts, total PL and the date range (one row)."""
    return scope(flat, as_of).agg(
        F.countDistinct("nome_fundo").alias("n_fundos"),
        F.countDistinct("codigo_ativo").alias("n_ativos"),
        F.countDistinct("nome_emissor").alias("n_emissores"),
        sum_exact(VALUE, 2).alias("pl_total"),
        F.count(F.lit(1)).alias("n_posicoes"),
        F.min("data_posicao").alias("data_inicial"),
        F.max("data_posicao").alias("data_final"),
    )


def overview_text(flat: DataFrame, as_of: str | None = None) -> DataFrame:
    """The KPI cards as text: total PL in full and in millions, counts with
    thousands separators, and the reference (newest) date."""
    return overview(flat, as_of).select(
        money_text("pl_total").alias("pl_total_texto"),
        millions_text("pl_total").alias("pl_total_mi_texto"),
        count_text("n_fundos").alias("n_fundos_texto"),
        count_text("n_ativos").alias("n_ativos_texto"),
        count_text("n_emissores").alias("n_emissores_texto"),
        count_text("n_posicoes").alias("n_posicoes_texto"),
        iso_date("data_final").alias("data_referencia"))


def extremes_by(flat: DataFrame, keys: Sequence[str | Column], as_of: str | None = None) -> DataFrame:
    """Smallest and largest position value, largest percent of PL and the date
    range per group (chart axis limits); one map-side combined aggregate."""
    return scope(flat, as_of).groupBy(*keys).agg(
        F.min(VALUE).alias("valor_min"), F.max(VALUE).alias("valor_max"),
        F.max("percentual_pl").alias("pct_pl_max"),
        F.min("data_posicao").alias("data_min"), F.max("data_posicao").alias("data_max"))


def pl_by_fund(flat: DataFrame, as_of: str | None = None) -> DataFrame:
    return (scope(flat, as_of).groupBy("nome_fundo").agg(sum_exact(VALUE, 2).alias("pl"))
            .orderBy(F.col("pl").desc(), F.col("nome_fundo")))


def fund_summary(flat: DataFrame, as_of: str | None = None) -> DataFrame:
    """PL (and in millions) and number of distinct assets per fund."""
    g = scope(flat, as_of).groupBy("nome_fundo").agg(
        sum_exact(VALUE, 2).alias("pl"), F.countDistinct("codigo_ativo").alias("n_ativos"))
    return g.select("nome_fundo", fund_short_name("nome_fundo").alias("fundo_curto"), "pl",
                    millions(F.col("pl"), 1).alias("pl_mi"), "n_ativos")


def fund_composition(flat: DataFrame, as_of: str | None = None,
                     hot_min_rows: int = DEFAULT_HOT_MIN_ROWS) -> DataFrame:
    """Per fund and asset: value, percent of PL, and that percent normalised to the
    fund's own total (the pie-chart share). Funds with more than ``hot_min_rows``
    assets are split over several join tasks."""
    g = scope(flat, as_of).groupBy("nome_fundo", "codigo_ativo").agg(
        sum_exact(VALUE, 2).alias("valor_total"), sum_exact("percentual_pl", 6).alias("pct_pl"))
    g = written(g, "composition")  # read for the fund totals and for the rows
    # Fund totals by aggregate + join: a fund holding a third of the rows is
    # combined map-side instead of landing whole in one window task, and its
    # (fund, asset) rows are salted over several join tasks (the counts come with
    # the totals, so finding hot funds costs no extra pass).
    # Positions without a fund are a group too: the key is the name and whether there is one.
    keys = ["_fund", "_none"]
    g = g.withColumn("_fund", F.coalesce("nome_fundo", F.lit(""))).withColumn("_none", F.col("nome_fundo").isNull())
    tot = g.groupBy(*keys).agg(F.sum("pct_pl").alias("_fund_pct"), F.count(F.lit(1)).alias("_n"))
    hot = hot_from_counts(tot, keys, "_n", hot_min_rows)
    return (salted_join(g, tot.drop("_n"), keys, "left", hot=hot)
            .withColumn("share_fundo", round_ratio(F.col("pct_pl"), F.col("_fund_pct"), 2, times=100))
            .drop("_fund_pct", *keys))


def matrix_fund_asset(flat: DataFrame, as_of: str | None = None) -> DataFrame:
    """Fund x asset sum of percent of PL, long form (only the cells that exist)."""
    return (scope(flat, as_of).groupBy("nome_fundo", "codigo_ativo")
            .agg(sum_exact("percentual_pl", 6).alias("pct_pl"))
            .withColumn("fundo_curto", fund_short_name("nome_fundo")))


def pivot_fund_asset(flat: DataFrame, assets: Sequence[str], as_of: str | None = None) -> DataFrame:
    """Wide fund x asset matrix for an explicit asset list (stable column set), 0 when absent."""
    p = (scope(flat, as_of).groupBy("nome_fundo").pivot("codigo_ativo", list(assets))
         .agg(sum_exact("percentual_pl", 6)))
    return p.select("nome_fundo", *[F.coalesce(F.col(a), F.lit(0).cast("decimal(38,6)")).alias(a)
                                    for a in assets])


def matrix_fund_class(flat: DataFrame, classes: Sequence[str] = CLASSES, as_of: str | None = None) -> DataFrame:
    """Fund x asset class of value in millions (HALF_UP, 2 places), 0 when absent."""
    p = (scope(flat, as_of).groupBy("nome_fundo").pivot("classe_ativo", list(classes))
         .agg(sum_exact(VALUE, 2)))
    return p.select("nome_fundo", fund_short_name("nome_fundo").alias("fundo_curto"),
                    *[F.coalesce(millions(F.col(c), 2), F.lit(0).cast("decimal(38,2)")).alias(c)
                      for c in classes])


def exposure_by_class(flat: DataFrame, as_of: str | None = None) -> DataFrame:
    return total_by(flat, ["classe_ativo"], share=True, as_of=as_of)


def exposure_by_indexer(flat: DataFrame, as_of: str | None = None, drop_missing: bool = False) -> DataFrame:
    """``drop_missing`` reproduces a text-file analysis that reads ``N/A`` as missing and
    drops it from the grouping (equities vanish from the totals)."""
    if drop_missing:
        flat = flat.filter(F.col("indexador").isNotNull())
    return total_by(flat, [with_placeholder("indexador", NA).alias("indexador")], share=True, as_of=as_of)


def pl_by_fund_type(flat: DataFrame, as_of: str | None = None) -> DataFrame:
    return total_by(flat, ["tipo_fundo"], share=True, as_of=as_of)


def sector_concentration(flat: DataFrame, as_of: str | None = None, drop_missing: bool = False) -> DataFrame:
    if drop_missing:
        flat = flat.filter(F.col("setor_emissor").isNotNull())
    return total_by(flat, [with_placeholder("setor_emissor", NA).alias("setor_emissor")], share=True,
                    as_of=as_of)


def issuer_by_rating(flat: DataFrame, as_of: str | None = None) -> DataFrame:
    """Issuer exposure with its rating and rating bucket."""
    g = total_by(flat, ["nome_emissor", with_placeholder("rating_emissor", NOT_RATED).alias("rating_emissor")],
                 as_of=as_of)
    return g.select("nome_emissor", "rating_emissor",
                    issuer_short_name("nome_emissor", 20, cut_dash=False).alias("emissor_curto"),
                    rating_bucket("rating_emissor").alias("faixa_rating"), "valor_total")


def top_assets(flat: DataFrame, k: int = 5, as_of: str | None = None) -> DataFrame:
    """The ``k`` assets with the largest total value (ties by code)."""
    g = total_by(flat, ["codigo_ativo"], as_of=as_of)
    return top_k(g, k, [F.col("valor_total").desc(), F.col("codigo_ativo")])
