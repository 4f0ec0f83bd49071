"""Asset and issuer rankings, the concentration curve and its Pareto point.

Positions and running totals come from ``ordered_scan`` (range-partitioned,
no single-task window), after the grouping has reduced the data to one row
per asset or issuer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.functions.exact import millions, round_ratio, sum_exact
from fundlens.functions.text import NA, NOT_RATED, issuer_short_name, truncate, with_placeholder
from fundlens.operators.ordered import first_reaching, ordered_scan
from fundlens.plans.exposure import VALUE, scope, with_share
from fundlens.session import written

PARETO = 80


def asset_totals(flat: DataFrame, as_of: str | None = None, keep: bool = False) -> DataFrame:
    """Per asset: value, number of funds, share of the total. ``keep`` writes the groups, which are read
    twice (for themselves and for their total); else ``flat`` is evaluated twice."""
    g = scope(flat, as_of).groupBy("codigo_ativo", "nome_ativo", "classe_ativo").agg(
        sum_exact(VALUE, 2).alias("valor_total"), F.countDistinct("nome_fundo").alias("n_fundos"))
    return with_share(written(g, "asset-totals") if keep else g)


def asset_ranking(flat: DataFrame, as_of: str | None = None) -> DataFrame:
    """Per asset: value (and in millions), number of funds, share of the total, rank. Assets are
    told apart by code, name and class, and the order ends in all three."""
    g = asset_totals(flat, as_of, keep=True).withColumn("valor_mi", millions(F.col("valor_total"), 2))
    g = g.withColumn("rotulo", F.concat_ws(" ", "codigo_ativo", truncate("nome_ativo", 18)))
    return ordered_scan(g, [F.col("valor_total").desc(), F.col("codigo_ativo").asc_nulls_last(),
                            F.col("nome_ativo").asc_nulls_last(), F.col("classe_ativo").asc_nulls_last()])


def issuer_totals(flat: DataFrame, as_of: str | None = None, keep: bool = False) -> DataFrame:
    """Per issuer (name, sector, rating): value, distinct assets and funds, share of the total. ``keep`` as in
    :func:`asset_totals`."""
    g = scope(flat, as_of).groupBy(
        "nome_emissor",
        with_placeholder("setor_emissor", NA).alias("setor_emissor"),
        with_placeholder("rating_emissor", NOT_RATED).alias("rating_emissor"),
    ).agg(sum_exact(VALUE, 2).alias("valor_total"),
          F.countDistinct("codigo_ativo").alias("n_ativos"),
          F.countDistinct("nome_fundo").alias("n_fundos"))
    return with_share(written(g, "issuer-totals") if keep else g)


def issuer_distribution(flat: DataFrame, as_of: str | None = None, drop_missing: bool = False) -> DataFrame:
    """Per issuer (with sector and rating): value, distinct assets and funds, share of
    the total, the running sum of the rounded shares in descending value (``pct_acum``)
    and the exact cumulative share rounded once (``pct_acum_exato``).

    ``drop_missing`` reproduces a text-file analysis that drops issuers whose name or
    sector reads as missing (the treasury, with no sector, disappears)."""
    if drop_missing:
        flat = flat.filter(F.col("nome_emissor").isNotNull() & F.col("setor_emissor").isNotNull())
    g = issuer_totals(flat, as_of, keep=True).withColumn("valor_mi", millions(F.col("valor_total"), 2))
    order = [F.col("valor_total").desc(), F.col("nome_emissor").asc_nulls_last(),
             F.col("setor_emissor"), F.col("rating_emissor")]
    out = ordered_scan(g, order, sums={"pct_acum": F.col("pct_total"), "_valor_acum": F.col("valor_total")},
                       totals=True)
    return (out.withColumn("pct_acum", F.col("pct_acum").cast("decimal(38,2)"))
            .withColumn("pct_acum_exato",
                        round_ratio(F.col("_valor_acum"), F.col("total__valor_acum"), 2, times=100))
            .drop("_valor_acum", "total__valor_acum", "total_pct_acum"))


def concentration_curve(flat: DataFrame, threshold: int = PARETO, as_of: str | None = None) -> DataFrame:
    """Cumulative share by issuer rank, with the first rank reaching ``threshold`` flagged."""
    d = issuer_distribution(flat, as_of)
    first = d.filter(F.col("pct_acum") >= threshold).select(F.min("posicao")).scalar()
    return d.select(
        "posicao", "nome_emissor",
        F.concat(F.col("posicao").cast("string"), F.lit("º emissor")).alias("rotulo_posicao"),
        truncate(issuer_short_name("nome_emissor", 22), 14).alias("emissor_curto"),
        "pct_total", "pct_acum",
        (F.col("pct_acum") >= threshold).alias("acima_limite"),
        F.coalesce(F.col("posicao") == first, F.lit(False)).alias("ponto_pareto"))


def pareto_point(flat: DataFrame, threshold: int = PARETO, as_of: str | None = None) -> DataFrame:
    """The first issuer (by rank) at which the cumulative share reaches ``threshold``."""
    d = issuer_distribution(flat, as_of)
    return first_reaching(d, "pct_acum", threshold).select("posicao", "nome_emissor", "pct_acum")


def concentration_alerts(flat: DataFrame, limit_pct: float = 10.0, as_of: str | None = None) -> DataFrame:
    """Assets and issuers whose share of the total exceeds ``limit_pct``. What both read of the positions is written
    once."""
    flat = written(scope(flat, as_of).select("codigo_ativo", "nome_ativo", "classe_ativo", "nome_emissor", "setor_emissor",
                                             "rating_emissor", "nome_fundo", VALUE), "alert-positions")
    as_of = None
    a = asset_totals(flat, as_of).filter(F.col("pct_total") > limit_pct).select(
        F.lit("ativo").alias("nivel"), F.col("codigo_ativo").alias("nome"), "valor_total", "pct_total")
    i = issuer_totals(flat, as_of).filter(F.col("pct_total") > limit_pct).select(
        F.lit("emissor").alias("nivel"), F.col("nome_emissor").alias("nome"), "valor_total", "pct_total")
    return a.unionByName(i)
