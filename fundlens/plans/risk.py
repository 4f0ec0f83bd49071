"""Fund risk on daily PL series: historical VaR, maximum drawdown, correlation and
tracking error against the whole portfolio.

The positions are first aggregated to one PL per (fund, date) (map-side
combined) and written, as all measures and the portfolio's PL come from it; every window below then runs per fund over its dates, so a group
is bounded by the calendar (about 252 rows a year), not by data volume. The
portfolio series is one row per date.

Returns are exact decimal percentages (``round_ratio``); the VaR quantile is
interpolated in DECIMAL; correlation and tracking error are double-precision
moments rounded to 4 places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlens.functions.exact import round_ratio, sum_exact
from fundlens.operators.ordered import with_previous
from fundlens.session import written

VALUE = "valor_financeiro"
RET_SCALE = 6


def daily_pl(flat: DataFrame, key: str | None = "nome_fundo") -> DataFrame:
    keys = ([key] if key else []) + ["data_posicao"]
    return flat.groupBy(*keys).agg(sum_exact(VALUE, 2).alias("pl"))


def daily_returns(pl: DataFrame, key: str | None = "nome_fundo") -> DataFrame:
    """Percent change of ``pl`` from the series' previous date (NULL on its first date).

    Per key, ``lag`` runs in one window per series (bounded by the calendar).
    The single portfolio series (``key=None``) takes its previous date from a
    range-partitioned global order instead of an unpartitioned window."""
    if key:
        with_prev = pl.withColumn("_prev", F.lag("pl").over(Window.partitionBy(key).orderBy("data_posicao")))
    else:
        with_prev = with_previous(pl, [F.col("data_posicao")], ["pl"]).withColumnRenamed("prev_pl", "_prev")
    return with_prev.withColumn(
        "retorno_pct", round_ratio(F.col("pl") - F.col("_prev"), F.col("_prev"), RET_SCALE, times=100)
    ).drop("_prev")


def bounded_group_quantile(df: DataFrame, group: str, value: str, p: float) -> DataFrame:
    """Linear-interpolation quantile of ``value`` per ``group`` for groups of bounded size."""
    w = Window.partitionBy(group).orderBy(value)
    ranked = (df.withColumn("_r", F.row_number().over(w) - 1)
              .withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(group)))
              .withColumn("_pos", (F.col("_n") - 1) * F.lit(p).cast("decimal(10,8)")))
    picked = ranked.filter((F.col("_r") == F.floor("_pos")) | (F.col("_r") == F.ceil("_pos")))
    return picked.groupBy(group).agg(
        F.max(F.when(F.col("_r") == F.floor("_pos"), F.col(value))).alias("_vlo"),
        F.max(F.when(F.col("_r") == F.ceil("_pos"), F.col(value))).alias("_vhi"),
        F.max(F.col("_pos") - F.floor("_pos")).alias("_frac"),
    ).select(group, (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")).alias("quantil"))


def _round4(c: Column) -> Column:
    return F.round(c, 4).cast("decimal(38,4)")


def fund_risk(flat: DataFrame, window: int = 252, level: float = 0.95) -> DataFrame:
    """Per fund, over its last ``window`` daily returns: VaR at ``level`` (loss, percent),
    correlation and tracking error against the portfolio; and the maximum drawdown of
    its whole PL history."""
    pl = written(daily_pl(flat), "daily-pl")  # read for every measure below
    rets = daily_returns(pl).filter(F.col("retorno_pct").isNotNull())
    recent = (rets.withColumn("_k", F.row_number().over(
        Window.partitionBy("nome_fundo").orderBy(F.col("data_posicao").desc())))
        .filter(F.col("_k") <= window).drop("_k"))

    portfolio = daily_pl(pl.withColumnRenamed("pl", VALUE), key=None)
    total = daily_returns(portfolio, key=None).select(
        "data_posicao", F.col("retorno_pct").alias("retorno_total"))
    paired = recent.join(total, "data_posicao", "left")
    moments = paired.groupBy("nome_fundo").agg(
        F.count(F.lit(1)).alias("n_retornos"),
        F.max("data_posicao").alias("data_final"),
        _round4(F.corr(F.col("retorno_pct").cast("double"), F.col("retorno_total").cast("double")))
        .alias("correlacao_total"),
        _round4(F.stddev_samp((F.col("retorno_pct") - F.col("retorno_total")).cast("double")))
        .alias("tracking_error_pct"))

    var = bounded_group_quantile(recent, "nome_fundo", "retorno_pct", round(1 - level, 8)).select(
        "nome_fundo", F.round(-F.col("quantil"), 4).cast("decimal(38,4)").alias("var_pct"))

    peak = F.max("pl").over(Window.partitionBy("nome_fundo").orderBy("data_posicao")
                            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    dd = (pl.withColumn("_peak", peak)
          .groupBy("nome_fundo")
          .agg(F.min(round_ratio(F.col("pl") - F.col("_peak"), F.col("_peak"), 4, times=100))
               .alias("max_drawdown_pct")))
    return moments.join(var, "nome_fundo", "left").join(dd, "nome_fundo", "left")
