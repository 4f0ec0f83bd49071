"""Market prices: dedup by source priority, returns over price history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlens.functions.dates import business_day_spine
from fundlens.functions.exact import round_ratio
from fundlens.functions.priority import source_priority
from fundlens.operators.dedup import first_per_key
from fundlens.sources.ingest import in_partitions
from fundlens.sources.versions import Manifest, VersionedTable

PRICE_KEY = ("data_referencia", "id_ativo")


def prices_by_priority(prices: DataFrame, priorities: dict[str, int] | None = None) -> DataFrame:
    """One price per (date, asset): best source first (ANBIMA, B3, CETIP, BLOOMBERG,
    BACEN, then any other), ties broken by source name, then price id.

    Map-side combined aggregate (sort-based, see ``first_per_key``): a (date,
    asset) with many quotes costs one candidate per map task.
    """
    ranked = prices.withColumn("_prio", source_priority("fonte_preco", priorities))
    return first_per_key(ranked, PRICE_KEY, ["_prio", "fonte_preco", "id_preco"]).drop("_prio")


def merge_prices(winners: VersionedTable, batch: DataFrame, priorities: dict[str, int] | None = None,
                 loads: dict[str, int] | None = None) -> Manifest:
    """Bring the kept winning prices, one per (date, asset), up to date with a batch of quotes.

    The winner of all quotes is the winner of the kept winner and the new quotes (the least of one total order),
    so only the partitions the batch touches are read and replaced, whatever the length of
    the history. Quotes that come twice or late change nothing or their own key only. ``batch`` carries the
    columns of ``winners``, its partition columns among them.
    """
    base = winners.manifest()
    touched = winners.folders_of(batch)
    kept = winners.read(base.version, only=touched, schema=batch.schema).filter(in_partitions(winners, touched))
    merged = prices_by_priority(kept.unionByName(batch), priorities).select(*batch.columns)
    return winners.replace(merged, loads=loads, base=base)


def first_prices(prices: DataFrame, key: str = "id_ativo", date_col: str = "data_referencia",
                 price_col: str = "preco_mercado") -> DataFrame:
    """Earliest non-NULL price of each series (aggregate, combined map-side)."""
    return (prices.filter(F.col(price_col).isNotNull())
            .groupBy(key).agg(F.min_by(price_col, date_col).alias("preco_base"),
                              F.min(date_col).alias("data_base")))


def cumulative_return(prices: DataFrame, key: str = "id_ativo", date_col: str = "data_referencia",
                      price_col: str = "preco_mercado", scale: int = 4) -> DataFrame:
    """``(price / first price - 1) * 100`` per series, in percent from 0, HALF_UP to ``scale``.

    The first price comes from an aggregate joined back on the series key, so
    a series holding a third of the rows is never sorted inside one task.
    """
    base = first_prices(prices, key, date_col, price_col)
    out = prices.join(base, key, "left")
    return out.withColumn(
        "retorno_pct",
        round_ratio(F.col(price_col) - F.col("preco_base"), F.col("preco_base"), scale, times=100),
    ).drop("data_base")


def business_days(prices: DataFrame, n_days: int = 30) -> DataFrame:
    """``n_days`` weekdays ending on each asset's last price date: (id_ativo, data)."""
    ends = prices.groupBy("id_ativo").agg(F.max("data_referencia").alias("_fim"))
    return business_day_spine(ends, "_fim", n_days, out_col="data")


def recent_returns(prices: DataFrame, assets: DataFrame, n_days: int = 30, scale: int = 4) -> DataFrame:
    """Cumulative return of each asset over its last ``n_days`` business days.

    ``prices`` is deduplicated (one per date and asset). Days without a quote
    keep a row with NULL price and return; the base is the first quoted day in
    the window.
    """
    spine = business_days(prices, n_days)
    quotes = prices.select("id_ativo", F.col("data_referencia").alias("data"), "preco_mercado")
    series = spine.join(quotes, ["id_ativo", "data"], "left")
    # The base is the first quote inside the window. An asset has at most
    # 7 * n_days / 5 spine rows, so a window per asset is bounded by the calendar
    # and reads the series once (an aggregate joined back would derive the spine
    # twice).
    whole = Window.partitionBy("id_ativo").orderBy("data").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    with_ret = series.withColumn("_base", F.first("preco_mercado", ignorenulls=True).over(whole)).withColumn(
        "retorno_pct", round_ratio(F.col("preco_mercado") - F.col("_base"), F.col("_base"), scale, times=100))
    names = assets.select("id_ativo", "codigo_ativo", "classe_ativo")
    return with_ret.join(names, "id_ativo", "left").select(
        "codigo_ativo", "classe_ativo", "data", "preco_mercado", "retorno_pct")
