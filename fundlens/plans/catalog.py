"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each entry reads the driver's tables under ``sf_dir`` through the star
adapter and runs one portfolio query or operator on all of the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens import schemas
from fundlens.functions.text import fund_short_name, issuer_short_name, rating_bucket, truncate
from fundlens.operators import quality
from fundlens.operators.dedup import first_per_key
from fundlens.operators.joins import count_orphans, new_keys
from fundlens.plans import exposure, mtm, profile, ranking, risk
from fundlens.plans import flat as flatmod
from fundlens.plans.prices import business_days, cumulative_return, merge_prices, prices_by_priority, recent_returns
from fundlens.session import scratch_dir, written
from fundlens.sources.driver_tables import event_prices, kept_star, star_from_driver
from fundlens.sources.ingest import insert_once
from fundlens.sources.sinks import write_parquet
from fundlens.sources.versions import VersionedTable

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _star(spark: SparkSession, sf_dir: str):
    return star_from_driver(spark, sf_dir)


def _kept(spark: SparkSession, sf_dir: str):
    return kept_star(spark, sf_dir)


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatmod.flat_typed(_kept(spark, sf_dir))


@register("q01_prices_by_priority")
def q01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prices_by_priority(_star(spark, sf_dir).preco).select(
        "data_referencia", "id_ativo", "preco_mercado", "fonte_preco")


@register("q02_carteira_flat")
def q02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatmod.carteira_flat(_kept(spark, sf_dir))


def _by_year(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumn("ano", F.year(date_col))


@register("w01_kept_winners")
def w01_kept(spark, sf_dir):
    """The winning prices kept in a versioned table and merged load by load: the quotes come in three
    loads that cut across dates, assets and sources, so later loads hold late and better quotes."""
    quotes = written(_by_year(_star(spark, sf_dir).preco, "data_referencia"), "quotes")
    table = VersionedTable(spark, scratch_dir(spark, "winners"), ("ano",), ("data_referencia", "id_ativo"))
    for load in range(3):
        merge_prices(table, quotes.filter(F.pmod("id_preco", F.lit(3)) == load), loads={"quotes": load})
    return table.read().select("data_referencia", "id_ativo", "preco_mercado", "fonte_preco")


@register("x02_positions_as_of")
def x02(spark, sf_dir):
    """Positions published in versions: all of them, then 1995 corrected, then 1996 emptied; per version and year."""
    rows = written(_by_year(_star(spark, sf_dir).posicao, "data_posicao"), "positions")
    table = VersionedTable(spark, scratch_dir(spark, "positions"), ("ano",), ("data_posicao", "id_fundo"))
    table.append(rows)
    year = rows.filter("ano = 1995")
    table.replace(year.withColumn("valor_financeiro", (F.col("valor_financeiro") * 2).cast(schemas.MONEY)))
    table.replace(year.limit(0), folders=["ano=1996"])
    return quality.union_all([table.read(v).groupBy("ano").agg(
        F.count(F.lit(1)).alias("n_posicoes"), F.sum("valor_financeiro").cast("decimal(38,2)").alias("valor_total"))
        .select(F.lit(v).alias("versao"), "ano", "n_posicoes", "valor_total") for v in table.versions()])


@register("s11b_insert_once")
def s11b(spark, sf_dir):
    """The insertion of ``s11`` into a versioned price table, sent twice: the second time appends nothing."""
    star = _star(spark, sf_dir)
    cols = ["data_referencia", "id_ativo", "preco_mercado", "fonte_preco", "ano"]
    table = VersionedTable(spark, scratch_dir(spark, "prices"), ("ano",), ("data_referencia",))
    table.append(_by_year(star.preco, "data_referencia").select(*cols))
    batch = written(_by_year(star.posicao.select(
        F.col("data_posicao").alias("data_referencia"), "id_ativo", F.col("preco_unitario").alias("preco_mercado"),
        F.lit("ANBIMA").alias("fonte_preco"), "id_fundo"), "data_referencia"), "batch")
    keys = ["data_referencia", "id_ativo", "fonte_preco", "ano"]
    first = first_per_key(batch, keys, [F.col("id_fundo")]).select(*cols)
    for _ in range(2):
        insert_once(table, first, keys, "positions", 1)
    return table.read().groupBy("fonte_preco").agg(F.count(F.lit(1)).alias("n_precos"),
                                                   F.sum("preco_mercado").cast("decimal(38,6)").alias("soma"))


@register("q03b_overview_approx")
def q03b(spark, sf_dir):
    """The KPIs of all dates, merged from one kept row of sketches per date."""
    return exposure.overview_approx(written(exposure.kpi_sketches(_typed(spark, sf_dir)), "kpi-sketches"))


@register("q01b_event_prices_by_priority")
def q01b(spark, sf_dir):
    """Second price stream: only unknown sources, so every tie is at the fallback rank."""
    return prices_by_priority(event_prices(spark, sf_dir)).select(
        "data_referencia", "id_ativo", "preco_mercado", "fonte_preco", "id_preco")


@register("q03_overview_kpis")
def q03(spark, sf_dir):
    return exposure.overview(_typed(spark, sf_dir))


@register("q04_pl_by_fund")
def q04(spark, sf_dir):
    return exposure.pl_by_fund(_typed(spark, sf_dir))


@register("q04b_pl_by_fund_latest")
def q04b(spark, sf_dir):
    star = flatmod.scope_star(_star(spark, sf_dir), as_of="latest")
    return exposure.pl_by_fund(flatmod.flat_typed(star))


@register("a09_fund_summary")
def a09(spark, sf_dir):
    return exposure.fund_summary(_typed(spark, sf_dir))


@register("q05_fund_composition")
def q05(spark, sf_dir):
    return exposure.fund_composition(_typed(spark, sf_dir))


@register("q06_matrix_fund_asset")
def q06(spark, sf_dir):
    return exposure.matrix_fund_asset(_typed(spark, sf_dir))


@register("q07_exposure_by_class")
def q07(spark, sf_dir):
    return exposure.exposure_by_class(_typed(spark, sf_dir))


@register("q08_exposure_by_indexer")
def q08(spark, sf_dir):
    return exposure.exposure_by_indexer(_typed(spark, sf_dir))


@register("q08b_exposure_by_indexer_dropna")
def q08b(spark, sf_dir):
    """The text-file analysis' result: positions without an indexer dropped."""
    return exposure.exposure_by_indexer(_typed(spark, sf_dir), drop_missing=True)


@register("q09_matrix_fund_class")
def q09(spark, sf_dir):
    return exposure.matrix_fund_class(_typed(spark, sf_dir))


@register("q10_asset_ranking")
def q10(spark, sf_dir):
    return ranking.asset_ranking(_typed(spark, sf_dir))


@register("q11_issuer_distribution")
def q11(spark, sf_dir):
    return ranking.issuer_distribution(_typed(spark, sf_dir))


@register("q11b_issuer_distribution_dropna")
def q11b(spark, sf_dir):
    """The text-file analysis' result: issuers without a name or sector dropped."""
    return ranking.issuer_distribution(_typed(spark, sf_dir), drop_missing=True)


@register("q12_concentration_curve")
def q12(spark, sf_dir):
    return ranking.concentration_curve(_typed(spark, sf_dir))


@register("w03_pareto_point")
def w03(spark, sf_dir):
    return ranking.pareto_point(_typed(spark, sf_dir))


@register("q13_top5_assets")
def q13(spark, sf_dir):
    return exposure.top_assets(_typed(spark, sf_dir), 5)


@register("q14_pl_by_fund_type")
def q14(spark, sf_dir):
    return exposure.pl_by_fund_type(_typed(spark, sf_dir))


@register("q15_issuer_by_rating")
def q15(spark, sf_dir):
    return exposure.issuer_by_rating(_typed(spark, sf_dir))


@register("q16_sector_concentration")
def q16(spark, sf_dir):
    return exposure.sector_concentration(_typed(spark, sf_dir))


@register("m01_unit_vs_market")
def m01(spark, sf_dir):
    return mtm.unit_vs_market(_typed(spark, sf_dir))


@register("m02_mtm_impact")
def m02(spark, sf_dir):
    return mtm.mtm_impact(_typed(spark, sf_dir))


@register("q17_recent_returns")
def q17(spark, sf_dir):
    star = _star(spark, sf_dir)
    return recent_returns(prices_by_priority(star.preco), star.ativo, 30)


@register("w04_cumulative_return")
def w04(spark, sf_dir):
    p = prices_by_priority(_star(spark, sf_dir).preco)
    return cumulative_return(p).select("id_ativo", "data_referencia", "preco_mercado", "preco_base",
                                       "retorno_pct")


@register("f17_business_day_spine")
def f17(spark, sf_dir):
    return business_days(prices_by_priority(_star(spark, sf_dir).preco), 30)


@register("q18_describe")
def q18(spark, sf_dir):
    return profile.describe_flat(_typed(spark, sf_dir))


@register("a07_null_profile")
def a07(spark, sf_dir):
    return profile.null_profile(_typed(spark, sf_dir))


@register("q19_typed_from_text")
def q19(spark, sf_dir):
    return profile.typed_from_text(flatmod.carteira_flat(_kept(spark, sf_dir), sort=False))


@register("f06_parse_numbers")
def f06(spark, sf_dir):
    text = flatmod.carteira_flat(_kept(spark, sf_dir), sort=False)
    return profile.null_profile(profile.typed_from_text(text).select(*profile.TEXT_NUMERIC), only_missing=False)


@register("f07_fund_short_names")
def f07(spark, sf_dir):
    return _star(spark, sf_dir).fundo.select("nome_fundo", fund_short_name("nome_fundo").alias("fundo_curto"))


@register("f08_issuer_short_names")
def f08(spark, sf_dir):
    e = _star(spark, sf_dir).emissor
    return e.select("nome_emissor", issuer_short_name("nome_emissor", 22).alias("emissor_curto"),
                    truncate(issuer_short_name("nome_emissor", 22), 14).alias("rotulo"))


@register("f15_rating_buckets")
def f15(spark, sf_dir):
    f = _typed(spark, sf_dir)
    return f.groupBy(rating_bucket("rating_emissor").alias("faixa_rating")).agg(
        F.countDistinct("nome_emissor").alias("n_emissores"),
        F.sum("valor_financeiro").cast("decimal(38,2)").alias("valor_total"))


@register("p07_dropna")
def p07(spark, sf_dir):
    return _typed(spark, sf_dir).na.drop()


@register("p09_distinct_dates")
def p09(spark, sf_dir):
    return _typed(spark, sf_dir).select("data_posicao").distinct()


def _progressive(spark, sf_dir, upto: int):
    e = flatmod.enriched_positions((_kept if upto == 4 else _star)(spark, sf_dir), steps=upto)
    steps = [
        ["data_posicao", "id_fundo", "id_ativo", "quantidade", "valor_financeiro", "percentual_pl"],
        ["cnpj_fundo", "nome_fundo", "tipo_fundo"],
        ["codigo_ativo", "nome_ativo", "classe_ativo", "indexador", "data_vencimento"],
        ["nome_emissor", "cnpj_emissor", "setor_emissor", "rating_emissor"],
        ["preco_mercado", "fonte_preco"],
    ]
    cols = [c for step in steps[: upto + 1] for c in step]
    return e.select(*cols)


@register("j01_position_fund")
def j01(spark, sf_dir):
    return _progressive(spark, sf_dir, 1)


@register("j02_position_asset")
def j02(spark, sf_dir):
    return _progressive(spark, sf_dir, 2)


@register("j03_position_issuer")
def j03(spark, sf_dir):
    return _progressive(spark, sf_dir, 3)


@register("j04_position_price")
def j04(spark, sf_dir):
    return _progressive(spark, sf_dir, 4)


@register("j06_orphan_keys")
def j06(spark, sf_dir):
    star = _star(spark, sf_dir)
    fr = star.frames()
    parts = [count_orphans(fr[c], col, fr[p], pcol, f"{c}.{col}->{p}.{pcol}")
             for c, col, p, pcol in quality.FOREIGN_KEYS]
    return quality.union_all(parts)


@register("j08_inner_join_loss")
def j08(spark, sf_dir):
    e = flatmod.enriched_positions(_kept(spark, sf_dir))
    return e.agg(
        F.count(F.lit(1)).alias("n_posicoes"),
        F.count_if(~F.col("_hit_fundo")).alias("sem_fundo"),
        F.count_if(~F.col("_hit_ativo")).alias("sem_ativo"),
        F.count_if(~F.col("_hit_emissor")).alias("sem_emissor"),
        F.count_if(~F.col("_hit_preco")).alias("sem_preco"),
        F.count_if(~(F.col("_hit_fundo") & F.col("_hit_ativo") & F.col("_hit_emissor") & F.col("_hit_preco")))
        .alias("perdidas_inner"))


@register("v03_flat_output_checks")
def v03(spark, sf_dir):
    return quality.flat_report(flatmod.carteira_flat(_kept(spark, sf_dir), sort=False))


def _rules(spark, sf_dir, pick):
    fr = _star(spark, sf_dir).frames()
    parts = []
    for name, df in fr.items():
        rules = [r for r in quality.table_rules(name) if pick(r)]
        if rules:
            parts.append(quality.evaluate(df, rules))
    return quality.union_all(parts)


@register("v06_not_null")
def v06(spark, sf_dir):
    return _rules(spark, sf_dir, lambda r: r.regra == "V06")


@register("v07_unique_keys")
def v07(spark, sf_dir):
    fr = _star(spark, sf_dir).frames()
    return quality.union_all([quality.unique_keys(fr[t], t, k) for t, k in schemas.NATURAL_KEYS.items()])


@register("v08_foreign_keys")
def v08(spark, sf_dir):
    fr = _star(spark, sf_dir).frames()
    return quality.union_all([quality.foreign_key(fr[c], c, col, fr[p], p, pcol)
                              for c, col, p, pcol in quality.FOREIGN_KEYS])


@register("v09_non_negative")
def v09(spark, sf_dir):
    return _rules(spark, sf_dir, lambda r: r.regra == "V09")


@register("v10_positive_trades")
def v10(spark, sf_dir):
    return _rules(spark, sf_dir, lambda r: r.regra == "V10")


@register("v11_fund_status")
def v11(spark, sf_dir):
    return _rules(spark, sf_dir, lambda r: r.regra == "V11")


@register("v12_trade_types")
def v12(spark, sf_dir):
    return _rules(spark, sf_dir, lambda r: r.regra == "V12")


@register("v13_limits")
def v13(spark, sf_dir):
    return _rules(spark, sf_dir, lambda r: r.regra == "V13")


@register("v14_percent_sums")
def v14(spark, sf_dir):
    return quality.percent_sums(_star(spark, sf_dir).posicao)


@register("v15_consistency")
def v15(spark, sf_dir):
    return quality.consistency_rules(_star(spark, sf_dir).posicao)


@register("v15b_maturity")
def v15b(spark, sf_dir):
    """Positions whose asset has matured by 2030-01-01 (the rule's reference date here)."""
    return quality.maturity_rule(_typed(spark, sf_dir), as_of="2030-01-01")


def _damaged(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables with rule breaches at stated keys, so that every kind of rule finds bad rows."""
    def where(key: str, mod: int, rest: int, col: str, bad) -> F.Column:
        return F.when(F.col(key) % mod == rest, bad).otherwise(F.col(col))

    f, e, p, m, o = (frames[t] for t in ("fundo", "emissor", "posicao_carteira", "preco_mercado", "operacao"))
    fund = (f.withColumn("nome_fundo", where("id_fundo", 11, 5, "nome_fundo", F.lit(None)))
            .withColumn("status", where("id_fundo", 7, 3, "status", F.lit("PAUSADO"))))
    return {
        "fundo": fund.unionByName(fund.filter(F.col("id_fundo") % 5 == 0)),
        "emissor": e.withColumn("nome_emissor", where("id_emissor", 13, 1, "nome_emissor", F.repeat(F.lit("X"), 120))),
        "posicao_carteira": p.withColumn("quantidade", where("id_ativo", 23, 7, "quantidade", -F.col("quantidade"))),
        "preco_mercado": m.withColumn("preco_mercado", where("id_ativo", 31, 1, "preco_mercado", -F.col("preco_mercado"))),
        "operacao": (o.withColumn("tipo_operacao", where("id_ativo", 13, 4, "tipo_operacao", F.lit("ALUGUEL")))
                     .withColumn("quantidade", where("id_ativo", 17, 2, "quantidade", F.lit(0)))),
    }


@register("v16_rules_on_damaged_rows")
def v16(spark, sf_dir):
    """The rules of every kind on tables with breaches at stated keys: each count is above zero."""
    fr = _damaged(_star(spark, sf_dir).frames())
    wanted = {("V06", "nome_fundo"), ("V11", "status"), ("V13", "nome_emissor"), ("V09", "quantidade"),
              ("V09", "preco_mercado"), ("V10", "quantidade"), ("V12", "tipo_operacao")}
    parts = [quality.evaluate(df, rules) for t, df in fr.items()
             if (rules := [r for r in quality.table_rules(t) if (r.regra, r.coluna) in wanted])]
    parts.append(quality.unique_keys(fr["fundo"], "fundo", schemas.NATURAL_KEYS["fundo"]))
    return quality.union_all(parts)


@register("t01_trades_by_type")
def t01(spark, sf_dir):
    op = _star(spark, sf_dir).operacao
    return op.groupBy("tipo_operacao").agg(F.count(F.lit(1)).alias("n_operacoes"),
                                           F.sum("valor_operacao").cast("decimal(38,2)").alias("valor_total"))


@register("s11_insert_if_absent")
def s11(spark, sf_dir):
    """Quotes taken from position unit prices, inserted into the price table only
    where (date, asset, source) is new; one quote per key from the batch."""
    star = _star(spark, sf_dir)
    batch = star.posicao.select(F.col("data_posicao").alias("data_referencia"), "id_ativo",
                                F.col("preco_unitario").alias("preco_mercado"),
                                F.lit("ANBIMA").alias("fonte_preco"), "id_fundo")
    batch = first_per_key(batch, ["data_referencia", "id_ativo", "fonte_preco"], [F.col("id_fundo")])
    return new_keys(batch, star.preco, ["data_referencia", "id_ativo", "fonte_preco"])


@register("x03_flat_fixed_income")
def x03(spark, sf_dir):
    f = _typed(spark, sf_dir)
    return flatmod.render_flat(f.filter(F.col("classe_ativo") == "Renda Fixa"))


@register("x03b_flat_fund_dates_class")
def x03b(spark, sf_dir):
    """The flat view of one fund in a date window and class; filters go in before the joins."""
    star = flatmod.scope_star(_star(spark, sf_dir), date_from="1994-01-01", date_to="1995-12-31", fund="NATION_7 FIE")
    return flatmod.render_flat(flatmod.flat_typed(star).filter(F.col("classe_ativo") == "Renda Fixa"))


@register("x03c_clustered_flat_asset")
def x03c(spark, sf_dir):
    """The flat view written in files clustered by fund and asset, read back for one asset: a filter that
    is not on the date or the fund, and still skips files."""
    path = scratch_dir(spark, "clustered")
    write_parquet(written(_typed(spark, sf_dir), "flat"), path, cluster_by=("cnpj_fundo", "codigo_ativo"), file_rows=10_000)
    return flatmod.render_flat(spark.read.parquet(path).filter(F.col("codigo_ativo") == "P77"))


@register("x04_fund_risk")
def x04(spark, sf_dir):
    return risk.fund_risk(_typed(spark, sf_dir))


@register("x05_concentration_alerts")
def x05(spark, sf_dir):
    return ranking.concentration_alerts(_typed(spark, sf_dir), 1.0)


@register("f13_kpi_text")
def f13(spark, sf_dir):
    return exposure.overview_text(_typed(spark, sf_dir))


@register("a10_extremes_by_class")
def a10(spark, sf_dir):
    return exposure.extremes_by(_typed(spark, sf_dir), ["classe_ativo"])


@register("o04_flat_head")
def o04(spark, sf_dir):
    """The first rows of the ordered flat view (a head: the limit is the feature)."""
    return flatmod.carteira_flat(_kept(spark, sf_dir)).limit(10)


@register("p12_flat_shape")
def p12(spark, sf_dir):
    return profile.shape_of(_typed(spark, sf_dir))


@register("a01_table_rows")
def a01(spark, sf_dir):
    return profile.table_rows(_star(spark, sf_dir).frames())


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
