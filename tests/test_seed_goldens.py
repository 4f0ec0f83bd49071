"""Golden values on the seed fixture (18 positions, one date)."""

from __future__ import annotations

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from fundlens.operators import quality
from fundlens.plans import exposure, mtm, profile, ranking
from fundlens.plans.flat import carteira_flat, flat_typed
from fundlens.plans.prices import cumulative_return, prices_by_priority


@pytest.fixture(scope="module")
def flat(seed):
    return flat_typed(seed).cache()


def as_dict(df, k, v):
    return {r[k]: r[v] for r in df.collect()}


def test_flat_rows_and_first_row(seed):
    out = carteira_flat(seed)
    rows = out.collect()
    assert len(rows) == 18
    assert sum(r["preco_mercado"] != "N/A" for r in rows) == 18
    first = rows[0].asDict()
    assert first["data_posicao"] == "2024-05-31"
    assert first["cnpj_fundo"] == "12.345.678/0001-90"
    assert first["codigo_ativo"] == "CDB-ITAU-2025"
    assert first["quantidade"] == "600.000000"
    assert first["preco_mercado"] == "10245.600000"
    assert first["valor_financeiro"] == "6147360.00"
    assert first["percentual_pl"] == "12.230000"
    assert first["fonte_preco"] == "ANBIMA"
    assert first["data_vencimento"] == "2025-12-01"


def test_overview(flat):
    r = exposure.overview(flat).first()
    assert (r["n_fundos"], r["n_ativos"], r["n_emissores"]) == (4, 10, 6)
    assert r["pl_total"] == D("219580356.00")


def test_pl_by_fund_and_summary(flat):
    pl = [(r["nome_fundo"], r["pl"]) for r in exposure.pl_by_fund(flat).collect()]
    assert [v for _, v in pl] == [D("90570630.00"), D("50417686.00"), D("45025400.00"), D("33566640.00")]
    s = {r["fundo_curto"]: r["n_ativos"] for r in exposure.fund_summary(flat).collect()}
    assert s == {"Casa Previdencia PGBL": 4, "Casa RF Conservador": 5, "Casa Acoes Brasil": 4,
                 "Casa Multimercado Macro": 5}


def test_percent_sums_per_fund(seed):
    sums = sorted(r["soma_percentual"] for r in quality.percent_sums(seed.posicao).collect())
    assert sums == sorted([D("102.557000"), D("100.328000"), D("100.056000"), D("59.225000")])


def test_by_class_indexer_type_sector(flat):
    cls = {r["classe_ativo"]: (r["valor_total"], r["pct_total"]) for r in exposure.exposure_by_class(flat).collect()}
    assert cls == {"Renda Fixa": (D("151614856.00"), D("69.05")), "Renda Variavel": (D("67965500.00"), D("30.95"))}
    idx = as_dict(exposure.exposure_by_indexer(flat), "indexador", "valor_total")
    assert idx == {"IPCA": D("92188480.00"), "N/A": D("67965500.00"), "CDI": D("41990310.00"),
                   "SELIC": D("8719746.00"), "Prefixado": D("8716320.00")}
    typ = as_dict(exposure.pl_by_fund_type(flat), "tipo_fundo", "valor_total")
    assert typ == {"Previdencia": D("90570630.00"), "Renda Fixa": D("50417686.00"), "Acoes": D("45025400.00"),
                   "Multimercado": D("33566640.00")}
    sec = as_dict(exposure.sector_concentration(flat), "setor_emissor", "valor_total")
    assert sec == {"N/A": D("81195306.00"), "Financeiro": D("72766800.00"), "Energia": D("39066750.00"),
                   "Mineracao": D("19297600.00"), "Industrial": D("7253900.00")}


def test_issuer_table_and_curve(flat):
    rows = ranking.issuer_distribution(flat).orderBy("posicao").collect()
    got = [(r["valor_total"], r["n_ativos"], r["n_fundos"], r["pct_total"], r["pct_acum"]) for r in rows]
    assert got == [
        (D("81195306.00"), 3, 3, D("36.98"), D("36.98")),
        (D("44337560.00"), 2, 4, D("20.19"), D("57.17")),
        (D("39066750.00"), 2, 3, D("17.79"), D("74.96")),
        (D("28429240.00"), 1, 1, D("12.95"), D("87.91")),
        (D("19297600.00"), 1, 2, D("8.79"), D("96.70")),
        (D("7253900.00"), 1, 2, D("3.30"), D("100.00")),
    ]
    assert rows[0]["nome_emissor"] == "Tesouro Nacional"
    # The first two issuers hold 57.17%, not "more than 60%".
    assert rows[1]["pct_acum"] < 60
    p = ranking.pareto_point(flat).first()
    assert (p["posicao"], p["pct_acum"]) == (4, D("87.91"))
    curve = ranking.concentration_curve(flat).orderBy("posicao").collect()
    assert [r["ponto_pareto"] for r in curve] == [False, False, False, True, False, False]
    assert curve[1]["emissor_curto"] == "Itau Unibanco H"[:14]


def test_asset_ranking(flat):
    rows = ranking.asset_ranking(flat).orderBy("posicao").collect()
    got = [(r["codigo_ativo"], r["valor_total"], r["n_fundos"], r["pct_total"]) for r in rows]
    assert got == [
        ("NTNB-2035", D("63759240.00"), 3, D("29.04")), ("LCI-BRAD-2026", D("28429240.00"), 1, D("12.95")),
        ("CDB-ITAU-2025", D("26638560.00"), 2, D("12.13")), ("PETR4", D("23715000.00"), 2, D("10.80")),
        ("VALE3", D("19297600.00"), 2, D("8.79")), ("ITUB4", D("17699000.00"), 2, D("8.06")),
        ("PETRDB-2028", D("15351750.00"), 1, D("6.99")), ("LFT-2027", D("8719746.00"), 2, D("3.97")),
        ("NTNF-2031", D("8716320.00"), 1, D("3.97")), ("WEGE3", D("7253900.00"), 2, D("3.30")),
    ]
    top = [r["codigo_ativo"] for r in exposure.top_assets(flat, 5).collect()]
    assert top == ["NTNB-2035", "LCI-BRAD-2026", "CDB-ITAU-2025", "PETR4", "VALE3"]


def test_pivot_fund_class(flat):
    rows = {r["fundo_curto"]: (r["Renda Fixa"], r["Renda Variavel"])
            for r in exposure.matrix_fund_class(flat).collect()}
    assert rows["Casa Acoes Brasil"] == (D("0.00"), D("45.03"))
    assert rows["Casa Multimercado Macro"] == (D("10.63"), D("22.94"))
    assert rows["Casa Previdencia PGBL"] == (D("90.57"), D("0.00"))
    assert rows["Casa RF Conservador"] == (D("50.42"), D("0.00"))


def test_describe_valor_financeiro(flat):
    r = {x["coluna"]: x for x in profile.describe_flat(flat).collect()}["valor_financeiro"]
    assert r["count"] == 18
    assert (r["mean"], r["std"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]) == (
        D("12198908.67"), D("9211303.22"), D("853400.00"), D("6167617.50"), D("9671430.00"),
        D("17121112.50"), D("35421800.00"))


def test_mtm_zero_on_seed(flat):
    diffs = {r["diferenca_valor"] for r in mtm.mtm_impact(flat).collect()}
    assert diffs == {D("0.00")}
    um = mtm.unit_vs_market(flat).collect()
    assert len(um) == 10 and {r["diferenca_pct"] for r in um} == {D("0.0000")}


def test_price_return_between_dates(seed):
    p = prices_by_priority(seed.preco)
    r = cumulative_return(p).filter(F.col("data_referencia") == "2024-06-03")
    codes = {row["id_ativo"]: row["retorno_pct"] for row in r.collect()}
    expect = {7: "0.2133", 6: "-0.7147", 9: "0.1536", 3: "0.2614", 1: "0.1903", 2: "0.1551", 4: "-0.9412",
              5: "0.1300", 8: "-2.1619", 10: "1.0546"}
    assert codes == {k: D(v) for k, v in expect.items()}


def test_trades_and_consistency(seed):
    t = {r["tipo_operacao"]: (r["n"], r["v"]) for r in seed.operacao.groupBy("tipo_operacao").agg(
        F.count(F.lit(1)).alias("n"), F.sum("valor_operacao").alias("v")).collect()}
    assert t == {"COMPRA": (17, D("63127400.00")), "VENDA": (3, D("2831000.00"))}
    r = quality.consistency_rules(seed.posicao).first()
    assert r["n_invalidos"] == 0


def test_source_rules_pass_on_seed(seed):
    report = quality.source_report(seed.frames())
    failed = report.filter(~F.col("aprovado")).collect()
    assert failed == []
    quality.assert_passed(report)


def test_missing_buckets_dropped_reproduces_text_analysis(flat):
    rows = ranking.issuer_distribution(flat, drop_missing=True).orderBy("posicao").collect()
    assert [r["pct_total"] for r in rows[:2]] == [D("32.04"), D("28.23")]
    assert rows[1]["pct_acum"] == D("60.27")
    idx = {r["indexador"] for r in exposure.exposure_by_indexer(flat, drop_missing=True).collect()}
    assert "N/A" not in idx
    full = ranking.issuer_distribution(flat).orderBy("posicao").collect()
    assert [r["pct_acum_exato"] for r in full] == [D("36.98"), D("57.17"), D("74.96"), D("87.91"), D("96.70"),
                                                   D("100.00")]


def test_kpi_text_extremes_shape_and_table_rows(seed, flat):
    r = exposure.overview_text(flat).first()
    assert tuple(r) == ("R$ 219,580,356.00", "R$ 219.6M", "4", "10", "6", "18", "2024-05-31")
    ext = exposure.extremes_by(flat, ["classe_ativo"]).collect()
    assert {e["classe_ativo"] for e in ext} == {"Renda Fixa", "Renda Variavel"}
    assert min(e["valor_min"] for e in ext) == D("853400.00")
    assert max(e["valor_max"] for e in ext) == D("35421800.00")
    assert tuple(profile.shape_of(flat).first()) == (18, 19)
    counts = as_dict(profile.table_rows(seed.frames()), "tabela", "n_linhas")
    assert counts == {"emissor": 6, "ativo": 10, "fundo": 4, "posicao_carteira": 18, "preco_mercado": 20,
                      "operacao": 20}
