"""Invariants on the driver tables (sf0.001): what must hold whatever the data."""

from __future__ import annotations

import re
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from fundlens.plans import exposure, ranking
from fundlens.plans.flat import flat_typed
from fundlens.sources.driver_tables import star_from_driver

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def star(spark):
    return star_from_driver(spark, SMOKE)


@pytest.fixture(scope="module")
def flat(star):
    return flat_typed(star).cache()


def test_flat_keeps_every_position(star, flat):
    assert flat.count() == star.posicao.count()


def test_positions_reconcile_with_trades(star):
    pos = star.posicao.agg(F.sum("valor_financeiro")).first()[0]
    trades = star.operacao.agg(F.sum("valor_operacao")).first()[0]
    assert pos == trades


def test_group_totals_equal_the_portfolio_total(flat):
    total = exposure.overview(flat).first()["pl_total"]
    for q in (exposure.exposure_by_class, exposure.exposure_by_indexer, exposure.pl_by_fund_type,
              exposure.sector_concentration):
        assert q(flat).agg(F.sum("valor_total")).first()[0] == total
    assert ranking.issuer_distribution(flat).agg(F.sum("valor_total")).first()[0] == total


def test_shares_and_curve(flat):
    rows = ranking.issuer_distribution(flat).orderBy("posicao").collect()
    assert [r["posicao"] for r in rows] == list(range(1, len(rows) + 1))
    cum = [r["pct_acum_exato"] for r in rows]
    assert cum == sorted(cum) and cum[-1] == D("100.00")
    # rounded shares add up to 100 within half a cent per row
    assert abs(sum(r["pct_total"] for r in rows) - 100) <= D("0.005") * len(rows)
    values = [r["valor_total"] for r in rows]
    assert values == sorted(values, reverse=True)


def test_percent_of_pl_sums_to_100_per_fund_and_day(star):
    sums = star.posicao.groupBy("data_posicao", "id_fundo").agg(F.sum("percentual_pl").alias("s"))
    worst = sums.agg(F.max(F.abs(F.col("s") - 100))).first()[0]
    assert worst <= D("0.0005") * 50   # one half-unit of rounding per position at most


def test_fund_composition_shares_per_fund(flat):
    per_fund = exposure.fund_composition(flat).groupBy("nome_fundo").agg(F.sum("share_fundo").alias("s"))
    assert per_fund.filter(F.abs(F.col("s") - 100) > 1).count() == 0


def test_registered_plans_have_no_single_task_window_on_data(spark, monkeypatch):
    import __spark_entry__ as entry
    from fundlens.operators import ordered

    written_plans = []
    write = ordered.written
    monkeypatch.setattr(ordered, "written", lambda df, name: written_plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or write(df, name))
    for name in ("q10_asset_ranking", "q11_issuer_distribution", "q12_concentration_curve"):
        written_plans.clear()
        plan = entry.queries()[name](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
        # The rows are range partitioned where they are numbered: in the stage that writes them.
        assert any("rangepartitioning(" in p for p in written_plans), name
        # What is left of windows without keys runs over totals of the written partitions, one row each.
        for at in re.finditer(r"Window \[[^\n]*", plan):
            below = plan[at.end():].split("Window [")[0]
            assert "HashAggregate(keys=[_pid" in below or "_pid" in at.group(), name


def _rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_fund_composition_salted_equals_default(flat):
    # hot_min_rows=1: every fund above max(1, rows / 10,000) rows is salted
    assert _rows(exposure.fund_composition(flat, hot_min_rows=1)) == _rows(exposure.fund_composition(flat))


def test_adapter_positions_salted_equal_plain_join(star):
    from fundlens.sources.driver_tables import posicao
    trades = star.operacao
    salted = posicao(trades, hot_min_rows=1)
    grouped = trades.groupBy("data_operacao", "id_fundo", "id_ativo").agg(
        F.sum("valor_operacao").cast("decimal(18,2)").alias("v"))
    pl = grouped.groupBy("data_operacao", "id_fundo").agg(F.sum("v").alias("pl"))
    plain = grouped.join(pl, ["data_operacao", "id_fundo"]).select(
        F.col("data_operacao").alias("data_posicao"), "id_fundo", "id_ativo", F.col("v").alias("valor_financeiro"))
    assert salted.count() == plain.count()
    assert _rows(salted.select("data_posicao", "id_fundo", "id_ativo", "valor_financeiro")) == _rows(plain)
