"""Fund risk metrics against a hand computation on a small multi-date series."""

from __future__ import annotations

from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal as D

from pyspark.sql import types as T

from fundlens.plans.risk import fund_risk


def q(x: D, places: int) -> D:
    return x.quantize(D(1).scaleb(-places), rounding=ROUND_HALF_UP)


def test_var_and_drawdown_match_hand_computation(spark):
    pls = {"A": ["100.00", "110.00", "99.00", "120.00", "90.00", "95.00"],
           "B": ["50.00", "50.00", "55.00", "44.00", "66.00", "60.00"]}
    d0 = date(2024, 1, 1)
    rows = [(f, d0 + timedelta(days=i), D(v)) for f, vs in pls.items() for i, v in enumerate(vs)]
    schema = T.StructType([T.StructField("nome_fundo", T.StringType()), T.StructField("data_posicao", T.DateType()),
                           T.StructField("valor_financeiro", T.DecimalType(18, 2))])
    out = {r["nome_fundo"]: r for r in fund_risk(spark.createDataFrame(rows, schema), window=3).collect()}
    for f, vs in pls.items():
        v = [D(x) for x in vs]
        rets = [q((v[i] - v[i - 1]) * 100 / v[i - 1], 6) for i in range(1, len(v))][-3:]
        s = sorted(rets)
        pos = (len(s) - 1) * D("0.05")
        lo, hi = int(pos), min(int(pos) + 1, len(s) - 1)
        var = q(-(s[lo] + (s[hi] - s[lo]) * (pos - lo)), 4)
        peak, dd = v[0], D(0)
        for x in v:
            peak = max(peak, x)
            dd = min(dd, q((x - peak) * 100 / peak, 4))
        assert out[f]["n_retornos"] == 3
        assert out[f]["var_pct"] == var
        assert out[f]["max_drawdown_pct"] == dd
