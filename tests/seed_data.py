"""Seed fixture of the fund model as literal rows.

Fixed values: the worked example's rows (issuers, assets, funds, prices,
positions, trades), in their natural order, with surrogate keys numbered in
insertion order. The fund house prefix is a neutral "Casa".
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal as D

from pyspark.sql import SparkSession

from fundlens import schemas
from fundlens.model import Star

# Fixed values (seed rows).
EMISSORES = [
    (1, "Tesouro Nacional", "00.394.460/0001-41", None, "AAA"),
    (2, "Petroleo Brasileiro S.A. - Petrobras", "33.000.167/0001-01", "Energia", "BBB+"),
    (3, "Itau Unibanco Holding S.A.", "60.872.504/0001-23", "Financeiro", "AA-"),
    (4, "Vale S.A.", "33.592.510/0001-54", "Mineracao", "BBB+"),
    (5, "Banco Bradesco S.A.", "60.746.948/0001-12", "Financeiro", "AA-"),
    (6, "WEG S.A.", "84.429.695/0001-11", "Industrial", "A+"),
]

ATIVOS = [
    (1, "NTNB-2035", "Tesouro IPCA+ 2035", "Renda Fixa", "IPCA", date(2035, 5, 15), 1),
    (2, "NTNF-2031", "Tesouro Prefixado 2031", "Renda Fixa", "Prefixado", date(2031, 1, 1), 1),
    (3, "LFT-2027", "Tesouro Selic 2027", "Renda Fixa", "SELIC", date(2027, 9, 1), 1),
    (4, "PETR4", "Petrobras PN", "Renda Variavel", None, None, 2),
    (5, "PETRDB-2028", "Debenture Petrobras 2028", "Renda Fixa", "CDI", date(2028, 6, 15), 2),
    (6, "ITUB4", "Itau Unibanco PN", "Renda Variavel", None, None, 3),
    (7, "CDB-ITAU-2025", "CDB Itau 120% CDI 2025", "Renda Fixa", "CDI", date(2025, 12, 1), 3),
    (8, "VALE3", "Vale ON", "Renda Variavel", None, None, 4),
    (9, "LCI-BRAD-2026", "LCI Bradesco IPCA+1% 2026", "Renda Fixa", "IPCA", date(2026, 3, 15), 5),
    (10, "WEGE3", "WEG ON", "Renda Variavel", None, None, 6),
]

FUNDOS = [
    (1, "12.345.678/0001-90", "Casa RF Conservador FI", "Renda Fixa", date(2018, 3, 1), "ATIVO"),
    (2, "23.456.789/0001-01", "Casa Multimercado Macro FIM", "Multimercado", date(2019, 7, 15), "ATIVO"),
    (3, "34.567.890/0001-12", "Casa Acoes Brasil FIA", "Acoes", date(2020, 1, 10), "ATIVO"),
    (4, "45.678.901/0001-23", "Casa Previdencia PGBL FIE", "Previdencia", date(2017, 11, 20), "ATIVO"),
]

_D1, _D2 = date(2024, 5, 31), date(2024, 6, 3)
PRECOS = [
    (1, _D1, 1, "3542.180000", "ANBIMA"), (2, _D1, 2, "1089.540000", "ANBIMA"),
    (3, _D1, 3, "12456.780000", "ANBIMA"), (4, _D1, 4, "38.250000", "B3"),
    (5, _D1, 5, "1023.450000", "ANBIMA"), (6, _D1, 6, "32.180000", "B3"),
    (7, _D1, 7, "10245.600000", "ANBIMA"), (8, _D1, 8, "68.920000", "B3"),
    (9, _D1, 9, "1015.330000", "ANBIMA"), (10, _D1, 10, "42.670000", "B3"),
    (11, _D2, 1, "3548.920000", "ANBIMA"), (12, _D2, 2, "1091.230000", "ANBIMA"),
    (13, _D2, 3, "12489.340000", "ANBIMA"), (14, _D2, 4, "37.890000", "B3"),
    (15, _D2, 5, "1024.780000", "ANBIMA"), (16, _D2, 6, "31.950000", "B3"),
    (17, _D2, 7, "10267.450000", "ANBIMA"), (18, _D2, 8, "67.430000", "B3"),
    (19, _D2, 9, "1016.890000", "ANBIMA"), (20, _D2, 10, "43.120000", "B3"),
]

POSICOES = [
    (1, _D1, 1, 1, "5000.000000", "3542.180000", "17710900.00", "35.250000"),
    (2, _D1, 1, 2, "8000.000000", "1089.540000", "8716320.00", "17.340000"),
    (3, _D1, 1, 3, "200.000000", "12456.780000", "2491356.00", "4.958000"),
    (4, _D1, 1, 5, "15000.000000", "1023.450000", "15351750.00", "30.550000"),
    (5, _D1, 1, 7, "600.000000", "10245.600000", "6147360.00", "12.230000"),
    (6, _D1, 2, 1, "3000.000000", "3542.180000", "10626540.00", "18.750000"),
    (7, _D1, 2, 4, "120000.000000", "38.250000", "4590000.00", "8.100000"),
    (8, _D1, 2, 6, "200000.000000", "32.180000", "6436000.00", "11.350000"),
    (9, _D1, 2, 8, "80000.000000", "68.920000", "5513600.00", "9.730000"),
    (10, _D1, 2, 10, "150000.000000", "42.670000", "6400500.00", "11.295000"),
    (11, _D1, 3, 4, "500000.000000", "38.250000", "19125000.00", "42.500000"),
    (12, _D1, 3, 6, "350000.000000", "32.180000", "11263000.00", "25.030000"),
    (13, _D1, 3, 8, "200000.000000", "68.920000", "13784000.00", "30.630000"),
    (14, _D1, 3, 10, "20000.000000", "42.670000", "853400.00", "1.896000"),
    (15, _D1, 4, 1, "10000.000000", "3542.180000", "35421800.00", "40.120000"),
    (16, _D1, 4, 3, "500.000000", "12456.780000", "6228390.00", "7.053000"),
    (17, _D1, 4, 7, "2000.000000", "10245.600000", "20491200.00", "23.196000"),
    (18, _D1, 4, 9, "28000.000000", "1015.330000", "28429240.00", "32.188000"),
]

OPERACOES = [
    (1, date(2024, 5, 2), 1, 1, "COMPRA", "1000.000000", "3498.500000", "3498500.00"),
    (2, date(2024, 5, 10), 1, 2, "COMPRA", "3000.000000", "1082.300000", "3246900.00"),
    (3, date(2024, 5, 15), 1, 5, "COMPRA", "5000.000000", "1018.900000", "5094500.00"),
    (4, date(2024, 5, 20), 1, 3, "VENDA", "50.000000", "12380.000000", "619000.00"),
    (5, date(2024, 5, 28), 1, 7, "COMPRA", "200.000000", "10180.000000", "2036000.00"),
    (6, date(2024, 5, 3), 2, 4, "COMPRA", "50000.000000", "36.800000", "1840000.00"),
    (7, date(2024, 5, 7), 2, 6, "COMPRA", "80000.000000", "30.900000", "2472000.00"),
    (8, date(2024, 5, 14), 2, 8, "VENDA", "20000.000000", "71.500000", "1430000.00"),
    (9, date(2024, 5, 21), 2, 1, "COMPRA", "1000.000000", "3510.000000", "3510000.00"),
    (10, date(2024, 5, 27), 2, 10, "COMPRA", "50000.000000", "41.200000", "2060000.00"),
    (11, date(2024, 5, 6), 3, 4, "COMPRA", "100000.000000", "36.500000", "3650000.00"),
    (12, date(2024, 5, 8), 3, 6, "COMPRA", "100000.000000", "31.200000", "3120000.00"),
    (13, date(2024, 5, 13), 3, 8, "COMPRA", "50000.000000", "70.100000", "3505000.00"),
    (14, date(2024, 5, 22), 3, 10, "COMPRA", "10000.000000", "40.800000", "408000.00"),
    (15, date(2024, 5, 29), 3, 4, "VENDA", "20000.000000", "39.100000", "782000.00"),
    (16, date(2024, 5, 2), 4, 1, "COMPRA", "2000.000000", "3498.500000", "6997000.00"),
    (17, date(2024, 5, 9), 4, 3, "COMPRA", "100.000000", "12320.000000", "1232000.00"),
    (18, date(2024, 5, 16), 4, 7, "COMPRA", "500.000000", "10150.000000", "5075000.00"),
    (19, date(2024, 5, 23), 4, 9, "COMPRA", "10000.000000", "1008.000000", "10080000.00"),
    (20, date(2024, 5, 30), 4, 1, "COMPRA", "1500.000000", "3535.000000", "5302500.00"),
]


def _dec(rows, idx):
    return [tuple(D(v) if i in idx and v is not None else v for i, v in enumerate(r)) for r in rows]


def frame(spark: SparkSession, table: str, rows: list[tuple]):
    schema = schemas.TABLES[table]
    names = [f.name for f in schema.fields if f.name not in ("criado_em", "atualizado_em")]
    sub = [f for f in schema.fields if f.name in names]
    from pyspark.sql import types as T
    df = spark.createDataFrame(rows, T.StructType([T.StructField(f.name, f.dataType, True) for f in sub]))
    return schemas.conform(df, schema)


def seed_star(spark: SparkSession) -> Star:
    return Star(
        fundo=frame(spark, "fundo", FUNDOS),
        ativo=frame(spark, "ativo", ATIVOS),
        emissor=frame(spark, "emissor", EMISSORES),
        posicao=frame(spark, "posicao_carteira", _dec(POSICOES, {4, 5, 6, 7})),
        preco=frame(spark, "preco_mercado", _dec(PRECOS, {3})),
        operacao=frame(spark, "operacao", _dec(OPERACOES, {5, 6, 7})),
    )
