"""DuckDB oracle SQL for the registered queries.

Each query starts from the same star schema, written here as CTEs over the
driver's views (region nation customer supplier part orders lineitem events).
The SQL is an independent statement of each query's meaning, used only to
check the Spark plans; it mirrors the adapter rules of
``fundlens.sources.driver_tables`` (fixed values repeated here on purpose).
"""

from __future__ import annotations

from fundlens.functions.exact import sql_round_ratio as rr
from fundlens.functions.priority import sql_source_priority

_FUND_SUFFIX = "CASE n.n_nationkey % 4 WHEN 0 THEN ' FI' WHEN 1 THEN ' FIM' WHEN 2 THEN ' FIA' ELSE ' FIE' END"
_INDEXER = "CASE p.p_partkey % 4 WHEN 0 THEN 'CDI' WHEN 1 THEN 'IPCA' WHEN 2 THEN 'SELIC' ELSE 'Prefixado' END"
_SOURCE = ("CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'ANBIMA' WHEN 'AO' THEN 'B3' WHEN 'NF' THEN 'CETIP' "
           "WHEN 'NO' THEN 'BLOOMBERG' WHEN 'RF' THEN 'BACEN' ELSE 'OUTRA' END")

STAR = f"""
fundo AS (
  SELECT CAST(n.n_nationkey AS BIGINT) AS id_fundo,
         'F' || CAST(n.n_nationkey AS VARCHAR) AS cnpj_fundo,
         n.n_name || {_FUND_SUFFIX} AS nome_fundo,
         r.r_name AS tipo_fundo,
         DATE '2000-01-01' AS data_inicio,
         'ATIVO' AS status
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
emissor AS (
  SELECT CAST(s_suppkey AS BIGINT) AS id_emissor, s_name AS nome_emissor,
         'E' || CAST(s_suppkey AS VARCHAR) AS cnpj_emissor,
         CASE WHEN s_nationkey % 5 <> 0 THEN 'SETOR_' || CAST(s_nationkey % 5 AS VARCHAR) END AS setor,
         CASE WHEN s_acctbal < 0 THEN NULL WHEN s_acctbal < 2500 THEN 'BBB+' WHEN s_acctbal < 5000 THEN 'A+'
              WHEN s_acctbal < 7500 THEN 'AA-' ELSE 'AAA' END AS rating
  FROM supplier),
ativo AS (
  SELECT CAST(p.p_partkey AS BIGINT) AS id_ativo, 'P' || CAST(p.p_partkey AS VARCHAR) AS codigo_ativo,
         p.p_name AS nome_ativo,
         CASE WHEN p.p_size >= 10 THEN 'Renda Fixa' ELSE 'Renda Variavel' END AS classe_ativo,
         CASE WHEN p.p_size >= 10 AND p.p_partkey % 5 <> 0 THEN {_INDEXER} END AS indexador,
         CASE WHEN p.p_size >= 10 THEN DATE '2025-01-01' + CAST(p.p_partkey % 3650 AS INTEGER) END
           AS data_vencimento,
         CAST(CASE WHEN i.sup % 10 = 3 THEN -i.sup ELSE i.sup END AS BIGINT) AS id_emissor
  FROM part p LEFT JOIN (SELECT l_partkey, min(l_suppkey) AS sup FROM lineitem GROUP BY l_partkey) i
    ON p.p_partkey = i.l_partkey),
line_nation AS (
  SELECT l.*, CAST(o.o_orderdate AS DATE) AS odate, CAST(c.c_nationkey AS BIGINT) AS nation
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey),
pos_g AS (
  SELECT odate AS data_posicao, nation AS id_fundo, CAST(l_partkey AS BIGINT) AS id_ativo,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,6))) AS DECIMAL(18,6)) AS quantidade,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS valor_financeiro
  FROM line_nation GROUP BY 1, 2, 3),
posicao AS (
  SELECT hash(g.data_posicao, g.id_fundo, g.id_ativo) AS id_posicao,
         g.data_posicao, g.id_fundo, g.id_ativo, g.quantidade,
         CAST({rr('g.valor_financeiro', 'g.quantidade', 6, num_scale=2, den_scale=6)} AS DECIMAL(18,6))
           AS preco_unitario,
         g.valor_financeiro,
         CAST({rr('g.valor_financeiro', 't.pl', 6, times=100)} AS DECIMAL(9,6)) AS percentual_pl
  FROM pos_g g JOIN (SELECT data_posicao, id_fundo, sum(valor_financeiro) AS pl FROM pos_g GROUP BY 1, 2) t
    ON g.data_posicao = t.data_posicao AND g.id_fundo = t.id_fundo),
preco AS (
  SELECT hash(data_referencia, id_ativo, fonte_preco) AS id_preco, * FROM (
    SELECT CAST(CASE WHEN l_partkey % 20 = 7 THEN l_shipdate ELSE o_orderdate END AS DATE) AS data_referencia, CAST(l_partkey AS BIGINT) AS id_ativo,
           {_SOURCE} AS fonte_preco,
           CAST(max(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,6)) AS preco_mercado
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3)),
preco_dedup AS (
  SELECT data_referencia, id_ativo, preco_mercado, fonte_preco FROM (
    SELECT *, row_number() OVER (PARTITION BY data_referencia, id_ativo
                                 ORDER BY {sql_source_priority('fonte_preco')}, fonte_preco) AS rn
    FROM preco) WHERE rn = 1),
operacao AS (
  SELECT hash(l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id_operacao,
         odate AS data_operacao, nation AS id_fundo, CAST(l_partkey AS BIGINT) AS id_ativo,
         CASE WHEN l_returnflag = 'R' THEN 'VENDA' ELSE 'COMPRA' END AS tipo_operacao,
         CAST(l_quantity AS DECIMAL(18,6)) AS quantidade,
         CAST({rr('CAST(l_extendedprice AS DECIMAL(18,2))', 'CAST(l_quantity AS DECIMAL(18,6))', 6,
                  num_scale=2, den_scale=6)} AS DECIMAL(18,6)) AS preco_operacao,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS valor_operacao
  FROM line_nation),
flat AS (
  SELECT p.data_posicao, f.cnpj_fundo, f.nome_fundo, f.tipo_fundo, a.codigo_ativo, a.nome_ativo,
         a.classe_ativo, a.indexador, a.data_vencimento, e.nome_emissor, e.cnpj_emissor,
         e.setor AS setor_emissor, e.rating AS rating_emissor, p.quantidade, p.preco_unitario,
         pr.preco_mercado, p.valor_financeiro, p.percentual_pl, pr.fonte_preco,
         p.id_fundo, p.id_ativo, a.id_emissor,
         f.id_fundo IS NOT NULL AS hit_fundo, a.id_ativo IS NOT NULL AS hit_ativo,
         e.id_emissor IS NOT NULL AS hit_emissor, pr.id_ativo IS NOT NULL AS hit_preco
  FROM posicao p
  LEFT JOIN fundo f ON p.id_fundo = f.id_fundo
  LEFT JOIN ativo a ON p.id_ativo = a.id_ativo
  LEFT JOIN emissor e ON a.id_emissor = e.id_emissor
  LEFT JOIN preco_dedup pr ON p.data_posicao = pr.data_referencia AND p.id_ativo = pr.id_ativo)
"""


def with_star(body: str, ctes: str = "") -> str:
    extra = f",\n{ctes.strip()}" if ctes.strip() else ""
    return f"WITH {STAR.strip()}{extra}\n{body.strip()}"


FLAT_RENDER = """
SELECT strftime(data_posicao, '%Y-%m-%d') AS data_posicao, cnpj_fundo, nome_fundo, tipo_fundo,
       codigo_ativo, nome_ativo, classe_ativo,
       coalesce(indexador, 'N/A') AS indexador,
       coalesce(strftime(data_vencimento, '%Y-%m-%d'), 'INDEFINIDO') AS data_vencimento,
       nome_emissor, cnpj_emissor,
       coalesce(setor_emissor, 'N/A') AS setor_emissor,
       coalesce(rating_emissor, 'NR') AS rating_emissor,
       CAST(quantidade AS VARCHAR) AS quantidade,
       CAST(preco_unitario AS VARCHAR) AS preco_unitario,
       coalesce(CAST(preco_mercado AS VARCHAR), 'N/A') AS preco_mercado,
       CAST(valor_financeiro AS VARCHAR) AS valor_financeiro,
       CAST(percentual_pl AS VARCHAR) AS percentual_pl,
       coalesce(fonte_preco, 'N/A') AS fonte_preco
FROM flat
"""

FLAT_COLS = ("data_posicao", "cnpj_fundo", "nome_fundo", "tipo_fundo", "codigo_ativo", "nome_ativo",
             "classe_ativo", "indexador", "data_vencimento", "nome_emissor", "cnpj_emissor", "setor_emissor",
             "rating_emissor", "quantidade", "preco_unitario", "preco_mercado", "valor_financeiro",
             "percentual_pl", "fonte_preco")
TYPED = ", ".join(FLAT_COLS)
SHORT_FUND = "regexp_replace({c}, ' (FI|FIM|FIA|FIE)$', '')"
SHORT_ISSUER = "substring(split_part(split_part({c}, ' S.A.', 1), ' -', 1), 1, 22)"
BUCKET = ("CASE WHEN coalesce({c}, 'NR') = 'AAA' THEN 'AAA' WHEN starts_with(coalesce({c}, 'NR'), 'AA') THEN 'AA' "
          "WHEN coalesce({c}, 'NR') = 'A+' THEN 'A+' WHEN coalesce({c}, 'NR') = 'BBB+' THEN 'BBB+' "
          "WHEN coalesce({c}, 'NR') = 'NR' THEN 'NR' ELSE 'OUTROS' END")
MONEY_SUM = "CAST(sum(valor_financeiro) AS DECIMAL(38,2))"


def mi(col: str, scale: int = 2) -> str:
    return rr(col, "1000000", scale, num_scale=2, den_scale=0)


def share(col: str, total: str) -> str:
    return rr(col, total, 2, times=100)


def product(a: str, b: str) -> str:
    return f"CAST(CAST({a} AS DECIMAL(38,6)) * CAST({b} AS DECIMAL(38,6)) AS DECIMAL(38,2))"


QUERIES: dict[str, str] = {}


def _q(name: str, body: str, ctes: str = "") -> None:
    QUERIES[name] = with_star(body, ctes)


def _shared(key_sql: str, key_name: str, where: str = "") -> tuple[str, str]:
    ctes = f"g AS (SELECT {key_sql} AS {key_name}, {MONEY_SUM} AS valor_total FROM flat {where} GROUP BY 1)"
    body = f"SELECT {key_name}, valor_total, {share('valor_total', '(SELECT sum(valor_total) FROM g)')} AS pct_total FROM g"
    return body, ctes


_q("q01_prices_by_priority", "SELECT data_referencia, id_ativo, preco_mercado, fonte_preco FROM preco_dedup")
_q("w01_kept_winners", "SELECT data_referencia, id_ativo, preco_mercado, fonte_preco FROM preco_dedup")
_q("x02_positions_as_of", """
SELECT versao, CAST(ano AS INTEGER) AS ano, count(*) AS n_posicoes, CAST(sum(valor * fator) AS DECIMAL(38,2)) AS valor_total
FROM (SELECT v AS versao, year(data_posicao) AS ano, valor_financeiro AS valor,
             CASE WHEN v >= 2 AND year(data_posicao) = 1995 THEN 2 ELSE 1 END AS fator
      FROM posicao, (VALUES (1), (2), (3)) t(v) WHERE v < 3 OR year(data_posicao) <> 1996)
GROUP BY 1, 2""")
_q("s11b_insert_once", """
SELECT fonte_preco, count(*) AS n_precos, CAST(sum(preco_mercado) AS DECIMAL(38,6)) AS soma FROM (
  SELECT fonte_preco, preco_mercado FROM preco
  UNION ALL
  SELECT fonte_preco, preco_mercado FROM b
  WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM preco p WHERE p.data_referencia = b.data_referencia
                               AND p.id_ativo = b.id_ativo AND p.fonte_preco = b.fonte_preco)) GROUP BY 1""", """
b AS (SELECT data_posicao AS data_referencia, id_ativo, preco_unitario AS preco_mercado, 'ANBIMA' AS fonte_preco,
             row_number() OVER (PARTITION BY data_posicao, id_ativo ORDER BY id_fundo) AS rn
      FROM posicao)""")
_q("q01b_event_prices_by_priority", f"""
SELECT data_referencia, id_ativo, preco_mercado, fonte_preco, id_preco FROM (
  SELECT *, row_number() OVER (PARTITION BY data_referencia, id_ativo
                               ORDER BY {sql_source_priority('fonte_preco')}, fonte_preco, id_preco) AS rn
  FROM ev) WHERE rn = 1""", """
ev AS (SELECT CAST(event_id AS BIGINT) AS id_preco, CAST(ts AS DATE) AS data_referencia,
              CAST(user_id AS BIGINT) AS id_ativo, CAST(value AS DECIMAL(18,6)) AS preco_mercado,
              event_type AS fonte_preco FROM events)""")
_q("q02_carteira_flat", FLAT_RENDER)
_q("q03_overview_kpis", f"""
SELECT count(DISTINCT nome_fundo) AS n_fundos, count(DISTINCT codigo_ativo) AS n_ativos,
       count(DISTINCT nome_emissor) AS n_emissores, {MONEY_SUM} AS pl_total, count(*) AS n_posicoes,
       min(data_posicao) AS data_inicial, max(data_posicao) AS data_final
FROM flat""")
_q("q04_pl_by_fund", f"SELECT nome_fundo, {MONEY_SUM} AS pl FROM flat GROUP BY nome_fundo")
_q("q04b_pl_by_fund_latest", f"""
SELECT nome_fundo, {MONEY_SUM} AS pl FROM flat
WHERE data_posicao = (SELECT max(data_posicao) FROM flat) GROUP BY nome_fundo""")
_q("a09_fund_summary", f"""
SELECT nome_fundo, {SHORT_FUND.format(c='nome_fundo')} AS fundo_curto, pl, {mi('pl', 1)} AS pl_mi, n_ativos
FROM (SELECT nome_fundo, {MONEY_SUM} AS pl, count(DISTINCT codigo_ativo) AS n_ativos FROM flat GROUP BY 1)""")
_q("q05_fund_composition", f"""
SELECT g.nome_fundo, g.codigo_ativo, g.valor_total, g.pct_pl,
       {rr('g.pct_pl', 't.fp', 2, times=100, num_scale=6, den_scale=6)} AS share_fundo
FROM g LEFT JOIN (SELECT nome_fundo, sum(pct_pl) AS fp FROM g GROUP BY 1) t ON g.nome_fundo = t.nome_fundo""",
   f"""g AS (SELECT nome_fundo, codigo_ativo, {MONEY_SUM} AS valor_total,
              CAST(sum(percentual_pl) AS DECIMAL(38,6)) AS pct_pl FROM flat GROUP BY 1, 2)""")
_q("q06_matrix_fund_asset", f"""
SELECT nome_fundo, codigo_ativo, CAST(sum(percentual_pl) AS DECIMAL(38,6)) AS pct_pl,
       {SHORT_FUND.format(c='nome_fundo')} AS fundo_curto
FROM flat GROUP BY 1, 2""")
_q("q07_exposure_by_class", *_shared("classe_ativo", "classe_ativo"))
_q("q08_exposure_by_indexer", *_shared("coalesce(indexador, 'N/A')", "indexador"))
_q("q08b_exposure_by_indexer_dropna", *_shared("coalesce(indexador, 'N/A')", "indexador",
                                              "WHERE indexador IS NOT NULL"))
_q("q09_matrix_fund_class", f"""
SELECT nome_fundo, {SHORT_FUND.format(c='nome_fundo')} AS fundo_curto,
       coalesce({mi('rf')}, CAST(0 AS DECIMAL(38,2))) AS "Renda Fixa",
       coalesce({mi('rv')}, CAST(0 AS DECIMAL(38,2))) AS "Renda Variavel"
FROM (SELECT nome_fundo,
             CAST(sum(CASE WHEN classe_ativo = 'Renda Fixa' THEN valor_financeiro END) AS DECIMAL(38,2)) AS rf,
             CAST(sum(CASE WHEN classe_ativo = 'Renda Variavel' THEN valor_financeiro END) AS DECIMAL(38,2)) AS rv
      FROM flat GROUP BY 1)""")
_q("q10_asset_ranking", f"""
SELECT codigo_ativo, nome_ativo, classe_ativo, valor_total, n_fundos,
       {share('valor_total', '(SELECT sum(valor_total) FROM g)')} AS pct_total,
       {mi('valor_total')} AS valor_mi,
       concat_ws(' ', codigo_ativo, substring(nome_ativo, 1, 18)) AS rotulo,
       row_number() OVER (ORDER BY valor_total DESC, codigo_ativo ASC NULLS LAST) AS posicao
FROM g""", f"""g AS (SELECT codigo_ativo, nome_ativo, classe_ativo, {MONEY_SUM} AS valor_total,
              count(DISTINCT nome_fundo) AS n_fundos FROM flat GROUP BY 1, 2, 3)""")
def _issuers(where: str = "") -> str:
    return f"""
ig AS (SELECT nome_emissor, coalesce(setor_emissor, 'N/A') AS setor_emissor,
              coalesce(rating_emissor, 'NR') AS rating_emissor, {MONEY_SUM} AS valor_total,
              count(DISTINCT codigo_ativo) AS n_ativos, count(DISTINCT nome_fundo) AS n_fundos
       FROM flat {where} GROUP BY 1, 2, 3),
isx AS (SELECT *, {share('valor_total', '(SELECT sum(valor_total) FROM ig)')} AS pct_total,
               {mi('valor_total')} AS valor_mi FROM ig),
d0 AS (SELECT *,
        row_number() OVER (ORDER BY valor_total DESC, nome_emissor ASC NULLS LAST, setor_emissor, rating_emissor)
          AS posicao,
        CAST(sum(pct_total) OVER (ORDER BY valor_total DESC, nome_emissor ASC NULLS LAST, setor_emissor,
                                  rating_emissor ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
             AS DECIMAL(38,2)) AS pct_acum,
        sum(valor_total) OVER (ORDER BY valor_total DESC, nome_emissor ASC NULLS LAST, setor_emissor,
                               rating_emissor ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS valor_acum
      FROM isx),
d AS (SELECT * EXCLUDE (valor_acum),
             {rr('valor_acum', '(SELECT sum(valor_total) FROM ig)', 2, times=100)} AS pct_acum_exato FROM d0)"""


ISSUERS = _issuers()
ISSUERS_DROPNA = _issuers("WHERE nome_emissor IS NOT NULL AND setor_emissor IS NOT NULL")
_q("q11_issuer_distribution", "SELECT * FROM d", ISSUERS)
_q("q11b_issuer_distribution_dropna", "SELECT * FROM d", ISSUERS_DROPNA)
_q("q12_concentration_curve", f"""
SELECT posicao, nome_emissor, CAST(posicao AS VARCHAR) || 'º emissor' AS rotulo_posicao,
       substring({SHORT_ISSUER.format(c='nome_emissor')}, 1, 14) AS emissor_curto, pct_total, pct_acum,
       pct_acum >= 80 AS acima_limite,
       coalesce(posicao = (SELECT min(posicao) FROM d WHERE pct_acum >= 80), false) AS ponto_pareto
FROM d""", ISSUERS)
_q("w03_pareto_point", "SELECT posicao, nome_emissor, pct_acum FROM d WHERE pct_acum >= 80 ORDER BY posicao LIMIT 1",
   ISSUERS)
_q("q13_top5_assets", f"""
SELECT codigo_ativo, {MONEY_SUM} AS valor_total FROM flat GROUP BY 1
ORDER BY valor_total DESC, codigo_ativo LIMIT 5""")
_q("q14_pl_by_fund_type", *_shared("tipo_fundo", "tipo_fundo"))
_q("q15_issuer_by_rating", f"""
SELECT nome_emissor, rating_emissor, substring(split_part(nome_emissor, ' S.A.', 1), 1, 20) AS emissor_curto,
       {BUCKET.format(c='rating_emissor')} AS faixa_rating, valor_total
FROM (SELECT nome_emissor, coalesce(rating_emissor, 'NR') AS rating_emissor, {MONEY_SUM} AS valor_total
      FROM flat GROUP BY 1, 2)""")
_q("q16_sector_concentration", *_shared("coalesce(setor_emissor, 'N/A')", "setor_emissor"))
_q("m01_unit_vs_market", f"""
SELECT codigo_ativo, nome_ativo, classe_ativo, preco_unitario, preco_mercado,
       {rr('preco_mercado - preco_unitario', 'preco_unitario', 4, times=100, num_scale=6, den_scale=6)}
         AS diferenca_pct,
       coalesce(fonte_preco, 'N/A') AS fonte_preco
FROM (SELECT *, row_number() OVER (PARTITION BY codigo_ativo ORDER BY data_posicao, cnpj_fundo) AS rn FROM flat)
WHERE rn = 1""")
_q("m02_mtm_impact", f"""
SELECT data_posicao, cnpj_fundo, codigo_ativo, quantidade, preco_unitario, preco_mercado,
       vc AS valor_custodia, vm AS valor_mercado, vm - vc AS diferenca_valor,
       CASE WHEN vm - vc >= 0 THEN 'positivo' WHEN vm - vc < 0 THEN 'negativo' END AS sinal
FROM (SELECT *, {product('quantidade', 'preco_unitario')} AS vc, {product('quantidade', 'preco_mercado')} AS vm
      FROM flat WHERE classe_ativo = 'Renda Fixa')""")
SPINE = """
ends AS (SELECT id_ativo, max(data_referencia) AS fim0 FROM preco_dedup GROUP BY 1),
e2 AS (SELECT id_ativo, CASE isodow(fim0) WHEN 6 THEN fim0 - 1 WHEN 7 THEN fim0 - 2 ELSE fim0 END AS fim FROM ends),
cal AS (SELECT e2.id_ativo, e2.fim - CAST(r.i AS INTEGER) AS data FROM e2 CROSS JOIN range(0, 57) r(i)),
spine AS (SELECT id_ativo, data FROM (
            SELECT id_ativo, data, row_number() OVER (PARTITION BY id_ativo ORDER BY data DESC) AS k
            FROM cal WHERE isodow(data) < 6) WHERE k <= 30)"""
_q("f17_business_day_spine", "SELECT id_ativo, data FROM spine", SPINE)
_q("q17_recent_returns", f"""
SELECT a.codigo_ativo, a.classe_ativo, s.data, s.preco_mercado,
       {rr('s.preco_mercado - b.preco_base', 'b.preco_base', 4, times=100, num_scale=6, den_scale=6)} AS retorno_pct
FROM series s LEFT JOIN base b ON s.id_ativo = b.id_ativo LEFT JOIN ativo a ON s.id_ativo = a.id_ativo""",
   SPINE + """,
series AS (SELECT s.id_ativo, s.data, p.preco_mercado FROM spine s
           LEFT JOIN preco_dedup p ON s.id_ativo = p.id_ativo AND s.data = p.data_referencia),
base AS (SELECT id_ativo, arg_min(preco_mercado, data) AS preco_base FROM series
         WHERE preco_mercado IS NOT NULL GROUP BY 1)""")
_q("w04_cumulative_return", f"""
SELECT p.id_ativo, p.data_referencia, p.preco_mercado, b.preco_base,
       {rr('p.preco_mercado - b.preco_base', 'b.preco_base', 4, times=100, num_scale=6, den_scale=6)} AS retorno_pct
FROM preco_dedup p LEFT JOIN base b ON p.id_ativo = b.id_ativo""",
   "base AS (SELECT id_ativo, arg_min(preco_mercado, data_referencia) AS preco_base FROM preco_dedup GROUP BY 1)")
_NUM = ("preco_unitario", "preco_mercado", "valor_financeiro", "percentual_pl")
_LONG = " UNION ALL ".join(f"SELECT '{c}' AS coluna, CAST({c} AS DECIMAL(24,6)) AS valor FROM flat" for c in _NUM)


def _q_at(p: str) -> str:
    return (f"(SELECT CAST(round(lo.valor + (hi.valor - lo.valor) * w.frac, 2) AS DECIMAL(38,2)) "
            f"FROM w JOIN rk lo ON lo.coluna = w.coluna AND lo.r = w.lo "
            f"JOIN rk hi ON hi.coluna = w.coluna AND hi.r = w.hi WHERE w.coluna = m.coluna AND w.p = {p})")


_q("q18_describe", f"""
SELECT m.coluna, m."count", {rr('m.s', 'm."count"', 2, num_scale=6, den_scale=0)} AS mean,
       CAST(round(m.sd, 2) AS DECIMAL(38,2)) AS std, CAST(round(m.mn, 2) AS DECIMAL(38,2)) AS "min",
       {_q_at('0.25')} AS p25, {_q_at('0.5')} AS p50, {_q_at('0.75')} AS p75,
       CAST(round(m.mx, 2) AS DECIMAL(38,2)) AS "max"
FROM m""", f"""
lv AS (SELECT * FROM ({_LONG}) WHERE valor IS NOT NULL),
m AS (SELECT coluna, count(*) AS "count", sum(valor) AS s, stddev_samp(CAST(valor AS DOUBLE)) AS sd,
             min(valor) AS mn, max(valor) AS mx FROM lv GROUP BY 1),
rk AS (SELECT coluna, valor, row_number() OVER (PARTITION BY coluna ORDER BY valor) - 1 AS r FROM lv),
w AS (SELECT m.coluna, v.p, floor((m."count" - 1) * v.p) AS lo, ceil((m."count" - 1) * v.p) AS hi,
             (m."count" - 1) * v.p - floor((m."count" - 1) * v.p) AS frac
      FROM m CROSS JOIN (SELECT CAST(x AS DECIMAL(10,8)) AS p FROM (VALUES (0.25), (0.5), (0.75)) t(x)) v)""")
_q("a07_null_profile", "SELECT coluna, n_nulos FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS coluna, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_nulos FROM flat"
    for c in FLAT_COLS) + ") WHERE n_nulos > 0")
_TEXT_NUM = {"quantidade": "18,6", "preco_unitario": "18,6", "preco_mercado": "18,6",
             "valor_financeiro": "18,2", "percentual_pl": "9,6"}


def _typed_text_col(c: str) -> str:
    if c == "data_posicao":
        return f"TRY_CAST(data_posicao AS DATE) AS data_posicao"
    if c in _TEXT_NUM:
        return f"TRY_CAST({c} AS DECIMAL({_TEXT_NUM[c]})) AS {c}"
    return c


_q("q19_typed_from_text", "SELECT " + ", ".join(_typed_text_col(c) for c in FLAT_COLS) + " FROM rt",
   f"rt AS ({FLAT_RENDER})")
_q("f06_parse_numbers", " UNION ALL ".join(
    f"SELECT '{c}' AS coluna, CAST(count(*) FILTER (WHERE TRY_CAST({c} AS DECIMAL({t})) IS NULL) AS BIGINT) AS n_nulos "
    f"FROM rt" for c, t in _TEXT_NUM.items()), f"rt AS ({FLAT_RENDER})")
_q("f07_fund_short_names", f"SELECT nome_fundo, {SHORT_FUND.format(c='nome_fundo')} AS fundo_curto FROM fundo")
_q("f08_issuer_short_names", f"""
SELECT nome_emissor, {SHORT_ISSUER.format(c='nome_emissor')} AS emissor_curto,
       substring({SHORT_ISSUER.format(c='nome_emissor')}, 1, 14) AS rotulo FROM emissor""")
_q("f15_rating_buckets", f"""
SELECT {BUCKET.format(c='rating_emissor')} AS faixa_rating, count(DISTINCT nome_emissor) AS n_emissores,
       {MONEY_SUM} AS valor_total FROM flat GROUP BY 1""")
_q("p07_dropna", f"SELECT {TYPED} FROM flat WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in FLAT_COLS))
_q("p09_distinct_dates", "SELECT DISTINCT data_posicao FROM flat")
_STEPS = [
    ["data_posicao", "id_fundo", "id_ativo", "quantidade", "valor_financeiro", "percentual_pl"],
    ["cnpj_fundo", "nome_fundo", "tipo_fundo"],
    ["codigo_ativo", "nome_ativo", "classe_ativo", "indexador", "data_vencimento"],
    ["nome_emissor", "cnpj_emissor", "setor_emissor", "rating_emissor"],
    ["preco_mercado", "fonte_preco"],
]
for _i, _name in enumerate(["j01_position_fund", "j02_position_asset", "j03_position_issuer",
                            "j04_position_price"], start=1):
    _q(_name, "SELECT " + ", ".join(c for step in _STEPS[: _i + 1] for c in step) + " FROM flat")
_FKS = (("ativo", "id_emissor", "emissor", "id_emissor"),
        ("posicao_carteira", "id_fundo", "fundo", "id_fundo"),
        ("posicao_carteira", "id_ativo", "ativo", "id_ativo"),
        ("operacao", "id_fundo", "fundo", "id_fundo"),
        ("operacao", "id_ativo", "ativo", "id_ativo"),
        ("preco_mercado", "id_ativo", "ativo", "id_ativo"))
_CTE_OF = {"posicao_carteira": "posicao", "preco_mercado": "preco", "ativo": "ativo", "fundo": "fundo",
           "emissor": "emissor", "operacao": "operacao"}


def _orphans(c: str, col: str, p: str, pcol: str) -> str:
    return (f"(SELECT count(*) FROM {_CTE_OF[c]} x WHERE x.{col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {_CTE_OF[p]} y WHERE y.{pcol} = x.{col}))")


_q("j06_orphan_keys", " UNION ALL ".join(
    f"SELECT '{c}.{col}->{p}.{pcol}' AS relacao, {_orphans(c, col, p, pcol)} AS n_orfaos" for c, col, p, pcol in _FKS))
_q("j08_inner_join_loss", """
SELECT count(*) AS n_posicoes, count(*) FILTER (WHERE NOT hit_fundo) AS sem_fundo,
       count(*) FILTER (WHERE NOT hit_ativo) AS sem_ativo, count(*) FILTER (WHERE NOT hit_emissor) AS sem_emissor,
       count(*) FILTER (WHERE NOT hit_preco) AS sem_preco,
       count(*) FILTER (WHERE NOT (hit_fundo AND hit_ativo AND hit_emissor AND hit_preco)) AS perdidas_inner
FROM flat""")


def _rule_row(regra: str, tabela: str, coluna: str, descricao: str, bad: str) -> str:
    return (f"SELECT '{regra}' AS regra, '{tabela}' AS tabela, '{coluna}' AS coluna, '{descricao}' AS descricao, "
            f"CAST(count(*) FILTER (WHERE {bad}) AS BIGINT) AS n_invalidos FROM {_CTE_OF[tabela]}")


def _rules_query(rows: list[str]) -> str:
    return "SELECT *, n_invalidos = 0 AS aprovado FROM (" + " UNION ALL ".join(rows) + ")"


_CRIT = ("data_posicao", "cnpj_fundo", "nome_fundo", "codigo_ativo", "quantidade", "valor_financeiro", "percentual_pl")
_q("v03_flat_output_checks", "SELECT *, n_invalidos = 0 AS aprovado FROM (" + " UNION ALL ".join(
    [f"SELECT 'V03' AS regra, 'carteira_flat' AS tabela, '{c}' AS coluna, 'critical not null' AS descricao, "
     f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS n_invalidos FROM rt" for c in _CRIT]
    + ["SELECT 'V04', 'carteira_flat', '*', 'not empty', CAST(CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS BIGINT) "
       "FROM rt"]) + ")", f"rt AS ({FLAT_RENDER})")

# Source-model rule metadata, restated (fixed values).
_NOT_NULL = {
    "fundo": ("id_fundo", "cnpj_fundo", "nome_fundo", "tipo_fundo", "data_inicio", "status"),
    "ativo": ("id_ativo", "codigo_ativo", "nome_ativo", "classe_ativo", "id_emissor"),
    "emissor": ("id_emissor", "nome_emissor", "cnpj_emissor"),
    "posicao_carteira": ("id_posicao", "data_posicao", "id_fundo", "id_ativo", "quantidade", "preco_unitario",
                         "valor_financeiro", "percentual_pl"),
    "preco_mercado": ("id_preco", "data_referencia", "id_ativo", "preco_mercado", "fonte_preco"),
    "operacao": ("id_operacao", "data_operacao", "id_fundo", "id_ativo", "tipo_operacao", "quantidade",
                 "preco_operacao", "valor_operacao"),
}
_q("v06_not_null", _rules_query([_rule_row("V06", t, c, "not null", f"{c} IS NULL")
                                 for t, cols in _NOT_NULL.items() for c in cols]))
_KEYS = {"emissor": ("cnpj_emissor",), "ativo": ("codigo_ativo",), "fundo": ("cnpj_fundo",),
         "posicao_carteira": ("data_posicao", "id_fundo", "id_ativo"),
         "preco_mercado": ("data_referencia", "id_ativo", "fonte_preco")}
_q("v07_unique_keys", _rules_query([
    f"SELECT 'V07' AS regra, '{t}' AS tabela, '{','.join(k)}' AS coluna, 'unique' AS descricao, "
    f"CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_invalidos FROM "
    f"(SELECT {', '.join(k)}, count(*) AS n FROM {_CTE_OF[t]} GROUP BY ALL HAVING count(*) > 1)"
    for t, k in _KEYS.items()]))
_q("v08_foreign_keys", _rules_query([
    f"SELECT 'V08' AS regra, '{c}' AS tabela, '{col}' AS coluna, 'references {p}.{pcol}' AS descricao, "
    f"CAST({_orphans(c, col, p, pcol)} AS BIGINT) AS n_invalidos" for c, col, p, pcol in _FKS]))
_q("v09_non_negative", _rules_query(
    [_rule_row("V09", "posicao_carteira", c, ">= 0", f"{c} < 0")
     for c in ("quantidade", "preco_unitario", "percentual_pl")]
    + [_rule_row("V09", "preco_mercado", "preco_mercado", ">= 0", "preco_mercado < 0")]))
_q("v10_positive_trades", _rules_query([_rule_row("V10", "operacao", c, "> 0", f"{c} <= 0")
                                        for c in ("quantidade", "preco_operacao")]))
_q("v11_fund_status", _rules_query([_rule_row(
    "V11", "fundo", "status", "in ATIVO,ENCERRADO,SUSPENSO,EM_LIQUIDACAO",
    "status NOT IN ('ATIVO', 'ENCERRADO', 'SUSPENSO', 'EM_LIQUIDACAO')")]))
_q("v12_trade_types", _rules_query([_rule_row(
    "V12", "operacao", "tipo_operacao", "in COMPRA,VENDA,AMORTIZACAO,VENCIMENTO,TRANSFERENCIA",
    "tipo_operacao NOT IN ('COMPRA', 'VENDA', 'AMORTIZACAO', 'VENCIMENTO', 'TRANSFERENCIA')")]))
_LEN = {"emissor": {"nome_emissor": 100, "cnpj_emissor": 20, "setor": 50, "rating": 10},
        "ativo": {"codigo_ativo": 20, "nome_ativo": 100, "classe_ativo": 50, "indexador": 30},
        "fundo": {"cnpj_fundo": 20, "nome_fundo": 100, "tipo_fundo": 50, "status": 20},
        "operacao": {"tipo_operacao": 20},
        "preco_mercado": {"fonte_preco": 50}}
_DEC = {"posicao_carteira": {"quantidade": "18,6", "preco_unitario": "18,6", "valor_financeiro": "18,2",
                             "percentual_pl": "9,6"},
        "operacao": {"quantidade": "18,6", "preco_operacao": "18,6", "valor_operacao": "18,2"},
        "preco_mercado": {"preco_mercado": "18,6"}}
_q("v13_limits", _rules_query(
    [_rule_row("V13", t, c, f"length <= {n}", f"length({c}) > {n}") for t, d in _LEN.items() for c, n in d.items()]
    + [_rule_row("V13", t, c, f"fits decimal({ps})", f"{c} IS NOT NULL AND TRY_CAST({c} AS DECIMAL({ps})) IS NULL")
       for t, d in _DEC.items() for c, ps in d.items()]))
_q("v14_percent_sums", """
SELECT data_posicao, id_fundo, sum(percentual_pl) AS soma_percentual, abs(sum(percentual_pl) - 100) <= 0.5 AS aprovado
FROM posicao GROUP BY 1, 2""")
_q("v15_consistency", _rules_query([_rule_row(
    "V15", "posicao_carteira", "valor_financeiro", "quantidade x preco_unitario within 0.01",
    f"abs({product('quantidade', 'preco_unitario')} - valor_financeiro) > 0.01")]))
_q("v16_rules_on_damaged_rows", """
SELECT regra, tabela, coluna, descricao, n AS n_invalidos, n = 0 AS aprovado FROM found""", """
funds AS (
  SELECT id_fundo, cnpj_fundo, CASE WHEN id_fundo % 11 = 5 THEN NULL ELSE nome_fundo END AS nome,
         CASE WHEN id_fundo % 7 = 3 THEN 'PAUSADO' ELSE status END AS estado
  FROM fundo),
damaged AS (SELECT * FROM funds UNION ALL SELECT * FROM funds WHERE id_fundo % 5 = 0),
found AS (
  SELECT 'V06' AS regra, 'fundo' AS tabela, 'nome_fundo' AS coluna, 'not null' AS descricao,
         count(*) FILTER (WHERE nome IS NULL) AS n FROM damaged
  UNION ALL SELECT 'V11', 'fundo', 'status', 'in ATIVO,ENCERRADO,SUSPENSO,EM_LIQUIDACAO',
         count(*) FILTER (WHERE estado = 'PAUSADO') FROM damaged
  UNION ALL SELECT 'V07', 'fundo', 'cnpj_fundo', 'unique', count(*) - count(DISTINCT cnpj_fundo) FROM damaged
  UNION ALL SELECT 'V13', 'emissor', 'nome_emissor', 'length <= 100', count(*) FROM emissor WHERE id_emissor % 13 = 1
  UNION ALL SELECT 'V09', 'posicao_carteira', 'quantidade', '>= 0', count(*) FROM posicao WHERE id_ativo % 23 = 7 AND quantidade > 0
  UNION ALL SELECT 'V09', 'preco_mercado', 'preco_mercado', '>= 0', count(*) FROM preco WHERE id_ativo % 31 = 1 AND preco_mercado > 0
  UNION ALL SELECT 'V10', 'operacao', 'quantidade', '> 0', count(*) FROM operacao WHERE id_ativo % 17 = 2 OR quantidade <= 0
  UNION ALL SELECT 'V12', 'operacao', 'tipo_operacao', 'in COMPRA,VENDA,AMORTIZACAO,VENCIMENTO,TRANSFERENCIA',
         count(*) FROM operacao WHERE id_ativo % 13 = 4)""")
_q("v15b_maturity", """
SELECT 'V15' AS regra, 'carteira_flat' AS tabela, 'data_vencimento' AS coluna, 'not before 2030-01-01' AS descricao,
       n AS n_invalidos, n = 0 AS aprovado
FROM (SELECT count(*) AS n FROM flat WHERE data_vencimento < DATE '2030-01-01')""")
_q("t01_trades_by_type", """
SELECT tipo_operacao, count(*) AS n_operacoes, CAST(sum(valor_operacao) AS DECIMAL(38,2)) AS valor_total
FROM operacao GROUP BY 1""")
_q("s11_insert_if_absent", """
SELECT data_referencia, id_ativo, fonte_preco, preco_mercado, id_fundo FROM b
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM preco p WHERE p.data_referencia = b.data_referencia
                             AND p.id_ativo = b.id_ativo AND p.fonte_preco = b.fonte_preco)""", """
b AS (SELECT data_posicao AS data_referencia, id_ativo, preco_unitario AS preco_mercado, 'ANBIMA' AS fonte_preco,
             id_fundo, row_number() OVER (PARTITION BY data_posicao, id_ativo ORDER BY id_fundo) AS rn
      FROM posicao)""")
_q("x03_flat_fixed_income", FLAT_RENDER + " WHERE classe_ativo = 'Renda Fixa'")
_q("x03b_flat_fund_dates_class", FLAT_RENDER + """ WHERE classe_ativo = 'Renda Fixa' AND nome_fundo = 'NATION_7 FIE'
  AND flat.data_posicao BETWEEN DATE '1994-01-01' AND DATE '1995-12-31'""")
_q("x03c_clustered_flat_asset", FLAT_RENDER + " WHERE codigo_ativo = 'P77'")
_q("x05_concentration_alerts", f"""
SELECT 'ativo' AS nivel, codigo_ativo AS nome, valor_total, pct_total FROM (
  SELECT codigo_ativo, valor_total, {share('valor_total', '(SELECT sum(valor_total) FROM ag)')} AS pct_total FROM ag)
WHERE pct_total > 1.0
UNION ALL
SELECT 'emissor', nome_emissor, valor_total, pct_total FROM isx WHERE pct_total > 1.0""", ISSUERS + f""",
ag AS (SELECT codigo_ativo, nome_ativo, classe_ativo, {MONEY_SUM} AS valor_total FROM flat GROUP BY 1, 2, 3)""")

_RISK = f"""
fpl AS (SELECT nome_fundo, data_posicao, {MONEY_SUM} AS pl FROM flat GROUP BY 1, 2),
rets AS (SELECT nome_fundo, data_posicao, pl, {rr('pl - prev', 'prev', 6, times=100)} AS retorno_pct
         FROM (SELECT *, lag(pl) OVER (PARTITION BY nome_fundo ORDER BY data_posicao) AS prev FROM fpl)),
recent AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY nome_fundo ORDER BY data_posicao DESC) AS k
                          FROM rets WHERE retorno_pct IS NOT NULL) WHERE k <= 252),
tpl AS (SELECT data_posicao, {MONEY_SUM} AS pl FROM flat GROUP BY 1),
tot AS (SELECT data_posicao, {rr('pl - prev', 'prev', 6, times=100)} AS retorno_total
        FROM (SELECT *, lag(pl) OVER (ORDER BY data_posicao) AS prev FROM tpl)),
mom AS (SELECT r.nome_fundo, count(*) AS n_retornos, max(r.data_posicao) AS data_final,
               CAST(round(corr(CAST(r.retorno_pct AS DOUBLE), CAST(t.retorno_total AS DOUBLE)), 4) AS DECIMAL(38,4))
                 AS correlacao_total,
               CAST(round(stddev_samp(CAST(r.retorno_pct - t.retorno_total AS DOUBLE)), 4) AS DECIMAL(38,4))
                 AS tracking_error_pct
        FROM recent r LEFT JOIN tot t ON r.data_posicao = t.data_posicao GROUP BY 1),
vq AS (SELECT nome_fundo, retorno_pct AS v,
              row_number() OVER (PARTITION BY nome_fundo ORDER BY retorno_pct) - 1 AS r,
              (count(*) OVER (PARTITION BY nome_fundo) - 1) * CAST(0.05 AS DECIMAL(10,8)) AS pos
       FROM recent),
var AS (SELECT nome_fundo, CAST(round(-(lo + (hi - lo) * frac), 4) AS DECIMAL(38,4)) AS var_pct FROM (
          SELECT nome_fundo, max(CASE WHEN r = floor(pos) THEN v END) AS lo,
                 max(CASE WHEN r = ceil(pos) THEN v END) AS hi, max(pos - floor(pos)) AS frac
          FROM vq GROUP BY 1)),
dd AS (SELECT nome_fundo, min({rr('pl - peak', 'peak', 4, times=100)}) AS max_drawdown_pct FROM (
         SELECT *, max(pl) OVER (PARTITION BY nome_fundo ORDER BY data_posicao
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS peak FROM fpl) GROUP BY 1)"""
_q("x04_fund_risk", """
SELECT m.nome_fundo, m.n_retornos, m.data_final, m.correlacao_total, m.tracking_error_pct, v.var_pct,
       d.max_drawdown_pct
FROM mom m LEFT JOIN var v ON m.nome_fundo = v.nome_fundo LEFT JOIN dd d ON m.nome_fundo = d.nome_fundo""", _RISK)


_q("f13_kpi_text", f"""
SELECT 'R$ ' || format('{{:,.2f}}', pl) AS pl_total_texto,
       'R$ ' || CAST({mi('pl', 1)} AS VARCHAR) || 'M' AS pl_total_mi_texto,
       format('{{:,}}', nf) AS n_fundos_texto, format('{{:,}}', na) AS n_ativos_texto,
       format('{{:,}}', ne) AS n_emissores_texto, format('{{:,}}', np) AS n_posicoes_texto,
       strftime(df, '%Y-%m-%d') AS data_referencia
FROM (SELECT {MONEY_SUM} AS pl, count(DISTINCT nome_fundo) AS nf, count(DISTINCT codigo_ativo) AS na,
             count(DISTINCT nome_emissor) AS ne, count(*) AS np, max(data_posicao) AS df FROM flat)""")
_q("a10_extremes_by_class", """
SELECT classe_ativo, min(valor_financeiro) AS valor_min, max(valor_financeiro) AS valor_max,
       max(percentual_pl) AS pct_pl_max, min(data_posicao) AS data_min, max(data_posicao) AS data_max
FROM flat GROUP BY classe_ativo""")
_q("o04_flat_head", "SELECT * FROM (" + FLAT_RENDER + ") ORDER BY data_posicao, cnpj_fundo, codigo_ativo LIMIT 10")
_q("p12_flat_shape", "SELECT count(*) AS n_linhas, 19 AS n_colunas FROM flat")
_q("a01_table_rows", " UNION ALL ".join(
    f"SELECT '{t}' AS tabela, count(*) AS n_linhas FROM {c}"
    for t, c in (("fundo", "fundo"), ("ativo", "ativo"), ("emissor", "emissor"), ("posicao_carteira", "posicao"),
                 ("preco_mercado", "preco"), ("operacao", "operacao"))))


def oracle_sql() -> dict[str, str]:
    return dict(QUERIES)
