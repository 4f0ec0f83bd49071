"""The fund star schema derived from the driver's TPC-H-like tables.

Mapping (one rule per table; every derived table grows with the input):

- ``fundo``            nation x region: one fund per nation, type = region name
- ``emissor``          supplier, every one
- ``ativo``            part; class from size, issuer = lowest supplier that shipped it; of issuers
                       whose key ends in 3 the asset carries an id that exists nowhere (issuer misses)
- ``posicao_carteira`` the day's trades of a fund (customer nation) in an asset (part)
- ``preco_mercado``    line items per order date and part (per ship date for every 20th part, so most
                       positions find a price and some miss); source from the status flags
- ``operacao``         one trade per line item, dated by its order
- second price stream  ``events``: (day, user) as (date, asset), event type as source

All arithmetic is decimal and exact (``round_ratio``), so the same tables
come out of any plan, partitioning or engine.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens import schemas
from fundlens.functions.exact import round_ratio, sum_small
from fundlens.model import Star
from fundlens.operators.joins import DEFAULT_HOT_MIN_ROWS, fits_broadcast, hot_from_counts, hot_keys, salted_join
from fundlens.session import written

# Adapter rules (fixed values): fund-name suffix by nation key % 4, indexer by
# part key % 4, price source by (return flag, line status).
FUND_SUFFIXES = (" FI", " FIM", " FIA", " FIE")
INDEXERS = ("CDI", "IPCA", "SELIC", "Prefixado")
SOURCE_BY_FLAGS = {"AF": "ANBIMA", "AO": "B3", "NF": "CETIP", "NO": "BLOOMBERG", "RF": "BACEN"}
OTHER_SOURCE = "OUTRA"
FIXED_INCOME = "Renda Fixa"
EQUITY = "Renda Variavel"
MATURITY_BASE = "2025-01-01"
FUND_START = "2000-01-01"

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values: tuple[str, ...], key) -> F.Column:
    out = F.lit(values[-1])
    for i in range(len(values) - 2, -1, -1):
        out = F.when(key % len(values) == i, F.lit(values[i])).otherwise(out)
    return out


def fundo(nation: DataFrame, region: DataFrame) -> DataFrame:
    # region has five rows at every scale: a broadcast of known, constant size.
    j = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
    return j.select(
        F.col("n_nationkey").cast("long").alias("id_fundo"),
        F.concat(F.lit("F"), F.col("n_nationkey").cast("string")).alias("cnpj_fundo"),
        F.concat(F.col("n_name"), _pick(FUND_SUFFIXES, F.col("n_nationkey"))).alias("nome_fundo"),
        F.col("r_name").alias("tipo_fundo"),
        F.lit(FUND_START).cast("date").alias("data_inicio"),
        F.lit("ATIVO").alias("status"),
    )


def emissor(supplier: DataFrame) -> DataFrame:
    bal = F.col("s_acctbal")
    return supplier.select(
        F.col("s_suppkey").cast("long").alias("id_emissor"),
        F.col("s_name").alias("nome_emissor"),
        F.concat(F.lit("E"), F.col("s_suppkey").cast("string")).alias("cnpj_emissor"),
        F.when(F.col("s_nationkey") % 5 != 0,
               F.concat(F.lit("SETOR_"), (F.col("s_nationkey") % 5).cast("string"))).alias("setor"),
        F.when(bal < 0, F.lit(None).cast("string")).when(bal < 2500, "BBB+").when(bal < 5000, "A+")
         .when(bal < 7500, "AA-").otherwise("AAA").alias("rating"),
    )


def ativo(part: DataFrame, lineitem: DataFrame) -> DataFrame:
    issuer = lineitem.groupBy("l_partkey").agg(F.min("l_suppkey").alias("_sup"))
    j = part.join(issuer, part.p_partkey == issuer.l_partkey, "left")
    key, size = F.col("p_partkey"), F.col("p_size")
    fixed = size >= 10
    return j.select(
        key.cast("long").alias("id_ativo"),
        F.concat(F.lit("P"), key.cast("string")).alias("codigo_ativo"),
        F.col("p_name").alias("nome_ativo"),
        F.when(fixed, F.lit(FIXED_INCOME)).otherwise(F.lit(EQUITY)).alias("classe_ativo"),
        F.when(fixed & (key % 5 != 0), _pick(INDEXERS, key)).alias("indexador"),
        F.when(fixed, F.date_add(F.lit(MATURITY_BASE).cast("date"), (key % 3650).cast("int")))
         .alias("data_vencimento"),
        F.when(F.col("_sup") % 10 == 3, -F.col("_sup")).otherwise(F.col("_sup")).cast("long").alias("id_emissor"),
    )


def _order_nation(orders: DataFrame, customer: DataFrame) -> DataFrame:
    oc = orders.select("o_orderkey", "o_custkey", "o_orderdate").join(
        customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    return oc.select("o_orderkey", F.to_date("o_orderdate").alias("_date"), "c_nationkey")


def fund_day_totals(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """``(data_posicao, id_fundo, _pl, _n)``: a fund's traded value and line count per
    day, from the line items. They are summed per order first (combined map-side),
    so only order-sized rows meet orders and customer; the exact decimal total
    equals the sum of the fund's positions that day, and the line count bounds the
    number of its positions."""
    per_order = lineitem.groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice").cast(schemas.MONEY)).alias("_v"), F.count(F.lit(1)).alias("_c"))
    j = per_order.join(_order_nation(orders, customer), F.col("l_orderkey") == F.col("o_orderkey"))
    return j.groupBy(F.col("_date").alias("data_posicao"),
                     F.col("c_nationkey").cast("long").alias("id_fundo")).agg(
        F.sum("_v").alias("_pl"), F.sum("_c").alias("_n"))


def posicao(trades: DataFrame, totals: DataFrame | None = None,
            hot_min_rows: int = DEFAULT_HOT_MIN_ROWS, totals_kept: bool = False) -> DataFrame:
    """Daily positions: the day's trades of a fund in an asset, summed.

    ``totals`` (``data_posicao, id_fundo, _pl, _n``) gives the fund's PL per day, and
    an upper bound ``_n`` of its positions that day, when they can be computed more
    cheaply than from ``trades`` (see ``fund_day_totals``); by default both are
    aggregated from the summed positions. A (day, fund) holding a third of the
    positions is salted over several join tasks (``salted_join``). ``totals_kept`` says
    that ``totals`` is a written table: its rows, days times funds, are counted, and under the
    bound of ``fits_broadcast`` it is broadcast, so the positions are not shuffled for it.
    """
    grouped = trades.groupBy("data_operacao", "id_fundo", "id_ativo").agg(
        sum_small("quantidade", schemas.QTY).alias("quantidade"),
        sum_small("valor_operacao", schemas.MONEY).alias("valor_financeiro"),
    ).withColumnRenamed("data_operacao", "data_posicao")
    # Fund total per day by aggregate + join (not a window): a hot (day, fund) is
    # combined map-side, and its rows are salted over several join tasks.
    pl = totals if totals is not None else grouped.groupBy("data_posicao", "id_fundo").agg(
        F.sum("valor_financeiro").alias("_pl"), F.count(F.lit(1)).alias("_n"))
    day_fund = ["data_posicao", "id_fundo"]
    side = pl.drop("_n")
    if totals_kept and fits_broadcast(side, name="day totals"):
        joined = grouped.join(F.broadcast(side), day_fund)
    else:
        joined = salted_join(grouped, side, day_fund, "inner", hot=hot_from_counts(pl, day_fund, "_n", hot_min_rows))
    return joined.select(
        F.xxhash64("data_posicao", "id_fundo", "id_ativo").alias("id_posicao"),
        "data_posicao", "id_fundo", "id_ativo", "quantidade",
        round_ratio(F.col("valor_financeiro"), F.col("quantidade"), 6).cast(schemas.PRICE).alias("preco_unitario"),
        "valor_financeiro",
        round_ratio(F.col("valor_financeiro"), F.col("_pl"), 6, times=100).cast(schemas.PCT).alias("percentual_pl"),
    )


def _source(flag: F.Column, status: F.Column) -> F.Column:
    code = F.concat(flag, status)
    out = F.lit(OTHER_SOURCE)
    for k, v in reversed(list(SOURCE_BY_FLAGS.items())):
        out = F.when(code == k, F.lit(v)).otherwise(out)
    return out


def preco_mercado(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    dated = lineitem.select("l_orderkey", "l_partkey", "l_returnflag", "l_linestatus", "l_extendedprice", "l_shipdate").join(
        orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return _best_quotes(dated.select(
        F.to_date(F.when(F.col("l_partkey") % 20 == 7, F.col("l_shipdate")).otherwise(F.col("o_orderdate"))).alias("_dia"),
        F.col("l_partkey").cast("long").alias("_ativo"),
        _source(F.col("l_returnflag"), F.col("l_linestatus")).alias("_fonte"),
        F.col("l_extendedprice").cast(schemas.MONEY).alias("_preco")))


def _best_quotes(quotes: DataFrame) -> DataFrame:
    """One quote per (date, asset, source), the highest."""
    g = quotes.groupBy(F.col("_dia").alias("data_referencia"), F.col("_ativo").alias("id_ativo"),
                       F.col("_fonte").alias("fonte_preco")).agg(F.max("_preco").cast(schemas.PRICE).alias("preco_mercado"))
    return g.select(F.xxhash64("data_referencia", "id_ativo", "fonte_preco").alias("id_preco"),
                    "data_referencia", "id_ativo", "preco_mercado", "fonte_preco")


def preco_eventos(events: DataFrame) -> DataFrame:
    """Second price stream: many rows per (date, asset), unknown sources only."""
    return events.select(
        F.col("event_id").cast("long").alias("id_preco"),
        F.to_date("ts").alias("data_referencia"),
        F.col("user_id").cast("long").alias("id_ativo"),
        F.col("value").cast(schemas.PRICE).alias("preco_mercado"),
        F.col("event_type").alias("fonte_preco"),
    )


def operacao(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                         "l_extendedprice", "l_returnflag")
    j = li.join(_order_nation(orders, customer), F.col("l_orderkey") == F.col("o_orderkey"))
    qty = F.col("l_quantity").cast(schemas.QTY)
    val = F.col("l_extendedprice").cast(schemas.MONEY)
    return j.select(
        F.xxhash64("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id_operacao"),
        F.col("_date").alias("data_operacao"),
        F.col("c_nationkey").cast("long").alias("id_fundo"),
        F.col("l_partkey").cast("long").alias("id_ativo"),
        F.when(F.col("l_returnflag") == "R", F.lit("VENDA")).otherwise(F.lit("COMPRA")).alias("tipo_operacao"),
        qty.alias("quantidade"),
        round_ratio(val, qty, 6).cast(schemas.PRICE).alias("preco_operacao"),
        val.alias("valor_operacao"),
    )


def star_from_driver(spark: SparkSession, sf_dir: str) -> Star:
    """Lazy star schema over ``sf_dir`` (no job runs here)."""
    t = {n: read_driver(spark, sf_dir, n) for n in DRIVER_TABLES}
    trades = schemas.conform(operacao(t["lineitem"], t["orders"], t["customer"]), schemas.OPERACAO)
    return Star(
        fundo=schemas.conform(fundo(t["nation"], t["region"]), schemas.FUNDO),
        ativo=schemas.conform(ativo(t["part"], t["lineitem"]), schemas.ATIVO),
        emissor=schemas.conform(emissor(t["supplier"]), schemas.EMISSOR),
        posicao=schemas.conform(posicao(trades, fund_day_totals(t["lineitem"], t["orders"], t["customer"])),
                                schemas.POSICAO),
        preco=schemas.conform(preco_mercado(t["lineitem"], t["orders"]), schemas.PRECO),
        operacao=trades,
        positions_from_trades=True,
    )


def kept_star(spark: SparkSession, sf_dir: str, hot_min_rows: int = DEFAULT_HOT_MIN_ROWS) -> Star:
    """:func:`star_from_driver` for plans on positions and prices: the line items meet their orders and customers
    once, when this is called, and are written with the few columns that positions, prices and the totals of
    the days are made of. The plans read that table instead of joining again for each of them.

    As long as no asset holds more than ``hot_min_rows`` lines (counted, see ``hot_keys``), trades and quotes are shuffled
    by asset and aggregated where they land: the price and the asset join need no further shuffle of positions
    or prices. With a hot asset they are combined map-side and shuffled by their whole keys, whose hot ones the joins split."""
    t = {n: read_driver(spark, sf_dir, n) for n in DRIVER_TABLES}
    star = star_from_driver(spark, sf_dir)
    key = F.col("l_partkey")
    lines = t["lineitem"].select(
        "l_orderkey", key.cast("long").alias("id_ativo"), "l_quantity", "l_extendedprice",
        F.when(key % 20 == 7, F.to_date("l_shipdate")).alias("_ship"), (key % 20 == 7).alias("_by_ship"),
        _source(F.col("l_returnflag"), F.col("l_linestatus")).alias("fonte_preco"))
    nation = t["customer"].select(F.col("c_custkey"), F.col("c_nationkey").cast("long").alias("id_fundo"), F.lit(True).alias("_known"))
    # Trades need the order's customer, quotes do not.
    orders = t["orders"].select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("_date")).join(
        nation, F.col("o_custkey") == F.col("c_custkey"), "left").drop("o_custkey", "c_custkey")
    lines = written(lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("l_orderkey", "o_orderkey"), "lines")
    trades = lines.filter("_known").select(
        F.col("_date").alias("data_operacao"), "id_fundo", "id_ativo", F.col("l_quantity").cast(schemas.QTY).alias("quantidade"),
        F.col("l_extendedprice").cast(schemas.MONEY).alias("valor_operacao"))
    totals = written(trades.groupBy(F.col("data_operacao").alias("data_posicao"), "id_fundo").agg(
        F.sum("valor_operacao").alias("_pl"), F.count(F.lit(1)).alias("_n")), "day-totals")
    quotes = lines.select(
        F.when(F.col("_by_ship"), F.col("_ship")).otherwise(F.col("_date")).alias("_dia"), F.col("id_ativo").alias("_ativo"),
        F.col("fonte_preco").alias("_fonte"), F.col("l_extendedprice").cast(schemas.MONEY).alias("_preco"))
    keys = trades.select(F.col("data_operacao").alias("data_posicao"), "id_ativo")
    placed = hot_keys(lines, ["id_ativo"], hot_min_rows).isEmpty()
    if placed:
        trades, quotes = trades.repartition("id_ativo"), quotes.repartition("_ativo")
    return replace(
        star, posicao=schemas.conform(posicao(trades, totals, totals_kept=True), schemas.POSICAO),
        preco=schemas.conform(_best_quotes(quotes), schemas.PRECO), position_keys=keys,
        asset_rows=hot_min_rows if placed else None)


def event_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schemas.conform(preco_eventos(read_driver(spark, sf_dir, "events")), schemas.PRECO)


def stage_star(star: Star, out_dir: str, mode: str = "overwrite", partition_by_date: bool = False) -> Star:
    """Write the star to Parquet under ``out_dir`` and return it re-read from there.

    Cuts the lineage of the derived tables (one evaluation each), and is the
    restart point if executors are lost later. Trades are written first; when
    positions are their daily sums (``positions_from_trades``) they are
    aggregated from the written trades, so the three-way join behind both runs
    once. ``partition_by_date`` writes positions and prices in
    one folder per date (partition pruning for ``as_of`` and date windows; use it
    for daily snapshots at scale). ``out_dir`` must be shared storage on a
    cluster (see ``fundlens.session.scratch_dir``).
    """
    spark = star.fundo.sparkSession
    root = out_dir.rstrip("/")

    def write(name: str, df: DataFrame, date_col: str | None = None) -> DataFrame:
        w = df.sortWithinPartitions(date_col).write.mode(mode) if date_col else df.write.mode(mode)
        if date_col and partition_by_date and name != "operacao":
            w = w.partitionBy(date_col)
        w.parquet(f"{root}/{name}")
        return schemas.conform(spark.read.parquet(f"{root}/{name}"), schemas.TABLES[name])

    out = {"fundo": write("fundo", star.fundo), "ativo": write("ativo", star.ativo),
           "emissor": write("emissor", star.emissor)}
    positions = star.posicao
    if star.operacao is not None:
        out["operacao"] = write("operacao", star.operacao, "data_operacao")
        if star.positions_from_trades:
            positions = schemas.conform(posicao(out["operacao"]), schemas.POSICAO)
    out["posicao_carteira"] = write("posicao_carteira", positions, "data_posicao")
    out["preco_mercado"] = write("preco_mercado", star.preco, "data_referencia")
    return Star(fundo=out["fundo"], ativo=out["ativo"], emissor=out["emissor"],
                posicao=out["posicao_carteira"], preco=out["preco_mercado"], operacao=out.get("operacao"))
