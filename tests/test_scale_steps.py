"""Steps of the flat view that must not grow faster than the input, or move rows that they need not move."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundlens import schemas
from fundlens.functions.exact import sum_small
from fundlens.operators.dedup import first_per_key
from fundlens.operators.joins import hot_from_counts, hot_keys, left_enrich, left_lookup
from fundlens.plans.flat import flat_typed
from fundlens.sources.driver_tables import kept_star, star_from_driver

SMOKE = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def _logical(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_kept_star_has_the_rows_of_the_derived_star_and_reads_line_items_once(spark):
    derived, kept = star_from_driver(spark, SMOKE), kept_star(spark, SMOKE)
    assert _rows(kept.posicao) == _rows(derived.posicao)
    assert _rows(kept.preco) == _rows(derived.preco)
    plan = kept.posicao.join(kept.preco, "id_ativo")._jdf.queryExecution().executedPlan().toString()
    assert "/lineitem.parquet" not in plan and "/orders.parquet" not in plan


def test_positions_meet_prices_before_the_texts_of_the_dimensions(spark):
    lines = _logical(flat_typed(star_from_driver(spark, SMOKE))).splitlines()
    (at,) = [i for i, ln in enumerate(lines) if "Join LeftOuter" in ln and "_salt#" in ln and "data_posicao#" in ln]
    depth = lines[at].index("Join")
    below = []
    for ln in lines[at + 1:]:
        if len(ln) - len(ln.lstrip(" :+-")) <= depth:
            break
        below.append(ln)
    assert below and not any(c in "\n".join(below) for c in ("nome_fundo", "nome_ativo", "nome_emissor"))


def test_keys_of_light_buckets_are_not_counted_one_by_one(spark):
    fact = spark.range(20_000).select((F.col("id") % 10_000).alias("k")).repartition(4)
    hot = hot_keys(fact, ["k"], min_rows=100)
    assert hot.collect() == []
    assert "_bucket" in _logical(hot)
    skewed = fact.unionByName(spark.range(500).select(F.lit(7).cast("long").alias("k")))
    assert [tuple(r) for r in hot_keys(skewed, ["k"], min_rows=100).collect()] == [(7, 6)]


def test_hot_keys_hold_no_subquery(spark):
    counts = spark.createDataFrame([(1, 10), (2, 300)], "k int, n long")
    hot = hot_from_counts(counts, ["k"], "n", min_rows=100)
    assert "scalar-subquery" not in _logical(hot) and [tuple(r) for r in hot.collect()] == [(2, 3)]


def test_first_per_key_by_names_equals_by_columns(spark):
    df = spark.createDataFrame([(k % 5, (k * 7) % 3 if k % 4 else None, k, f"v{k}") for k in range(60)], "k int, p int, id int, v string")
    assert _rows(first_per_key(df, ["k"], ["p", "id"])) == _rows(first_per_key(df, ["k"], [F.col("p"), F.col("id")]))


def test_small_sums_equal_decimal_sums(spark):
    df = spark.sql("select id % 3 as k, cast((id - 40) * 1234567.891234 as decimal(18,6)) as x from range(100) "
                   "union all select 9, cast(null as decimal(18,6))")
    got = df.groupBy("k").agg(sum_small("x", schemas.QTY).alias("s"))
    assert _rows(got) == _rows(df.groupBy("k").agg(F.sum("x").cast(schemas.QTY).alias("s"))) and got.schema["s"].dataType == schemas.QTY


def test_quantiles_take_the_first_bucket_of_a_value_from_a_column(spark, monkeypatch):
    from fundlens.operators import quantiles
    seen = []
    distinct = quantiles._distinct
    monkeypatch.setattr(quantiles, "_distinct", lambda values, paths: seen.append(values.columns) or distinct(values, paths))
    got = quantiles.exact_quantiles(spark.sql("select cast(id as decimal(18,2)) as x from range(101)"), ["x"])
    assert [str(r["valor"].normalize()) for r in got.orderBy("p").collect()] == ["25", "5E+1", "75"]
    assert seen == [["x", "_bucket_x"]]


def test_positions_and_prices_that_lie_by_asset_are_shuffled_once(spark):
    star = kept_star(spark, SMOKE)
    want = _rows(flat_typed(star_from_driver(spark, SMOKE)))
    saved = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    for k in saved:
        spark.conf.set(k, "-1")
    try:
        flat = flat_typed(star, broadcast={"fundo": True, "emissor": True, "ativo": False})
        moved = [ln for ln in flat._jdf.queryExecution().executedPlan().toString().splitlines() if " Exchange " in ln]
        got = _rows(flat)
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # trades, quotes, and the asset table with the issuers of its assets
    assert len(moved) == 4 and not any("data_" in ln or "_dia" in ln for ln in moved)
    assert got == want


def test_a_hot_asset_keeps_the_shuffles_by_whole_keys(spark):
    star, hot = kept_star(spark, SMOKE), kept_star(spark, SMOKE, hot_min_rows=20)
    assert star.asset_rows and hot.asset_rows is None
    plan = flat_typed(hot, hot_min_rows=20)
    assert "_salt" in _logical(plan) and "_salt" not in _logical(flat_typed(star))
    # a lower bound than the one that was counted
    assert "_salt" in _logical(flat_typed(star, hot_min_rows=20))
    assert _rows(plan) == _rows(flat_typed(star))


def test_left_lookup_equals_the_left_join(spark):
    fact = spark.sql("select if(id % 9 = 0, null, id % 50) as a, if(id % 13 = 0, null, id % 7) as d, id as q from range(2000)")
    side = spark.sql("select if(id % 10 = 0, null, id % 60) as a, if(id = 5, null, id % 5) as d, concat('p', id) as p, "
                     "if(id % 3 = 0, null, 'x') as f from range(300)").dropDuplicates(["a", "d"])
    got = left_lookup(fact.repartition(7, "a"), side.repartition(7, "a"), ["a", "d"], flag="_hit")
    assert got.columns == left_enrich(fact, side, ["a", "d"], flag="_hit").columns
    assert _rows(got) == _rows(left_enrich(fact, side, ["a", "d"], flag="_hit"))
    assert _rows(left_lookup(fact, side.limit(0), ["a", "d"])) == _rows(left_enrich(fact, side.limit(0), ["a", "d"]))
