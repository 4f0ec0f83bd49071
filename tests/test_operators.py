"""Operators against brute force on random inputs and partitionings."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundlens.functions.exact import round_ratio
from fundlens.operators.dedup import first_per_key
from fundlens.operators.joins import hot_keys, salted_join
from fundlens.operators.ordered import ordered_scan, with_previous
from fundlens.operators.quantiles import exact_quantiles
from fundlens.sources.ingest import insert_if_absent, next_ids, with_surrogate_keys

DEC = T.DecimalType(18, 2)


def half_up(x: Decimal, scale: int) -> Decimal:
    return x.quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(-10**6, 10**6)), min_size=1, max_size=30),
       st.integers(0, 6), st.integers(1, 100))
def test_round_ratio_matches_decimal(spark, pairs, scale, times):
    rows = [(Decimal(a).scaleb(-2), Decimal(b).scaleb(-2)) for a, b in pairs]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("a", DEC), T.StructField("b", DEC)]))
    got = [r["r"] for r in df.select(round_ratio(F.col("a"), F.col("b"), scale, times=times).alias("r")).collect()]
    # exact quotient: enough precision that the HALF_UP step sees the true digits
    with localcontext() as ctx:
        ctx.prec = 80
        want = [None if b == 0 else half_up((Decimal(times) * a) / b, scale) for a, b in rows]
    assert got == want


def test_first_per_key_any_partitioning(spark):
    rnd = random.Random(7)
    rows = [(rnd.randint(0, 20), rnd.randint(0, 5), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, prio int, id int")
    want = {}
    for k, p, i in rows:
        if k not in want or (p, i) < want[k]:
            want[k] = (p, i)
    for n in (1, 4, 9):
        got = first_per_key(df.repartition(n), ["k"], [F.col("prio"), F.col("id")]).collect()
        assert {r["k"]: (r["prio"], r["id"]) for r in got} == want


@pytest.mark.parametrize("n_partitions", [1, 3, 8])
def test_ordered_scan_matches_global_window(spark, n_partitions):
    rnd = random.Random(n_partitions)
    # Heavy ties on the value: the key column keeps the order total.
    rows = [(f"k{i:04d}", Decimal(rnd.choice([5, 10, 10, 10, 20, 35])).scaleb(-1)) for i in range(400)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("key", T.StringType()),
                                                   T.StructField("v", T.DecimalType(10, 1))]))
    out = ordered_scan(df, [F.col("v").desc(), F.col("key")], sums={"acc": F.col("v")}, totals=True,
                       n_partitions=n_partitions).collect()
    ordered = sorted(rows, key=lambda r: (-r[1], r[0]))
    acc = Decimal(0)
    want = {}
    for pos, (k, v) in enumerate(ordered, start=1):
        acc += v
        want[k] = (pos, acc)
    assert {r["key"]: (r["posicao"], r["acc"]) for r in out} == want
    assert {r["total_acc"] for r in out} == {acc}


@pytest.mark.parametrize("n_partitions", [1, 4, 8])
def test_ordered_scan_positions_single_shuffle(spark, n_partitions):
    rnd = random.Random(100 + n_partitions)
    rows = [(f"k{i:04d}", Decimal(rnd.choice([1, 2, 2, 7, 9])).scaleb(-1)) for i in range(500)]
    df = spark.createDataFrame(rows, "key string, v decimal(10,1)").repartition(5)
    scanned = ordered_scan(df, [F.col("v").desc(), F.col("key")], n_partitions=n_partitions)
    ordered = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert {r["key"]: r["posicao"] for r in scanned.collect()} == {k: i for i, (k, _) in enumerate(ordered, 1)}
    final = scanned._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # The rows were range-partitioned and numbered once, when they were written: no exchange or
    # row-number window touches them again, whatever the optimizer does about reuse.
    assert "rangepartitioning" not in final and "row_number()" not in final


@pytest.mark.parametrize("reuse", ["true", "false"])
@pytest.mark.parametrize("n_partitions", [2, 4, 8])
def test_global_order_of_many_wide_rows(spark, n_partitions, reuse):
    """Far more rows than a range partitioner's sample, with columns that pruning drops from the counts."""
    wide = spark.range(100_000).select(
        (F.xxhash64("id") % 997).alias("v"), F.col("id").cast("string").alias("key"), F.repeat(F.lit("x"), 40).alias("pad"),
        (F.col("id") % 13).cast("decimal(18,2)").alias("w"))
    saved = spark.conf.get("spark.sql.exchange.reuse", "true")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        order = [F.col("v").desc(), F.col("key")]
        out = ordered_scan(wide, order, sums={"acc": F.col("w")}, totals=True, n_partitions=n_partitions)
        got = out.agg(F.countDistinct("posicao").alias("d"), F.min("posicao").alias("a"), F.max("posicao").alias("b"),
                      F.max("acc").alias("acc"), F.max("total_acc").alias("t"), F.sum("w").alias("w")).first()
        assert (got["d"], got["a"], got["b"]) == (100_000, 1, 100_000) and got["acc"] == got["t"] == got["w"]
        from pyspark.sql import Window
        real = F.row_number().over(Window.orderBy(*order))
        assert out.withColumn("real", real).filter("real <> posicao").count() == 0
    finally:
        spark.conf.set("spark.sql.exchange.reuse", saved)


@pytest.mark.parametrize("n_partitions", [1, 3, 8])
def test_with_previous_is_global_lag(spark, n_partitions):
    rnd = random.Random(7 * n_partitions)
    days = sorted(rnd.sample(range(20000), 300))
    rows = [(d, Decimal(rnd.randint(1, 10**6)).scaleb(-2)) for d in days]
    df = spark.createDataFrame(rnd.sample(rows, len(rows)), "d int, pl decimal(18,2)").repartition(4)
    out = with_previous(df, [F.col("d")], ["pl"], n_partitions=n_partitions).collect()
    want = {d: (rows[i - 1][1] if i else None) for i, (d, _) in enumerate(rows)}
    assert len(out) == len(rows) and {r["d"]: r["prev_pl"] for r in out} == want


def _skewed_fact(spark, n=3000):
    rnd = random.Random(11)
    # key 7 holds a third of the rows, NULL keys a sixth
    rows = [(7 if i % 3 == 0 else None if i % 6 == 1 else rnd.randint(0, 60), i, rnd.randint(0, 10**6))
            for i in range(n)]
    return spark.createDataFrame(rows, "k int, id int, v int").repartition(6)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    fact = _skewed_fact(spark)
    # keys 51..60 have no partner; key 3 has two (multiplicity must be kept)
    side = spark.createDataFrame([(k, f"s{k}") for k in range(51)] + [(3, "s3-bis")], "k int, w string")
    want = fact.join(side, ["k"], how)
    got = salted_join(fact, side, ["k"], how, min_rows=50, max_keys=20).select(*want.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_hot_keys_are_bounded_and_sized(spark):
    fact = _skewed_fact(spark)
    # threshold = max(50, 3000 / 20) = 150 rows: key 7 (1000 rows) is hot, in ceil(1000 / 150) = 7 pieces,
    # and so is the NULL key (500 rows, 4 pieces)
    hot = {tuple(r) for r in hot_keys(fact, ["k"], min_rows=50, max_keys=20).collect()}
    assert hot == {(7, 7), (None, 4)}
    assert hot_keys(fact, ["k"], min_rows=5000, max_keys=20).count() == 0


def test_salted_join_spreads_a_hot_key_over_tasks(spark):
    fact = _skewed_fact(spark)
    side = spark.createDataFrame([(k, f"s{k}") for k in range(61)], "k int, w string")
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.coalescePartitions.enabled")
    saved = {k: spark.conf.get(k, None) for k in keys}
    for k, v in zip(keys, ("-1", "-1", "false")):
        spark.conf.set(k, v)
    try:
        out = salted_join(fact, side, ["k"], "left", min_rows=50, max_keys=20) \
            .withColumn("_task", F.spark_partition_id())
        tasks = out.filter(F.col("k") == 7).select("_task").distinct().count()
        null_tasks = out.filter(F.col("k").isNull()).select("_task").distinct().count()
        plain = fact.join(side, ["k"], "left").withColumn("_task", F.spark_partition_id())
        plain_tasks = plain.filter(F.col("k") == 7).select("_task").distinct().count()
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert plain_tasks == 1 and tasks > 1 and null_tasks > 1


def linear_quantile(values, p):
    s = sorted(values)
    pos = (Decimal(len(s) - 1) * Decimal(str(p)))
    lo = int(pos)
    hi = min(lo + 1, len(s) - 1) if pos != lo else lo
    return s[lo] + (s[hi] - s[lo]) * (pos - lo)


@pytest.mark.parametrize("n", [1, 2, 7, 101])
def test_exact_quantiles_match_linear_interpolation(spark, n):
    rnd = random.Random(n)
    rows = [(i, Decimal(rnd.choice([1, 1, 1, 2, 50, 999, 12345])).scaleb(-2) if i % 3 else
             Decimal(rnd.randint(0, 10**6)).scaleb(-2)) for i in range(n)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("id", T.IntegerType()),
                                                   T.StructField("x", T.DecimalType(18, 2))]))
    got = {r["p"]: r["valor"] for r in exact_quantiles(df, ["x"], (0.1, 0.25, 0.5, 0.75, 1.0), small=3).collect()}
    values = [v for _, v in rows]
    for p in (0.1, 0.25, 0.5, 0.75, 1.0):
        assert got[p] == linear_quantile(values, p)


def test_surrogate_keys_dense_and_unique(spark):
    df = spark.range(0, 1000, numPartitions=7).select(F.col("id").alias("x"))
    out = with_surrogate_keys(df, "sk", start=100).collect()
    assert sorted(r["sk"] for r in out) == list(range(101, 1101))


def test_next_ids_continue_after_the_target(spark):
    target = spark.createDataFrame([(7, "a"), (41, "b")], "id long, v string")
    got = sorted(r["id"] for r in next_ids(spark.range(0, 20, numPartitions=3).select(F.col("id").alias("x")), target, "id").collect())
    assert got == list(range(42, 62))
    first = next_ids(spark.range(3).select(F.col("id").alias("x")), target.limit(0), "id").collect()
    assert sorted(r["id"] for r in first) == [1, 2, 3]


def test_insert_if_absent_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "x"), (3, "c"), (3, "d"), (4, "e")], "k int, v string")
    new = insert_if_absent(batch, target, ["k"], order=[F.col("v")])
    assert sorted((r["k"], r["v"]) for r in new.collect()) == [(3, "c"), (4, "e")]
    merged = target.unionByName(new)
    again = insert_if_absent(batch, merged, ["k"], order=[F.col("v")])
    assert again.count() == 0


@pytest.mark.parametrize("n_days", [30, 7, 1])
def test_business_day_spine_matches_calendar(spark, n_days):
    from datetime import date, timedelta

    from fundlens.functions.dates import business_day_spine

    ends = [(1, date(2024, 5, 31)), (2, date(2024, 6, 2)), (3, date(2024, 6, 1)), (4, date(2024, 1, 3))]
    df = spark.createDataFrame(ends, "k int, fim date")
    got = {}
    for r in business_day_spine(df, "fim", n_days).collect():
        got.setdefault(r["k"], []).append(r["data"])
    for k, end in ends:
        days, d = [], end
        while len(days) < n_days:
            if d.weekday() < 5:
                days.append(d)
            d -= timedelta(days=1)
        assert sorted(got[k]) == sorted(days)


def test_approx_describe_close_to_exact(spark, seed):
    from fundlens.plans.flat import flat_typed
    from fundlens.plans.profile import describe_flat

    flat = flat_typed(seed)
    exact = {r["coluna"]: r for r in describe_flat(flat).collect()}
    approx = {r["coluna"]: r for r in describe_flat(flat, approx=True).collect()}
    for c, r in exact.items():
        assert approx[c]["count"] == r["count"] and approx[c]["mean"] == r["mean"]
        assert approx[c]["min"] <= approx[c]["p50"] <= approx[c]["max"]


def test_broadcast_guard_checks_rows_and_bytes(spark):
    from fundlens.operators.joins import broadcast_if_bounded

    small = spark.range(10).withColumnRenamed("id", "k")
    fact = spark.range(1000).select((F.col("id") % 10).alias("k"))

    def plan(dim):
        return fact.join(dim, "k", "left")._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan(broadcast_if_bounded(small, max_rows=10))
    # Over either bound the guard returns the dimension unhinted: the planner and AQE decide.
    assert broadcast_if_bounded(small, max_rows=9) is small
    assert broadcast_if_bounded(small, max_rows=10, max_bytes=100) is small
