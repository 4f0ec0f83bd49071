"""Loads that are split, repeated, late or skewed: kept winners, idempotent inserts, balanced JDBC, sketches, quantiles."""

from __future__ import annotations

import random
import uuid
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from fundlens import schemas
from fundlens.job import JobConfig, run
from fundlens.operators.quantiles import describe, exact_quantiles
from fundlens.plans import exposure
from fundlens.plans.flat import carteira_flat, flat_typed
from fundlens.plans.prices import merge_prices, prices_by_priority
from fundlens.sources.driver_tables import star_from_driver
from fundlens.sources.files import read_flat_csv, read_newest_flat_csv
from fundlens.sources.ingest import insert_once, target_of
from fundlens.sources.jdbc import JdbcSource
from fundlens.sources.versions import ConflictError, VersionedTable
from test_sources_job import DERBY, write_star

SMOKE = "/root/testdata/sf0.001"
PRICE = ["data_referencia", "id_ativo", "fonte_preco"]


def _sorted(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


# Kept winners


@pytest.mark.parametrize("seed_no", [1, 2])
def test_kept_winners_equal_the_whole_history_after_any_split(spark, tmp_dir, seed_no):
    rnd = random.Random(seed_no)
    sources = ["ANBIMA", "B3", "CETIP", "BLOOMBERG", "BACEN", "X", "Y"]
    rows = [(i, date(2024, 5, rnd.randint(1, 4)), rnd.randint(1, 6), D(rnd.randint(1, 99)), rnd.choice(sources), None)
            for i in range(300)]
    table = VersionedTable(spark, f"{tmp_dir}/w", ("data_referencia",), ("id_ativo",))
    cuts = sorted(rnd.sample(range(300), 3))
    for a, b in zip([0, *cuts], [*cuts, 300], strict=True):
        merge_prices(table, spark.createDataFrame(rows[a:b], schemas.PRECO))
    quotes = spark.createDataFrame(rows, schemas.PRECO)
    assert _sorted(table.read()) == _sorted(prices_by_priority(quotes))
    merge_prices(table, spark.createDataFrame(rows[:50], schemas.PRECO))          # a load sent again
    assert _sorted(table.read()) == _sorted(prices_by_priority(quotes))


# Inserts


def test_a_repeated_batch_appends_nothing(spark, seed, tmp_dir):
    table = VersionedTable(spark, f"{tmp_dir}/t", ("data_referencia",), ("id_ativo",))
    first = seed.preco.filter("id_preco <= 10")
    assert insert_once(table, first, PRICE, "prices", 1, order=[F.col("id_preco")]) == 10
    assert insert_once(table, seed.preco, PRICE, "prices", 2, order=[F.col("id_preco")]) == 10
    versions = table.versions()
    for number in (1, 2):
        assert insert_once(table, seed.preco.withColumn("id_ativo", F.col("id_ativo") + 100), PRICE, "prices", number) == 0
    assert table.versions() == versions and table.read().count() == 20
    assert insert_once(table, first, PRICE, "other", 1) == 0 and table.loaded("other") == 1   # nothing new, but done
    assert insert_once(table, first.limit(0), PRICE, "prices", 3) == 0 and table.loaded("prices") == 3


def test_the_target_is_read_in_the_touched_partitions_only(spark, seed, tmp_dir):
    table = VersionedTable(spark, f"{tmp_dir}/t", ("data_referencia",), ("id_ativo",))
    table.append(seed.preco)
    batch = seed.preco.filter(F.col("data_referencia") == F.lit(date(2024, 6, 3)))
    target = target_of(table, batch)
    assert all("data_referencia=2024-06-03" in f for f in target.inputFiles()) and target.count() == 10
    plan = target._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [data_referencia" in plan or "PartitionFilters: [isnotnull(data_referencia" in plan


def test_two_inserts_into_one_partition_conflict(spark, seed, tmp_dir, monkeypatch):
    table = VersionedTable(spark, f"{tmp_dir}/t", ("data_referencia",))
    table.append(seed.preco.limit(0))
    stale = table.manifest()
    insert_once(table, seed.preco, PRICE, "a", 1)
    monkeypatch.setattr(VersionedTable, "manifest", lambda self, version=None, real=VersionedTable.manifest: stale if version is None else real(self, version))
    with pytest.raises(ConflictError):
        insert_once(table, seed.preco, PRICE, "b", 1)
    monkeypatch.undo()
    assert insert_once(table, seed.preco, PRICE, "b", 1) == 0 and table.read().count() == 20


# JDBC


def _derby(frames):
    url = f"jdbc:derby:memory:fl{uuid.uuid4().hex[:8]};create=true"
    for name, df in frames.items():
        df = df.select(*[F.col(c).alias(c.upper()) for c in df.columns])   # Derby folds names that are not quoted
        df.write.jdbc(url, name, mode="overwrite", properties={"driver": DERBY})
    return url


def test_balanced_ranges_of_clustered_ids(spark):
    ids = [*range(5000), *range(10 ** 12, 10 ** 12 + 4000), *range(-300, -200), 77 * 10 ** 9, *[10 ** 13] * 40]
    df = spark.createDataFrame([(i,) for i in ids] + [(None,)] * 7, "id long")
    src = JdbcSource(_derby({"t": df}), driver=DERBY)
    plain = src.read_table(spark, "t", partition_column="ID", num_partitions=8)
    even = src.read_balanced(spark, "t", "ID", 8)
    sizes = lambda d: sorted(d.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect())
    assert max(sizes(plain)) > 4000
    got = sizes(even)
    assert sum(got) == len(ids) + 7 and max(got) <= 2 * sum(got) / len(got)
    assert sorted(r[0] for r in even.filter("ID IS NOT NULL").collect()) == sorted(ids)
    empty = JdbcSource(_derby({"t": df.limit(0)}), driver=DERBY)
    assert empty.read_balanced(spark, "t", "ID", 8).count() == 0


def test_the_job_reads_the_star_over_jdbc(spark, seed, tmp_dir):
    url = _derby(seed.frames())
    cfg = JobConfig(source="jdbc", jdbc_url=url, jdbc_driver=DERBY, jdbc_partitions=3, output_dir=f"{tmp_dir}/out")
    report = run(spark, cfg)
    assert report["rows_in"] == report["rows_out"] == 18 and report["problems"] == []
    assert [tuple(r) for r in read_flat_csv(spark, report["output"]).collect()] == [tuple(r) for r in carteira_flat(seed).collect()]


# Published files


def test_csv_sink_newest_run_and_reload_row_for_row(spark, seed, tmp_dir):
    write_star(seed, f"{tmp_dir}/star")
    for name in ("run1", "run2"):
        run(spark, JobConfig(source="parquet", input_dir=f"{tmp_dir}/star", output_dir=f"{tmp_dir}/out", output_name=name))
    want = [tuple(r) for r in carteira_flat(seed).collect()]
    assert [tuple(r) for r in read_newest_flat_csv(spark, f"{tmp_dir}/out").collect()] == want
    assert len(want) == 18 and all(len(r) == 19 for r in want)


def test_the_job_publishes_versions(spark, seed, tmp_dir):
    write_star(seed, f"{tmp_dir}/star")
    cfg = JobConfig(source="parquet", input_dir=f"{tmp_dir}/star", output_dir=f"{tmp_dir}/out", output_format="versioned")
    reports = [run(spark, cfg), run(spark, cfg)]
    assert [r["version"] for r in reports] == [1, 2]
    table = VersionedTable(spark, reports[0]["output"], ("data_posicao",), ("cnpj_fundo", "codigo_ativo"))
    for v in (1, 2):
        assert _sorted(table.read(v)) == _sorted(flat_typed(seed))


# Sketches and quantiles


def test_merged_sketches_are_within_their_error(spark):
    flat = flat_typed(star_from_driver(spark, SMOKE)).cache()
    sketches = exposure.kpi_sketches(flat).cache()
    for window in ({}, {"date_from": "1994-01-01", "date_to": "1995-12-31"}, {"date_from": "2030-01-01"}):
        part = flat
        if "date_from" in window:
            part = part.filter(F.col("data_posicao") >= F.lit(window["date_from"]).cast("date"))
        if "date_to" in window:
            part = part.filter(F.col("data_posicao") <= F.lit(window["date_to"]).cast("date"))
        exact, got = exposure.overview(part).first(), exposure.overview_approx(sketches, **window).first()
        for c in ("n_fundos", "n_ativos", "n_emissores"):
            assert abs((got[c] or 0) - exact[c]) <= max(1, 4 * 1.04 / 2 ** (exposure.SKETCH_LG_K / 2) * exact[c]), c
        for c in ("pl_total", "data_inicial", "data_final"):
            assert got[c] == exact[c]
        assert (got["n_posicoes"] or 0) == exact["n_posicoes"]


@pytest.mark.parametrize("small", [1, 50, 10_000])
def test_radix_selection_on_hard_values(spark, small):
    rnd = random.Random(5)
    columns = {
        "muitos": [D(7)] * 900 + [D(rnd.randint(-5, 5)) for _ in range(99)],
        "longe": [D(rnd.choice([-1, 1])) * D(10) ** rnd.randint(-6, 11) for _ in range(500)],
        "perto": [D(10) ** 11 + D(rnd.randint(0, 400)) / 10 ** 6 for _ in range(700)],
        "zero": [D(0)] * 3, "um": [D("-3.5")], "nada": [],
    }
    n = max(map(len, columns.values()))
    rows = [tuple(v[i] if i < len(v) else None for v in columns.values()) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} decimal(18,6)" for c in columns))
    probs = (0.0, 0.05, 0.5, 0.75, 1.0)
    got = {(r["coluna"], r["p"]): r["valor"] for r in exact_quantiles(df, list(columns), probs, small=small).collect()}
    want = {}
    for c, v in columns.items():
        v = sorted(v)
        for p in probs if v else ():
            at = (len(v) - 1) * D(str(p))
            lo = int(at)
            want[c, p] = v[lo] + (v[min(lo + 1, len(v) - 1)] - v[lo]) * (at - lo)
    assert got.keys() == want.keys() and all(got[k] == want[k].quantize(D(10) ** -12) for k in want)


def test_describe_takes_three_passes(spark, seed):
    flat = flat_typed(seed).select("preco_unitario", "preco_mercado", "valor_financeiro", "percentual_pl").cache()
    flat.count()
    spark.sparkContext.setJobGroup("describe-passes", "describe")
    try:
        rows = describe(flat, flat.columns)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("describe-passes")
    finally:
        spark.sparkContext.setJobGroup("tests", "tests")
    assert len(jobs) <= 5 and rows.count() == 4          # the write, and two counts of at most two jobs each
    assert describe(flat.limit(0), flat.columns).collect() == []
