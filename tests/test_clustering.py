"""Files along an interleaved order: filters on any clustering column read less."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from fundlens.sources.clustering import clustered, interleave, interleaved, rank_of, value_ranks
from fundlens.sources.sinks import write_parquet
from fundlens.sources.versions import VersionedTable


@pytest.fixture(scope="module")
def rows(spark):
    """40,000 positions in random order; one fund holds a third of them, some have no fund."""
    h = F.pmod(F.xxhash64("id"), F.lit(600))
    fund = F.when(h < 200, F.lit("F7")).when(h > 590, F.lit(None)).otherwise(F.concat(F.lit("F"), F.pmod(h, F.lit(97)).cast("string")))
    return spark.range(40_000, numPartitions=4).select(
        fund.alias("fundo"), F.concat(F.lit("A"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(500)).cast("string")).alias("ativo"),
        F.lit(date(2024, 5, 31)).alias("dia"), F.col("id").alias("_h0")).orderBy(F.xxhash64("_h0", F.lit(2)))


def _scanned(df) -> tuple[int, int]:
    """(rows that the scan gave, rows that are left)."""
    df.collect()
    n = df.count()
    plan = df.select("*")
    plan.collect()
    executed = plan._jdf.queryExecution().executedPlan()
    leaf = (executed.executedPlan() if "Adaptive" in executed.nodeName() else executed).collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value(), n


@pytest.mark.parametrize("where", ["fundo = 'F13'", "ativo = 'A77'", "fundo = 'F7' AND ativo = 'A3'"])
def test_filters_read_fewer_rows(spark, rows, tmp_dir, where):
    write_parquet(rows, f"{tmp_dir}/plain", partition_by=("dia",), file_rows=2000)
    write_parquet(rows, f"{tmp_dir}/close", partition_by=("dia",), file_rows=2000, cluster_by=("fundo", "ativo"))
    plain, close = (spark.read.parquet(f"{tmp_dir}/{n}").filter(where) for n in ("plain", "close"))
    (all_rows, n), (read, m) = _scanned(plain), _scanned(close)
    assert n == m > 0 and all_rows > 35_000
    assert read <= all_rows / 2.5


def test_nothing_is_lost_and_files_stay_even(spark, rows, tmp_dir):
    write_parquet(rows, f"{tmp_dir}/close", partition_by=("dia",), file_rows=2000, cluster_by=("fundo", "ativo"))
    back = spark.read.parquet(f"{tmp_dir}/close")
    assert sorted(back.columns) == ["_h0", "ativo", "dia", "fundo"]
    assert back.count() == 40_000 and back.select("_h0").distinct().count() == 40_000
    sizes = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 15 and max(sizes) <= 4 * 2000
    t = VersionedTable(spark, f"{tmp_dir}/t", ("dia",), cluster_by=("fundo", "ativo"))
    t.append(rows)
    t.append(rows.limit(0))
    assert t.read().exceptAll(rows.select(*t.read().columns)).isEmpty() and t.read().count() == 40_000


def test_ranks_follow_the_rows(spark):
    df = spark.createDataFrame([("b",)] * 50 + [("a",)] * 25 + [("c",)] * 25 + [(None,)] * 100, "v string")
    assert {r["valor"]: r["faixa"] for r in value_ranks(df, "v", 3).collect()} == {None: 0, "a": 4, "b": 5, "c": 7}
    got = spark.createDataFrame([(0b101, 0b011)], "x long, y long").select(interleave([F.col("x"), F.col("y")], 3)).first()[0]
    assert got == 0b100111


@pytest.mark.parametrize("value", [
    "concat('A', id % 61)", "id % 61 - 30", "date_add(date'2024-01-01', cast(id % 61 as int))", "cast(id % 61 - 30 as decimal(18,6)) / 8",
    "if(id % 7 = 0, double('NaN'), id % 61 - 30d)", "timestamp_seconds((id % 61) * 1e7)", "id % 3 = 0", "unhex(hex(id % 61))", "cast(null as string)"])
def test_a_row_finds_the_rank_of_its_value_without_a_join(spark, value):
    rows = spark.range(500, numPartitions=3).selectExpr("id", f"if(id % 11 = 0, null, {value}) as v")
    want = rows.join(value_ranks(rows, "v", 4), F.col("v").eqNullSafe(F.col("valor"))).select("id", "faixa")
    assert sorted(rows.select("id", rank_of(rows, "v", 4)).collect()) == sorted(want.collect())
    plan = interleaved(rows, ["v", "id"], "key")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_small_files_are_cut_from_few_shuffle_partitions(spark, rows, tmp_dir, monkeypatch):
    from fundlens.sources import sinks
    asked = []
    monkeypatch.setattr(sinks, "clustered", lambda df, by, cols, n: asked.append(n) or clustered(df, by, cols, n))
    write_parquet(rows, f"{tmp_dir}/small", file_rows=500, cluster_by=("fundo", "ativo"))
    assert asked == [int(spark.conf.get("spark.sql.shuffle.partitions"))]
    sizes = [r["count"] for r in spark.read.parquet(f"{tmp_dir}/small").groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) == 500 and len(sizes) <= 40_000 // 500 + asked[0]
