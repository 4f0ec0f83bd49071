"""Sources, sinks and the job, end to end on local files and in-process JDBC."""

from __future__ import annotations

import os
import time
import uuid
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from fundlens import schemas
from fundlens.job import JobConfig, run
from fundlens.plans.flat import carteira_flat, flat_typed
from fundlens.plans.profile import typed_from_text
from fundlens.sources.files import newest_run, read_flat_csv, read_newest_flat_csv
from fundlens.sources.jdbc import JdbcSource
from fundlens.sources.sinks import output_path, write_csv, write_parquet
from seed_data import POSICOES

DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def write_star(seed, root):
    for name, df in seed.frames().items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")


def test_jdbc_partitioned_read_matches_table(spark, seed):
    url = f"jdbc:derby:memory:fl{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": DERBY}
    src_df = seed.posicao.drop("criado_em")
    src_df = src_df.select(*[F.col(c).alias(c.upper()) for c in src_df.columns])
    src_df.write.jdbc(url, "POSICAO_CARTEIRA", mode="overwrite", properties=props)
    src = JdbcSource(url, driver=DERBY)
    df = src.read_table(spark, "POSICAO_CARTEIRA", schemas.POSICAO, partition_column="ID_POSICAO", num_partitions=4)
    assert df.rdd.getNumPartitions() == 4
    assert df.schema == schemas.conform(seed.posicao, schemas.POSICAO).schema
    assert sorted(r["id_posicao"] for r in df.collect()) == list(range(1, len(POSICOES) + 1))
    filtered = df.filter(F.col("id_fundo") == 1)
    assert filtered.count() == 5


def test_csv_round_trip_keeps_null_and_empty_distinct(spark, seed, tmp_dir):
    flat = carteira_flat(seed)
    with_empty = flat.withColumn("nome_emissor", F.when(F.col("codigo_ativo") == "PETR4", F.lit(""))
                                 .when(F.col("codigo_ativo") == "WEGE3", F.lit(None))
                                 .otherwise(F.col("nome_emissor")))
    path = f"{tmp_dir}/flat"
    write_csv(with_empty, path)
    back = read_flat_csv(spark, path)
    assert back.count() == 18
    petr = {r["nome_emissor"] for r in back.filter(F.col("codigo_ativo") == "PETR4").collect()}
    wege = {r["nome_emissor"] for r in back.filter(F.col("codigo_ativo") == "WEGE3").collect()}
    assert petr == {""} and wege == {None}
    typed = typed_from_text(back)
    assert typed.schema["quantidade"].dataType == schemas.QTY
    assert typed.agg(F.sum("valor_financeiro")).first()[0] == D("219580356.00")


def test_newest_run_is_picked(spark, seed, tmp_dir):
    flat = carteira_flat(seed)
    write_csv(flat.limit(3), f"{tmp_dir}/runs/old")
    time.sleep(1.2)
    write_csv(flat, f"{tmp_dir}/runs/new")
    assert newest_run(spark, f"{tmp_dir}/runs").endswith("/runs/new")
    assert read_newest_flat_csv(spark, f"{tmp_dir}/runs").count() == 18
    with pytest.raises(FileNotFoundError):
        os.makedirs(f"{tmp_dir}/empty", exist_ok=True)
        newest_run(spark, f"{tmp_dir}/empty")


def test_partitioned_parquet_dynamic_overwrite(spark, seed, tmp_dir):
    typed = flat_typed(seed)
    path = f"{tmp_dir}/pq"
    write_parquet(typed, path, partition_by=("data_posicao",))
    other = typed.withColumn("data_posicao", F.lit("2024-06-03").cast("date"))
    write_parquet(other.limit(2), path, partition_by=("data_posicao",))
    back = spark.read.parquet(path)
    counts = {str(r["data_posicao"]): r["count"] for r in back.groupBy("data_posicao").count().collect()}
    assert counts == {"2024-05-31": 18, "2024-06-03": 2}
    pruned = back.filter(F.col("data_posicao") == "2024-06-03")
    assert "PartitionFilters: [isnotnull(data_posicao" in pruned._jdf.queryExecution().executedPlan().toString()


def test_a_large_date_is_written_by_several_tasks(spark, tmp_dir):
    rows = spark.range(3000).select("id", F.when(F.col("id") < 2000, F.lit("2024-05-31")).when(F.col("id") < 2900, F.lit("2024-06-03")).alias("day"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small tasks are not put together again
    try:
        write_parquet(rows, f"{tmp_dir}/hot", partition_by=("day",), sort_by=("id",), file_rows=500)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    back = spark.read.parquet(f"{tmp_dir}/hot")
    assert back.columns == ["id", "day"] and back.distinct().count() == 3000
    placed = back.withColumn("file", F.input_file_name())
    files = {str(r["day"]): r["n"] for r in placed.groupBy("day").agg(F.count_distinct("file").alias("n")).collect()}
    assert files["2024-05-31"] > 1 and files["2024-06-03"] >= 1 and files["None"] == 1
    largest = max(r["count"] for r in placed.groupBy("file").count().collect())
    assert largest < 2000


def test_job_end_to_end(spark, seed, tmp_dir):
    write_star(seed, f"{tmp_dir}/star")
    cfg = JobConfig(source="parquet", input_dir=f"{tmp_dir}/star", output_dir=f"{tmp_dir}/out",
                    append_timestamp=True)
    report = run(spark, cfg)
    assert report["rows_in"] == 18 and report["rows_out"] == 18 and report["problems"] == []
    assert report["table_rows"] == {"fundo": 4, "ativo": 10, "emissor": 6, "posicao_carteira": 18,
                                    "preco_mercado": 20}
    assert set(report["phases"]) == {"extract", "validate_inputs", "transform", "stage", "validate_output", "load"}
    back = read_flat_csv(spark, report["output"]).collect()
    assert [r["codigo_ativo"] for r in back][:2] == ["CDB-ITAU-2025", "LFT-2027"]


def test_job_incremental_parquet(spark, seed, tmp_dir):
    write_star(seed, f"{tmp_dir}/star")
    cfg = JobConfig(source="parquet", input_dir=f"{tmp_dir}/star", output_dir=f"{tmp_dir}/out",
                    output_format="parquet", date_from="2024-05-31", date_to="2024-05-31")
    report = run(spark, cfg)
    assert spark.read.parquet(report["output"]).count() == 18


def test_job_strict_failure_raises(spark, seed, tmp_dir):
    write_star(seed, f"{tmp_dir}/star")
    cfg = JobConfig(source="parquet", input_dir=f"{tmp_dir}/star", output_dir=f"{tmp_dir}/out",
                    date_from="2030-01-01")
    with pytest.raises(ValueError, match="empty"):
        run(spark, cfg)


def test_output_path_stamp():
    from datetime import datetime
    assert output_path("/o", "carteira_flat", True, datetime(2024, 5, 31, 8, 9, 10)) == \
        "/o/carteira_flat_20240531_080910"
    assert output_path("/o/", "x") == "/o/x"


def test_stage_star_partitioned_by_date_prunes(spark, seed, tmp_dir):
    from fundlens.sources.driver_tables import stage_star

    staged = stage_star(seed, f"{tmp_dir}/star", partition_by_date=True)
    assert staged.posicao.count() == 18 and staged.preco.count() == 20
    one_day = staged.preco.filter(F.col("data_referencia") == "2024-06-03")
    text = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(data_referencia" in text and one_day.count() == 10
