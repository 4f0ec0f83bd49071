"""Column helpers and session settings."""

from __future__ import annotations

from decimal import Decimal as D

from pyspark.sql import functions as F

from fundlens.functions.text import (contains, fund_short_name, issuer_short_name, lookup, millions_text,
                                     money_text, percent_text, rating_bucket)
from fundlens.plans.profile import shape
from fundlens.session import DEFAULTS, ensure_checkpoint_dir, scratch_dir
from fundlens.sources.ingest import append, append_if_absent, apply_defaults


def test_text_formats(spark):
    df = spark.createDataFrame([(D("219580356.00"), D("69.0475"), 1234567)],
                               "v decimal(18,2), p decimal(10,4), n bigint")
    r = df.select(money_text("v").alias("m"), millions_text("v").alias("mi"), percent_text("p").alias("pc"),
                  F.format_number("n", 0).alias("n")).first()
    assert (r["m"], r["mi"], r["pc"], r["n"]) == ("R$ 219,580,356.00", "R$ 219.6M", "69.0%", "1,234,567")


def test_short_names_buckets_lookup_contains(spark):
    df = spark.createDataFrame([("Casa Multimercado Macro FIM", "Petroleo Brasileiro S.A. - Petrobras", "AA-"),
                                ("Casa RF Conservador FI", "Banco Bradesco S.A.", None),
                                ("Fundo FIDC", "WEG", "C")], "f string, e string, r string")
    rows = df.select(fund_short_name("f").alias("f"), fund_short_name("f", drop_prefix="Casa ").alias("g"),
                     issuer_short_name("e").alias("e"), rating_bucket("r").alias("b"),
                     lookup({"AA-": "alto", "C": "baixo"}, "r", "sem").alias("l"),
                     contains("e", "S.A.").alias("c")).collect()
    assert [tuple(r) for r in rows] == [
        ("Casa Multimercado Macro", "Multimercado Macro", "Petroleo Brasileiro", "AA", "alto", True),
        ("Casa RF Conservador", "RF Conservador", "Banco Bradesco", "NR", "sem", True),
        ("Fundo FIDC", "Fundo FIDC", "WEG", "OUTROS", "baixo", False)]


def test_session_defaults(spark):
    for k in ("spark.sql.ansi.enabled", "spark.sql.adaptive.enabled", "spark.sql.session.timeZone"):
        assert spark.conf.get(k) == DEFAULTS[k]
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    ckpt = ensure_checkpoint_dir(spark)
    assert ckpt and scratch_dir(spark, "x").startswith(ckpt.rstrip("/") + "/x-")


def test_shape_and_defaults(spark, seed):
    assert shape(seed.fundo) == (4, len(seed.fundo.columns))
    filled = apply_defaults(seed.fundo.withColumn("status", F.lit(None).cast("string")), "fundo")
    assert {r["status"] for r in filled.collect()} == {"ATIVO"}
    assert filled.filter(F.col("criado_em").isNull()).count() == 0


def test_append_if_absent_on_parquet(spark, seed, tmp_dir):
    path = f"{tmp_dir}/precos"
    first = seed.preco.filter(F.col("id_preco") <= 10)
    append(first, path)
    assert append_if_absent(spark, seed.preco, path, ["data_referencia", "id_ativo", "fonte_preco"],
                            order=[F.col("id_preco")]) == 10
    assert append_if_absent(spark, seed.preco, path, ["data_referencia", "id_ativo", "fonte_preco"],
                            order=[F.col("id_preco")]) == 0
    assert spark.read.parquet(path).count() == 20


def test_checkpoint_dir_required_on_a_cluster():
    """No silent machine-local fallback when the master is not local."""
    import pytest

    class _Conf:
        def get(self, key, default=None):
            return default

    class _Context:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

    class _Session:
        sparkContext = _Context()
        conf = _Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Session())
