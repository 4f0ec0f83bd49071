"""The incremental flat view: new days once, late prices, replays, metrics."""

from __future__ import annotations

import time
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from fundlens import schemas
from fundlens.model import Star
from fundlens.plans.flat import flat_typed
from fundlens.streaming.incremental import flat_table, publish, start_incremental_flat, winners_table
from fundlens.streaming.metrics import BatchMetrics

DAY, NEXT = date(2024, 5, 31), date(2024, 6, 3)


@pytest.fixture()
def stream(spark, seed, tmp_dir):
    """(run the stream once, add position rows, add quotes, published rows, tables)."""
    dims = Star(fundo=seed.fundo, ativo=seed.ativo, emissor=seed.emissor, posicao=seed.posicao, preco=seed.preco)
    flat, winners = flat_table(spark, f"{tmp_dir}/flat"), winners_table(spark, f"{tmp_dir}/winners")
    for name, df in (("positions", seed.posicao), ("prices", seed.preco)):
        df.limit(0).write.parquet(f"{tmp_dir}/{name}")

    def run(**options):
        start_incremental_flat(spark, f"{tmp_dir}/positions", f"{tmp_dir}/prices", dims, flat, winners, f"{tmp_dir}/ckpt",
                               **options).awaitTermination()

    def add(name, df):
        df.coalesce(1).write.mode("append").parquet(f"{tmp_dir}/{name}")

    run.add, run.flat, run.winners, run.dims = add, flat, winners, dims
    return run


def _flat(df):
    cols = sorted(schemas.FLAT_COLUMNS)
    return sorted(map(repr, df.select(cols).collect()))


def _batch(spark, seed, positions, quotes):
    """The flat view of everything at once."""
    return _flat(flat_typed(Star(fundo=seed.fundo, ativo=seed.ativo, emissor=seed.emissor, posicao=positions, preco=quotes)))


def _quote(spark, id_preco, day, asset, price, source):
    return spark.createDataFrame([(id_preco, day, asset, D(price), source, None)], schemas.PRECO)


def test_new_days_are_added_once(spark, seed, stream):
    stream.add("positions", seed.posicao)
    stream.add("prices", seed.preco)
    stream()
    assert stream.flat.read().count() == 18
    next_day = seed.posicao.withColumn("data_posicao", F.lit(NEXT))
    stream.add("positions", next_day)
    stream()
    stream()                                     # nothing new
    both = seed.posicao.unionByName(next_day)
    assert _flat(stream.flat.read()) == _batch(spark, seed, both, seed.preco)
    assert stream.flat.read().filter(F.col("preco_mercado").isNull()).count() == 0
    stream.add("positions", next_day)            # the same positions sent again
    stream()
    assert stream.flat.read().count() == 36


def test_a_late_or_better_price_changes_the_published_row(spark, seed, stream):
    stream.add("positions", seed.posicao)
    stream.add("prices", seed.preco.filter("id_ativo <> 4"))
    stream()
    petr = stream.flat.read().filter("codigo_ativo = 'PETR4'")
    assert petr.filter("preco_mercado IS NULL").count() == petr.count() > 0
    stream.add("prices", _quote(spark, 900, DAY, 4, "38.250000", "CETIP"))   # late
    stream()
    late = stream.flat.manifest().version
    assert {(r["preco_mercado"], r["fonte_preco"]) for r in stream.flat.read().filter("codigo_ativo = 'PETR4'").collect()} \
        == {(D("38.250000"), "CETIP")}
    stream.add("prices", _quote(spark, 901, DAY, 4, "99.000000", "BLOOMBERG"))  # worse source: the winner stays
    stream.add("prices", _quote(spark, 902, DAY, 1, "3500.000000", "ANBIMA"))   # same source, later id
    stream()
    quotes = seed.preco.filter("id_ativo <> 4").unionByName(_quote(spark, 900, DAY, 4, "38.250000", "CETIP"))
    assert _flat(stream.flat.read()) == _batch(spark, seed, seed.posicao, quotes)
    stream.add("prices", _quote(spark, 903, DAY, 4, "38.500000", "B3"))         # better source
    stream()
    assert {r["fonte_preco"] for r in stream.flat.read().filter("codigo_ativo = 'PETR4'").collect()} == {"B3"}
    assert {r["fonte_preco"] for r in stream.flat.read(late).filter("codigo_ativo = 'PETR4'").collect()} == {"CETIP"}
    assert stream.flat.read().count() == 18


def test_prices_before_positions_and_file_by_file(spark, seed, stream):
    stream.add("prices", seed.preco)
    stream()
    assert stream.flat.read().count() == 0 and stream.winners.read().count() == 20
    stream.add("positions", seed.posicao.filter("id_posicao <= 9"))
    stream.add("positions", seed.posicao.filter("id_posicao > 9"))
    stream(max_files_per_trigger=1)
    assert _flat(stream.flat.read()) == _batch(spark, seed, seed.posicao, seed.preco)


def test_a_replayed_batch_adds_nothing(spark, seed, stream, monkeypatch):
    publish(stream.flat, stream.winners, stream.dims, seed.posicao, seed.preco, {"flat-increment": 0})
    versions = stream.flat.versions()
    stream.add("positions", seed.posicao.withColumn("data_posicao", F.lit(NEXT)))
    stream()                                     # batch 0 is committed already: skipped
    assert stream.flat.versions() == versions and stream.flat.read().count() == 18


def test_a_failure_between_the_tables_is_made_up_for(spark, seed, stream, monkeypatch):
    import fundlens.streaming.incremental as inc

    stream.add("positions", seed.posicao)
    stream.add("prices", seed.preco)
    monkeypatch.setattr(inc, "enriched_positions", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(Exception, match="lost"):
        stream()
    monkeypatch.undo()
    assert stream.winners.read().count() == 20 and stream.flat.versions() == []
    stream()                                     # Spark replays the batch
    assert _flat(stream.flat.read()) == _batch(spark, seed, seed.posicao, seed.preco)


def test_a_batch_reads_only_its_dates(spark, seed, stream):
    quotes = seed.preco.unionByName(seed.preco.withColumn("data_referencia", F.lit(date(2020, 1, 2))).withColumn("id_preco", F.col("id_preco") + 500))
    publish(stream.flat, stream.winners, stream.dims, seed.posicao, quotes)
    before = stream.winners.manifest()
    publish(stream.flat, stream.winners, stream.dims, seed.posicao.limit(0), _quote(spark, 990, DAY, 4, "1.0", "ANBIMA"))
    after = stream.winners.manifest()
    assert list(after.touched) == ["data_referencia=2024-05-31"]
    assert after.parts["data_referencia=2020-01-02"] == before.parts["data_referencia=2020-01-02"]


def test_metrics_of_each_batch(spark, seed, stream, tmp_dir):
    seen = BatchMetrics(("flat-increment",))
    spark.streams.addListener(seen)
    try:
        stream.add("positions", seed.posicao)
        stream.add("prices", seed.preco)
        stream()
        stream.add("prices", _quote(spark, 903, DAY, 4, "38.500000", "ANBIMA"))
        stream()
        for _ in range(100):                     # the listener bus is asynchronous
            if len({r[1] for r in seen.rows}) == 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(seen)
    frame = {(r["lote"], r["grupo"], r["nome"]): r["valor"] for r in seen.frame(spark).collect()}
    assert frame[0, "linhas", "entrada"] >= 38 and frame[1, "linhas", "entrada"] >= 1
    assert {k[2] for k in frame if k[1] == "segundos"} >= {"addBatch", "triggerExecution"}
    n = seen.append(spark, f"{tmp_dir}/metrics")
    assert spark.read.parquet(f"{tmp_dir}/metrics").count() == n > 0 and seen.append(spark, f"{tmp_dir}/metrics") == 0
