"""Incremental load of the flat view with Structured Streaming: new positions and late prices.

Position and price files arriving under two folders are one stream. Each micro-batch

1. merges its quotes into the kept winning prices, reading only the partitions of their dates;
2. takes the new positions of the batch (first per date, fund and asset, not published yet) and joins them
   with the dimensions and the winners of their dates;
3. gives published rows whose (date, asset) got a quote in this batch their winner again, so a late or
   better price changes the published row;
4. replaces the touched date partitions of the versioned flat view in one commit.

The batch number is committed with the rows. A batch that Spark replays after a failure sees its number
and does nothing; if the failure came between the two tables, merging the same quotes again changes nothing and the
flat view follows. Only the dates a batch touches are read, never the price history. The
files of a batch are written to the shared scratch folder first, so its steps see the same rows.

Run it with ``trigger="available_now"`` as a scheduled batch (process what arrived, then stop) or with a
processing-time trigger as a service.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fundlens import schemas
from fundlens.model import Star
from fundlens.operators.dedup import first_per_key
from fundlens.operators.joins import new_keys
from fundlens.plans.flat import enriched_positions
from fundlens.plans.prices import merge_prices
from fundlens.session import scratch_dir, written
from fundlens.sources.ingest import in_partitions
from fundlens.sources.versions import VersionedTable

KEY = ("data_posicao", "id_fundo", "id_ativo")
#: The published columns: the flat contract and the ids that later batches need.
PUBLISHED = (*schemas.FLAT_COLUMNS, "id_fundo", "id_ativo")
PUBLISHED_SCHEMA = T.StructType([*schemas.FLAT_TYPED.fields, T.StructField("id_fundo", schemas.ID), T.StructField("id_ativo", schemas.ID)])


def flat_table(spark: SparkSession, path: str) -> VersionedTable:
    """The published flat view, a partition per position date."""
    return VersionedTable(spark, path, ("data_posicao",), ("cnpj_fundo", "codigo_ativo"))


def winners_table(spark: SparkSession, path: str) -> VersionedTable:
    """The winning price per (date, asset), a partition per date."""
    return VersionedTable(spark, path, ("data_referencia",), ("id_ativo",))


def arrivals(spark: SparkSession, positions_dir: str, prices_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Position and price files as one stream; ``_tipo`` tells them apart."""
    def files(path: str, schema, kind: str) -> DataFrame:
        r = spark.readStream.schema(schema)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return r.parquet(path).withColumn("_tipo", F.lit(kind))

    return files(positions_dir, schemas.POSICAO, "posicao").unionByName(
        files(prices_dir, schemas.PRECO, "preco"), allowMissingColumns=True)


def publish(flat: VersionedTable, winners: VersionedTable, dims: Star, positions: DataFrame, quotes: DataFrame,
            loads: dict[str, int] | None = None) -> int | None:
    """One increment: ``positions`` and ``quotes`` into the two tables; the flat view's new version (None: nothing to do).

    Both frames are read several times: give scans or written tables.
    """
    if not quotes.isEmpty():
        merge_prices(winners, quotes)
    base = flat.manifest()
    touched = flat.folders_of(positions.select("data_posicao"))
    # Late quotes concern published dates only.
    quoted = flat.folders_of(quotes.select(F.col("data_referencia").alias("data_posicao")))
    touched |= {f: v for f, v in quoted.items() if f in base.parts}
    if not touched:
        return None if not loads else flat.append(flat.read(schema=PUBLISHED_SCHEMA).limit(0), loads, base).version
    days = in_partitions(flat, touched)
    price_dates = {f.replace("data_posicao=", "data_referencia="): {"data_referencia": v["data_posicao"]} for f, v in touched.items()}
    prices = winners.read(only=price_dates, schema=quotes.schema).filter(in_partitions(winners, price_dates))
    published = flat.read(base.version, only=touched, schema=PUBLISHED_SCHEMA).filter(days)

    unpublished = new_keys(first_per_key(positions, KEY, [F.col("id_posicao")]), published, KEY)
    fresh = enriched_positions(replace(dims, posicao=unpublished, preco=prices)).select(*PUBLISHED)

    requoted = quotes.select(F.col("data_referencia").alias("data_posicao"), "id_ativo").distinct()
    again = prices.select(F.col("data_referencia").alias("data_posicao"), "id_ativo",
                          F.col("preco_mercado").alias("_preco"), F.col("fonte_preco").alias("_fonte")) \
        .join(requoted, ["data_posicao", "id_ativo"], "left_semi").withColumn("_novo", F.lit(True))
    repriced = published.join(again, ["data_posicao", "id_ativo"], "left") \
        .withColumn("preco_mercado", F.when(F.col("_novo"), F.col("_preco")).otherwise(F.col("preco_mercado"))) \
        .withColumn("fonte_preco", F.when(F.col("_novo"), F.col("_fonte")).otherwise(F.col("fonte_preco"))).select(*PUBLISHED)
    return flat.replace(repriced.unionByName(fresh), folders=touched, loads=loads, base=base).version


def start_incremental_flat(spark: SparkSession, positions_dir: str, prices_dir: str, dims: Star, flat: VersionedTable,
                           winners: VersionedTable, checkpoint_location: str | None = None, trigger: str = "available_now",
                           interval: str = "1 minute", query_name: str = "flat-increment",
                           max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; returns the running query (``awaitTermination`` to wait)."""
    def load(batch: DataFrame, number: int) -> None:
        last = flat.loaded(query_name)
        if last is not None and last >= number:
            return
        rows = written(batch, "increment")
        positions = rows.filter("_tipo = 'posicao'").select(*schemas.POSICAO.fieldNames())
        quotes = rows.filter("_tipo = 'preco'").select(*schemas.PRECO.fieldNames())
        publish(flat, winners, dims, positions, quotes, {query_name: number})

    w = (arrivals(spark, positions_dir, prices_dir, max_files_per_trigger).writeStream.foreachBatch(load)
         .queryName(query_name).option("checkpointLocation", checkpoint_location or scratch_dir(spark, "flat-stream")))
    w = w.trigger(availableNow=True) if trigger == "available_now" else w.trigger(processingTime=interval)
    return w.start()
