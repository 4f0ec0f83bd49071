"""The flat-view job: extract, validate, transform, stage, check, publish.

One evaluation of the joins per run: the typed flat view is written once to
the shared checkpoint folder while an ``Observation`` collects its row count
and critical-NULL counts on the same pass. Validation reads those metrics
(no extra job) and, only if they pass, the text view is rendered from the
staged table and published. A failed run raises with its traceback.

Run with ``spark-submit -m fundlens.job --help`` or ``python -m fundlens.job``.
"""

from __future__ import annotations

import argparse
import logging
import os
import time
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fundlens import schemas
from fundlens.model import Star
from fundlens.operators import quality
from fundlens.operators.joins import DEFAULT_BROADCAST_MAX_BYTES, DEFAULT_BROADCAST_MAX_ROWS, DEFAULT_HOT_MIN_ROWS, \
    measured_size
from fundlens.plans.flat import flat_typed, render_flat, sort_output
from fundlens.session import build_session, scratch_dir
from fundlens.sources.driver_tables import star_from_driver
from fundlens.sources.files import read_star_parquet
from fundlens.sources.jdbc import JdbcSource
from fundlens.sources.sinks import output_path, write_csv, write_parquet
from fundlens.sources.versions import VersionedTable

log = logging.getLogger("fundlens.job")

DIMENSION_KEYS = {"fundo": ("id_fundo",), "ativo": ("id_ativo",), "emissor": ("id_emissor",)}


@dataclass(frozen=True)
class JobConfig:
    source: str = "parquet"              # parquet | driver | jdbc
    input_dir: str | None = None
    jdbc_url: str | None = None
    jdbc_user: str | None = None
    jdbc_password: str | None = None
    jdbc_schema: str | None = None
    jdbc_driver: str = "org.postgresql.Driver"
    jdbc_partitions: int = 8
    output_dir: str = "output"
    output_name: str = "carteira_flat"
    append_timestamp: bool = False
    output_format: str = "csv"           # csv | parquet | versioned
    single_file: bool = False
    cluster: bool = False                # parquet, versioned: files clustered by fund and asset
    date_from: str | None = None
    date_to: str | None = None
    strict: bool = True
    check_dimension_keys: bool = True
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS
    hot_min_rows: int = DEFAULT_HOT_MIN_ROWS  # price-join keys above this are salted; 0 turns salting off


@dataclass
class PhaseLog:
    """Start, end and duration of each phase, kept in the run report."""

    phases: dict[str, float] = field(default_factory=dict)

    @contextmanager
    def phase(self, name: str):
        log.info("phase %s: start", name)
        t0 = time.perf_counter()
        try:
            yield
        except Exception:
            log.exception("phase %s failed after %.2fs", name, time.perf_counter() - t0)
            raise
        self.phases[name] = round(time.perf_counter() - t0, 3)
        log.info("phase %s: done in %.2fs", name, self.phases[name])


def metrics_frame(spark: SparkSession, report: dict) -> DataFrame:
    """The run's metrics as rows ``(grupo, nome, valor)``: seconds per phase, rows per table, rows in and out."""
    rows = [("segundos", k, float(v)) for k, v in report.get("phases", {}).items()]
    rows += [("linhas", k, float(v)) for k, v in report.get("table_rows", {}).items() if v is not None]
    rows += [("linhas", k, float(report[k])) for k in ("rows_in", "rows_out") if report.get(k) is not None]
    return spark.createDataFrame(rows, "grupo string, nome string, valor double")


def load_star(spark: SparkSession, cfg: JobConfig) -> Star:
    if cfg.source == "driver":
        return star_from_driver(spark, cfg.input_dir)
    if cfg.source == "parquet":
        return read_star_parquet(spark, cfg.input_dir, with_trades=False)
    if cfg.source == "jdbc":
        src = JdbcSource(cfg.jdbc_url, driver=cfg.jdbc_driver, user=cfg.jdbc_user,
                         password=cfg.jdbc_password, schema=cfg.jdbc_schema)
        parts = {"posicao_carteira": "id_posicao", "preco_mercado": "id_preco"}
        frames = {name: src.read_balanced(spark, name, parts[name], cfg.jdbc_partitions, schemas.TABLES[name])
                  if name in parts else src.read_table(spark, name, schemas.TABLES[name])
                  for name in ("fundo", "ativo", "emissor", "posicao_carteira", "preco_mercado")}
        return Star(fundo=frames["fundo"], ativo=frames["ativo"], emissor=frames["emissor"],
                    posicao=frames["posicao_carteira"], preco=frames["preco_mercado"])
    raise ValueError(f"unknown source {cfg.source!r}")


def restrict_dates(star: Star, date_from: str | None, date_to: str | None) -> Star:
    """Incremental window on the position and price dates (pushed down to the scans)."""
    if not date_from and not date_to:
        return star

    def between(df: DataFrame, c: str) -> DataFrame:
        if date_from:
            df = df.filter(F.col(c) >= F.lit(date_from).cast("date"))
        if date_to:
            df = df.filter(F.col(c) <= F.lit(date_to).cast("date"))
        return df

    trades = star.operacao
    if trades is not None:
        trades = between(trades, "data_operacao")
    return replace(star, posicao=between(star.posicao, "data_posicao"),
                   preco=between(star.preco, "data_referencia"), operacao=trades)


def dimension_stats(star: Star) -> dict[str, tuple[int, int]]:
    """``{table: (rows, duplicate key rows)}`` for the dimensions, in one action."""
    frames = star.frames()
    parts = []
    for t, keys in DIMENSION_KEYS.items():
        per_key = frames[t].groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(per_key.agg(F.lit(t).alias("tabela"), F.sum("_n").alias("rows"),
                                 F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1).otherwise(0)).alias("dups")))
    return {r["tabela"]: (r["rows"] or 0, r["dups"] or 0) for r in quality.union_all(parts).collect()}


def check_dimension_keys(star: Star, stats: dict[str, tuple[int, int]] | None = None) -> None:
    """Unique dimension keys (else left joins would multiply positions)."""
    stats = stats or dimension_stats(star)
    bad = {t: d for t, (_, d) in stats.items() if d}
    if bad:
        raise ValueError("duplicate dimension keys -> " + "; ".join(f"{t}: {d} rows" for t, d in bad.items()))


def _observed_rows(obs: Observation) -> int | None:
    """Rows seen by ``obs``, or None when its side of the plan never ran (e.g. adaptive
    execution skipped the price side because there were no positions)."""
    try:
        return obs.get.get("rows")
    except Exception:  # noqa: BLE001 - metrics were never produced
        return None


def run(spark: SparkSession, cfg: JobConfig) -> dict:
    plog = PhaseLog()
    report: dict = {"config": {k: v for k, v in asdict(cfg).items() if "password" not in k}}

    with plog.phase("extract"):
        star = restrict_dates(load_star(spark, cfg), cfg.date_from, cfg.date_to)
        schemas.require_columns(star.frames())
        # Row counts of the big inputs are taken on the staging pass itself (no extra scan).
        obs_in, obs_prices = Observation("positions_in"), Observation("prices_in")
        star = replace(star, posicao=star.posicao.observe(obs_in, F.count(F.lit(1)).alias("rows")),
                       preco=star.preco.observe(obs_prices, F.count(F.lit(1)).alias("rows")))

    with plog.phase("validate_inputs"):
        # One action gives both the key check and the row counts behind the broadcast decision.
        stats = dimension_stats(star)
        report["dimension_rows"] = {t: r for t, (r, _) in stats.items()}
        if cfg.check_dimension_keys:
            check_dimension_keys(star, stats)
        frames = star.frames()
        # Each dimension by itself: a large asset table leaves the small fund table broadcast.
        small_dims = {t: r <= cfg.broadcast_max_rows and measured_size(frames[t], frames[t])[1] <= DEFAULT_BROADCAST_MAX_BYTES
                      for t, (r, _) in stats.items()}

    with plog.phase("transform"):
        typed = flat_typed(star, broadcast=small_dims, max_rows=cfg.broadcast_max_rows,
                           split_hot_keys=cfg.hot_min_rows > 0, hot_min_rows=max(cfg.hot_min_rows, 1))
        obs_out = Observation("flat_out")
        typed = typed.observe(obs_out, F.count(F.lit(1)).alias("rows"),
                              *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in schemas.FLAT_CRITICAL])

    with plog.phase("stage"):
        staged = scratch_dir(spark, "flat-typed")
        typed.write.mode("overwrite").parquet(staged)

    with plog.phase("validate_output"):
        metrics = obs_out.get
        report["rows_in"] = obs_in.get.get("rows")
        report["table_rows"] = {**report.get("dimension_rows", {}), "posicao_carteira": report["rows_in"],
                                "preco_mercado": _observed_rows(obs_prices)}
        report["rows_out"] = metrics.get("rows")
        problems = []
        if report["rows_out"] == 0:
            problems.append("output is empty")
        if report["rows_in"] is not None and report["rows_in"] != report["rows_out"]:
            problems.append(f"row count changed: {report['rows_in']} positions in, {report['rows_out']} out")
        problems += [f"critical field {c} has {metrics[f'null_{c}']} NULLs" for c in schemas.FLAT_CRITICAL
                     if metrics.get(f"null_{c}")]
        text = render_flat(spark.read.parquet(staged))
        problems += quality.contract_problems(text, all_strings=True)
        report["problems"] = problems
        if problems and cfg.strict:
            raise ValueError("flat view failed validation: " + "; ".join(problems))

    with plog.phase("load"):
        out = output_path(cfg.output_dir, cfg.output_name, cfg.append_timestamp)
        order = {"cluster_by" if cfg.cluster else "sort_by": ("cnpj_fundo", "codigo_ativo")}
        if cfg.output_format == "csv":
            write_csv(sort_output(text), out, single_file=cfg.single_file)
        elif cfg.output_format == "parquet":
            typed_staged = spark.read.parquet(staged)
            write_parquet(typed_staged, out, partition_by=("data_posicao",), **order)
        elif cfg.output_format == "versioned":
            table = VersionedTable(spark, out, ("data_posicao",), **order)
            report["version"] = table.replace(spark.read.schema(typed.schema).parquet(staged)).version
        else:
            raise ValueError(f"unknown output format {cfg.output_format!r}")
        report["output"] = out

    report["phases"] = plog.phases
    return report


def parse_args(argv: list[str] | None = None) -> JobConfig:
    env = os.environ.get
    p = argparse.ArgumentParser(description="Build the flat view of fund positions.")
    p.add_argument("--source", default=env("FUNDLENS_SOURCE", "parquet"), choices=("parquet", "driver", "jdbc"))
    p.add_argument("--input-dir", default=env("FUNDLENS_INPUT_DIR"))
    p.add_argument("--jdbc-url", default=env("FUNDLENS_JDBC_URL"))
    p.add_argument("--jdbc-user", default=env("FUNDLENS_JDBC_USER"))
    p.add_argument("--jdbc-password", default=env("FUNDLENS_JDBC_PASSWORD"))
    p.add_argument("--jdbc-schema", default=env("FUNDLENS_JDBC_SCHEMA"))
    p.add_argument("--jdbc-partitions", type=int, default=int(env("FUNDLENS_JDBC_PARTITIONS", "8")))
    p.add_argument("--output-dir", default=env("FUNDLENS_OUTPUT_DIR", "output"))
    p.add_argument("--output-name", default="carteira_flat")
    p.add_argument("--append-timestamp", action="store_true")
    p.add_argument("--output-format", default="csv", choices=("csv", "parquet", "versioned"))
    p.add_argument("--single-file", action="store_true")
    p.add_argument("--cluster", action="store_true")
    p.add_argument("--date-from")
    p.add_argument("--date-to")
    p.add_argument("--no-strict", action="store_true")
    p.add_argument("--hot-min-rows", type=int, default=DEFAULT_HOT_MIN_ROWS,
                   help="salt (date, asset) keys of the price join holding more positions than this; 0 = off")
    a = p.parse_args(argv)
    return JobConfig(source=a.source, input_dir=a.input_dir, jdbc_url=a.jdbc_url, jdbc_user=a.jdbc_user,
                     jdbc_password=a.jdbc_password, jdbc_schema=a.jdbc_schema, jdbc_partitions=a.jdbc_partitions,
                     output_dir=a.output_dir, output_name=a.output_name, append_timestamp=a.append_timestamp,
                     output_format=a.output_format, single_file=a.single_file, cluster=a.cluster, date_from=a.date_from,
                     date_to=a.date_to, strict=not a.no_strict, hot_min_rows=a.hot_min_rows)


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    cfg = parse_args(argv)
    spark = build_session("fundlens-flat")
    try:
        report = run(spark, cfg)
        log.info("run report: %s", report)
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
