"""Loading into the model: insert-if-absent, column defaults, surrogate keys.

Natural-key conflicts are resolved the way ``INSERT ... ON CONFLICT DO
NOTHING`` resolves them: the first row per key inside the batch, and only
keys the target does not hold yet. Both steps are key-partitioned (an
aggregate and an anti join), never a driver-side loop.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundlens.operators.dedup import first_per_key
from fundlens.operators.joins import new_keys
from fundlens.sources.versions import Manifest, VersionedTable

# Column defaults of the source model (fixed values).
DEFAULTS: dict[str, dict[str, str]] = {
    "fundo": {"status": "ATIVO"},
}
# Audit timestamps each table carries (fixed values).
AUDIT_COLUMNS: dict[str, tuple[str, ...]] = {
    "emissor": ("criado_em", "atualizado_em"),
    "ativo": ("criado_em", "atualizado_em"),
    "fundo": ("criado_em", "atualizado_em"),
    "posicao_carteira": ("criado_em",),
    "operacao": ("criado_em",),
    "preco_mercado": ("criado_em",),
}


def insert_if_absent(batch: DataFrame, target: DataFrame, keys: Sequence[str],
                     order: Sequence[Column] | None = None) -> DataFrame:
    """Rows of ``batch`` to append: first per natural key (by ``order``), key absent in ``target``."""
    keys = list(keys)
    if order is not None:
        batch = first_per_key(batch, keys, order)
    return new_keys(batch, target, keys)


def append(df: DataFrame, path: str) -> None:
    """Plain append (tables without a natural key, e.g. trades)."""
    df.write.mode("append").parquet(path)


def append_if_absent(spark, batch: DataFrame, path: str, keys: Sequence[str],
                     order: Sequence[Column] | None = None) -> int:
    """Append to the Parquet table at ``path`` only the batch rows whose key is new.

    Returns the number of rows appended (from an ``Observation`` on the write,
    no second pass). Re-running with the same batch appends nothing.
    """
    from pyspark.sql import Observation

    target = spark.read.parquet(path)
    new = insert_if_absent(batch.select(*target.columns), target, keys, order)
    obs = Observation("appended")
    new.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return int(obs.get.get("rows", 0))


def insert_once(table: VersionedTable, batch: DataFrame, keys: Sequence[str], source: str, number: int,
                order: Sequence[Column] | None = None) -> int:
    """Load ``number`` of ``source`` into a versioned table: rows whose key is absent, exactly once.

    The load number is committed with the rows, so a load that is repeated (after a failure, or sent twice) appends
    nothing and reads nothing. The target is read only in the partitions the batch touches,
    and a concurrent writer to one of these raises ``ConflictError``. ``keys`` must contain the
    partition columns, or name something that never moves between partitions. Returns the rows appended.
    """
    base = table.manifest()
    if base.loads.get(source, number - 1) >= number:
        return 0
    new = insert_if_absent(batch, target_of(table, batch, base), keys, order)
    return table.append(new.select(*batch.columns), {source: number}, base, depends=True).rows


def target_of(table: VersionedTable, batch: DataFrame, base: Manifest | None = None) -> DataFrame:
    """The rows of ``table`` in the partitions that ``batch`` touches: other folders are not listed, and
    the scan carries the partition filter."""
    base = table.manifest() if base is None else base
    touched = table.folders_of(batch)
    rows = table.read(base.version, only=touched, schema=batch.schema)
    return rows.filter(in_partitions(table, touched))


def in_partitions(table: VersionedTable, touched: Mapping[str, Mapping]) -> Column:
    """Whether a row lies in one of the partitions ``touched`` (see ``VersionedTable.folders_of``)."""
    keep = F.lit(True)
    for c in table.partition_by:
        values = {v[c] for v in touched.values()}
        known = F.col(c).isin(sorted(v for v in values if v is not None))
        keep = keep & (known | F.col(c).isNull() if None in values else known)
    return keep


def apply_defaults(df: DataFrame, table: str, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Fill absent or NULL defaulted columns: status and the audit timestamps (load time)."""
    defaults: dict[str, Column] = {c: F.lit(v) for c, v in DEFAULTS.get(table, {}).items()}
    defaults.update({c: F.current_timestamp() for c in AUDIT_COLUMNS.get(table, ())})
    defaults.update(extra or {})
    for c, v in defaults.items():
        df = df.withColumn(c, F.coalesce(F.col(c), v) if c in df.columns else v)
    return df


def with_surrogate_keys(df: DataFrame, col: str, start: int | Column = 0, checkpoint: bool = True) -> DataFrame:
    """Dense ids ``start + 1 .. start + n`` without a global ``row_number``.

    ``monotonically_increasing_id`` packs the partition index and the row
    index within the partition; per-partition counts (one row per partition)
    give each partition its offset. ``checkpoint`` first writes ``df`` to the
    shared checkpoint folder so both passes see the same partitions, even if
    executors are lost in between.
    """
    base = df.checkpoint(eager=True) if checkpoint else df
    m = base.withColumn("_m", F.monotonically_increasing_id())
    m = m.withColumn("_p", F.shiftright("_m", 33)).withColumn("_i", F.col("_m").bitwiseAND((1 << 33) - 1))
    counts = m.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_p", F.coalesce(
        F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    s = start if isinstance(start, Column) else F.lit(start)
    return (m.join(F.broadcast(offsets), "_p")
             .withColumn(col, (s + F.col("_off") + F.col("_i") + 1).cast("long"))
             .drop("_m", "_p", "_i", "_off"))


def next_ids(batch: DataFrame, target: DataFrame, col: str, checkpoint: bool = True) -> DataFrame:
    """Surrogate keys for ``batch`` continuing after ``max(col)`` of ``target``."""
    start = F.coalesce(target.select(F.max(col)).scalar(), F.lit(0))
    return with_surrogate_keys(batch, col, start, checkpoint)
