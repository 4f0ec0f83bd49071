"""Sinks: CSV text view, date-partitioned Parquet, run-stamped output paths."""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.sources.clustering import clustered
from fundlens.sources.names import unused_names

CSV_OPTIONS = {
    "header": "true",
    "encoding": "UTF-8",
    "sep": ",",
    "nullValue": "",
    "emptyValue": '""',
    "dateFormat": "yyyy-MM-dd",
}


#: The largest output that may be written by one task.
SINGLE_FILE_ROWS = 2_000_000
#: Rows of a well-sized Parquet file, sorted by one task.
FILE_ROWS = 2_000_000


def output_path(base_dir: str, name: str, append_timestamp: bool = False, now: datetime | None = None) -> str:
    """``base_dir/name`` or ``base_dir/name_YYYYmmdd_HHMMSS``."""
    if append_timestamp:
        name = f"{name}_{(now or datetime.now()).strftime('%Y%m%d_%H%M%S')}"
    return f"{base_dir.rstrip('/')}/{name}"


def write_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> None:
    """Write ``df`` as CSV. NULL is an empty field and an empty string is ``""``.

    The default keeps the partitions: after a global sort each part file is one
    ordered slice, so reading the parts in name order gives the sorted view.
    ``single_file`` funnels the write through one task, so it is refused above
    ``SINGLE_FILE_ROWS`` rows.
    """
    if single_file and (rows := df.limit(SINGLE_FILE_ROWS + 1).count()) > SINGLE_FILE_ROWS:
        raise ValueError(f"{rows} rows or more don't go into a single file: its one task would hold them all")
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite",
                  dynamic: bool = True, files_per_value: int | None = None, sort_by: tuple[str, ...] = (),
                  file_rows: int = FILE_ROWS, cluster_by: tuple[str, ...] = ()) -> None:
    """Columnar output; with ``partition_by`` and ``dynamic`` an overwrite replaces only
    the partitions present in ``df`` (incremental daily loads). ``files_per_value`` is the
    number of files of each partition value; by default it follows from a count of each value's rows (one
    file per ``file_rows`` of them), so no value, however large, is one task's work. ``cluster_by`` writes the files of a
    value along the interleaved order of several columns (``clustering``), so that filters on any of them skip data;
    a task sorts a run of them of up to ``FILE_ROWS`` rows and cuts it into files of ``file_rows``."""
    if cluster_by:
        df = clustered(df, partition_by, cluster_by, _sorted_runs(df, file_rows))
    elif partition_by:
        # Rows of a value meet in a few tasks (``files_per_value``) instead of every task writing a file for it.
        files, columns = F.lit(files_per_value), df.columns
        if files_per_value is None:
            # a row per value of more than one file: at most rows / file_rows
            rows, split, *own = unused_names(columns, 2 + len(partition_by))
            sizes = df.groupBy(*[F.col(c).alias(o) for c, o in zip(partition_by, own, strict=True)]) \
                .agg(F.count(F.lit(1)).alias(rows)).filter(F.col(rows) > file_rows) \
                .withColumn(split, F.ceil(F.col(rows) / file_rows))
            same = [F.col(c).eqNullSafe(F.col(o)) for c, o in zip(partition_by, own, strict=True)]
            df = df.join(F.broadcast(sizes), reduce(and_, same), "left")
            files = F.coalesce(split, F.lit(1))
        df = df.repartition(*[F.col(c) for c in partition_by], F.pmod(F.xxhash64(*columns), files)) \
            .select(*columns).sortWithinPartitions(*partition_by, *sort_by)
    w = df.write.mode(mode)
    if cluster_by:
        w = w.option("maxRecordsPerFile", file_rows)
    if partition_by:
        w = w.partitionBy(*partition_by)
        if dynamic and mode == "overwrite":
            w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def _sorted_runs(df: DataFrame, file_rows: int) -> int:
    """Tasks for a clustered write: a task a file, but no more than shuffle partitions as long as a task gets at most
    ``FILE_ROWS`` rows. A shuffle into one partition for each small file would be made of blocks of a few rows."""
    rows = df.count()
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // FILE_ROWS))
    return min(parts, -(-rows // file_rows))


def write_noop(df: DataFrame) -> None:
    """Run the full plan and discard the rows (benchmarks)."""
    df.write.format("noop").mode("overwrite").save()
