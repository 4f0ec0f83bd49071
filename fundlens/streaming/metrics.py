"""Metrics of streaming queries, batch by batch, in the shape of the job's metrics frame."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

SHAPE = "consulta string, lote long, grupo string, nome string, valor double"


class BatchMetrics(StreamingQueryListener):
    """Keeps the row counts and times of each micro-batch of the queries that run while it is registered
    (``spark.streams.addListener``). ``frame`` gives what was kept since the last ``append``, which adds
    it to a Parquet table; the listener holds numbers of a batch only, some twenty a batch."""

    def __init__(self, names: tuple[str, ...] | None = None):
        self.names = names
        self.rows: list[tuple] = []
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self.names is not None and p.name not in self.names:
            return
        found = [("linhas", "entrada", p.numInputRows)]
        found += [("linhas", f"fonte_{i}", s.numInputRows) for i, s in enumerate(p.sources)]
        found += [("segundos", k, v / 1000) for k, v in p.durationMs.items()]
        with self.lock:
            self.rows += [(p.name, p.batchId, group, name, float(value)) for group, name, value in found]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def frame(self, spark: SparkSession) -> DataFrame:
        """``consulta, lote, grupo, nome, valor`` of the batches seen."""
        with self.lock:
            return spark.createDataFrame(list(self.rows), SHAPE)

    def append(self, spark: SparkSession, path: str) -> int:
        """Add the batches seen so far to the metrics table at ``path`` and forget them; the number of rows."""
        with self.lock:
            rows, self.rows = self.rows, []
        if rows:
            spark.createDataFrame(rows, SHAPE).coalesce(1).write.mode("append").parquet(path)
        return len(rows)
