"""JDBC source: partitioned, schema-conformed table reads.

A plain JDBC read is one partition and one connection. ``read_table`` splits
the scan on a numeric column into ``num_partitions`` range queries (bounds
from one ``min/max`` query the database answers from its index), so the
extract scales with the executors. Filters and column selections placed on
the returned DataFrame are pushed into the generated SQL by Spark.
``read_balanced`` cuts the ranges by row counts per key interval, which the database
gives, so gaps and clustered ids do not make one large partition.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fundlens.schemas import conform

POSTGRES_DRIVER = "org.postgresql.Driver"


def postgres_url(host: str, port: int, database: str, schema: str | None = None,
                 app_name: str = "fundlens", socket_timeout: int = 300, connect_timeout: int = 30) -> str:
    params = [f"ApplicationName={app_name}", f"socketTimeout={socket_timeout}",
              f"connectTimeout={connect_timeout}"]
    if schema:
        params.append(f"currentSchema={schema}")
    return f"jdbc:postgresql://{host}:{port}/{database}?" + "&".join(params)


@dataclass(frozen=True)
class JdbcSource:
    url: str
    driver: str = POSTGRES_DRIVER
    user: str | None = None
    password: str | None = None
    schema: str | None = None
    fetch_size: int = 10_000
    options: dict[str, str] = field(default_factory=dict)

    def _qualified(self, table: str) -> str:
        return f"{self.schema}.{table}" if self.schema and "." not in table else table

    def _reader(self, spark: SparkSession, dbtable: str):
        r = (spark.read.format("jdbc").option("url", self.url).option("driver", self.driver)
             .option("dbtable", dbtable).option("fetchsize", str(self.fetch_size)))
        if self.user is not None:
            r = r.option("user", self.user)
        if self.password is not None:
            r = r.option("password", self.password)
        for k, v in self.options.items():
            r = r.option(k, v)
        return r

    def bounds(self, spark: SparkSession, table: str, column: str) -> tuple[int | None, int | None]:
        """``min`` and ``max`` of ``column`` (one single-row query)."""
        q = f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {self._qualified(table)}) b"
        row = self._reader(spark, q).load().first()
        return (row["LO"] if "LO" in row else row["lo"], row["HI"] if "HI" in row else row["hi"])

    def key_cells(self, spark: SparkSession, table: str, column: str, num_partitions: int) -> list[tuple[int, int, int]]:
        """Ascending ``(first, end, rows)`` intervals of an integer column, none with rows in it left out, each with at most
        half a partition's share of the rows or of one value only. The database counts them: once
        over the whole range, then again inside each interval that holds too many (fewer than twice ``num_partitions``)."""
        lo, hi = self.bounds(spark, table, column)
        if lo is None:
            return []
        name, fan = self._qualified(table), max(256, 8 * num_partitions)

        def counted(first: int, end: int) -> list[tuple[int, int, int]]:
            width = -(-(end - first) // fan)
            offset = f"({column} - ({first}))"
            q = (f"(SELECT b, COUNT(*) AS n FROM (SELECT ({offset} - MOD({offset}, {width})) / {width} AS b FROM {name} "
                 f"WHERE {column} >= {first} AND {column} < {end}) c GROUP BY b) h")
            rows = sorted((int(r[0]), int(r[1])) for r in self._reader(spark, q).load().collect())
            return [(first + b * width, min(first + (b + 1) * width, end), n) for b, n in rows]

        cells = counted(int(lo), int(hi) + 1)
        share = max(1, sum(n for *_, n in cells) // (2 * num_partitions))
        while any(n > share and end - first > 1 for first, end, n in cells):
            cells = [c for first, end, n in cells
                     for c in (counted(first, end) if n > share and end - first > 1 else [(first, end, n)])]
        return cells

    def balanced_predicates(self, spark: SparkSession, table: str, column: str, num_partitions: int) -> list[str]:
        """Range conditions that cover every row of ``table`` once, the largest with at most twice the mean of the rows
        (unless one value holds more), however the keys are clustered. Rows without a key join the first range."""
        cells = self.key_cells(spark, table, column, num_partitions)
        share = -(-sum(n for *_, n in cells) // num_partitions)
        cuts, rows = [], 0
        for first, _, n in cells:
            if rows and rows + n > share:
                cuts.append(first)
                rows = 0
            rows += n
        ends = [None, *cuts, None]
        ranges = [" AND ".join([f"{column} >= {a}"] * (a is not None) + [f"{column} < {b}"] * (b is not None)) or "1 = 1"
                  for a, b in zip(ends, ends[1:], strict=False)]
        return [f"({ranges[0]}) OR {column} IS NULL", *ranges[1:]]

    def read_balanced(self, spark: SparkSession, table: str, column: str, num_partitions: int,
                      schema: T.StructType | None = None) -> DataFrame:
        """``read_table`` in range queries cut by counts of the keys (``balanced_predicates``) instead of equal widths."""
        properties = {"driver": self.driver, "fetchsize": str(self.fetch_size), **self.options}
        if self.user is not None:
            properties["user"] = self.user
        if self.password is not None:
            properties["password"] = self.password
        df = spark.read.jdbc(self.url, self._qualified(table), properties=properties,
                             predicates=self.balanced_predicates(spark, table, column, num_partitions))
        return _conformed(df, schema)

    def read_table(self, spark: SparkSession, table: str, schema: T.StructType | None = None,
                   partition_column: str | None = None, num_partitions: int = 1,
                   lower_bound: int | None = None, upper_bound: int | None = None) -> DataFrame:
        """Read ``table``; with ``partition_column`` and ``num_partitions > 1`` the scan
        is split into that many range queries. ``schema`` projects and casts."""
        r = self._reader(spark, self._qualified(table))
        if partition_column and num_partitions > 1:
            if lower_bound is None or upper_bound is None:
                lo, hi = self.bounds(spark, table, partition_column)
                lower_bound = lo if lower_bound is None else lower_bound
                upper_bound = hi if upper_bound is None else upper_bound
            if lower_bound is not None and upper_bound is not None and upper_bound > lower_bound:
                r = (r.option("partitionColumn", partition_column)
                      .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                      .option("numPartitions", str(num_partitions)))
        return _conformed(r.load(), schema)


def _conformed(df: DataFrame, schema: T.StructType | None) -> DataFrame:
    # Some databases report upper-case names; match the declared ones case-insensitively.
    if schema is not None:
        lower = {c.lower(): c for c in df.columns}
        df = df.select(*[df[lower[f.name.lower()]].alias(f.name) for f in schema.fields if f.name.lower() in lower])
        df = conform(df, schema)
    return df
