"""File sources: the star schema from Parquet, the flat view from CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens import schemas
from fundlens.model import Star

STAR_TABLES = ("fundo", "ativo", "emissor", "posicao_carteira", "preco_mercado", "operacao")


def read_star_parquet(spark: SparkSession, root: str, with_trades: bool = True) -> Star:
    """Star schema stored as one Parquet folder per table under ``root``."""
    def read(name: str) -> DataFrame:
        return schemas.conform(spark.read.parquet(f"{root.rstrip('/')}/{name}"), schemas.TABLES[name])

    return Star(fundo=read("fundo"), ativo=read("ativo"), emissor=read("emissor"),
                posicao=read("posicao_carteira"), preco=read("preco_mercado"),
                operacao=read("operacao") if with_trades else None)


# Reader-side NULL marker: an unquoted empty field reads as NULL and a quoted
# empty field ("") as an empty string, as the writer distinguishes them.
_READ_NULL = "\u0000"


def read_flat_csv(spark: SparkSession, path: str) -> DataFrame:
    """The text flat view (19 string columns, header) with a declared schema, no inference."""
    return (spark.read.schema(schemas.FLAT_STRING).option("header", True).option("encoding", "UTF-8")
            .option("nullValue", _READ_NULL).option("mode", "FAILFAST").csv(path))


def newest_run(spark: SparkSession, root: str, pattern: str = "part-*.csv") -> str:
    """Folder holding the most recently modified file matching ``pattern`` under ``root``.

    The listing is a ``binaryFile`` scan with only path and time selected (file
    contents are not read); a ``max_by`` aggregate returns a single row.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", pattern).load(root).select("path", "modificationTime"))
    row = files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("p")).first()
    if row is None or row["p"] is None:
        raise FileNotFoundError(f"no {pattern} under {root}")
    return row["p"].rsplit("/", 1)[0]


def read_newest_flat_csv(spark: SparkSession, root: str) -> DataFrame:
    """The flat view of the newest run written under ``root``."""
    return read_flat_csv(spark, newest_run(spark, root))
