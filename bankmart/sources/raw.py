"""Readers for the five raw source tables and the customer seed file."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankmart.sources import schemas


@dataclass(frozen=True)
class RawTables:
    """The landed raw tables, as lazy DataFrames.

    ``relations`` names them in SQL text (catalog tables or parquet.`folder`); None for tables
    that exist as plans only, over which no catalog view can be made. ``lenient``: bad values became nulls.
    """

    customers: DataFrame
    accounts: DataFrame
    transactions: DataFrame
    loans: DataFrame
    credit_cards: DataFrame
    relations: Mapping[str, str] | None = None
    lenient: bool = False

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(name, getattr(self, name)) for name in schemas.RAW_SCHEMAS]

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)


def _conform(df: DataFrame, name: str, lenient: bool = False) -> DataFrame:
    """Select the declared columns in order, cast to the declared types.

    The cast is a no-op for data landed with the declared types (then Parquet
    filters on these columns still push down). By default it is the plain
    (ANSI) cast, so a bad value fails the run rather than silently turning
    into a null; ``lenient=True`` uses ``try_cast`` instead (bad values
    become nulls, which the not_null tests then report).
    """
    schema = schemas.RAW_SCHEMAS[name]
    cast = (lambda c, t: c.try_cast(t)) if lenient else (lambda c, t: c.cast(t))
    return df.select([cast(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


def read_parquet(spark: SparkSession, root: str) -> RawTables:
    """Raw tables landed as Parquet folders ``<root>/<table>``."""
    return RawTables(**{
        name: spark.read.schema(schema).parquet(f"{root}/{name}")
        for name, schema in schemas.RAW_SCHEMAS.items()
    }, relations={name: f"parquet.`{root.replace('`', '``')}/{name}`" for name in schemas.RAW_SCHEMAS})


def read_catalog(spark: SparkSession, database: str = schemas.SOURCE_NAME,
                 lenient: bool = False) -> RawTables:
    """Raw tables registered in the catalog as ``<database>.<table>``."""
    return RawTables(**{
        name: _conform(spark.table(f"{database}.{name}"), name, lenient)
        for name in schemas.RAW_SCHEMAS
    }, relations={name: f"{database}.{name}" for name in schemas.RAW_SCHEMAS}, lenient=lenient)


def from_frames(lenient: bool = False, **frames: DataFrame) -> RawTables:
    """Wrap already-built DataFrames, conforming them to the raw schemas."""
    return RawTables(**{name: _conform(df, name, lenient) for name, df in frames.items()})


FEWEST_ROWS_PER_FILE, ROWS_PER_FILE = 20_000, 4_000_000


def rows_per_file(df: DataFrame) -> int:
    """Rows of a landed file: several files per core while tables are small, large files beyond.

    The count reads no column, for Parquet its footers only.
    """
    files = 4 * df.sparkSession.sparkContext.defaultParallelism
    return min(max(-(-df.count() // files), FEWEST_ROWS_PER_FILE), ROWS_PER_FILE)


def land(tables: RawTables, root: str) -> RawTables:
    """Write the raw tables as Parquet folders ``<root>/<table>`` and read them back.

    The landing step of a raw load: later reads are plain Parquet scans
    (filters on the raw columns push down, splits run in parallel) instead
    of recomputing whatever produced ``tables``. Nothing is shuffled for it: each
    task writes what it read, in files of up to ``rows_per_file`` rows, so that
    later scans are split although one task may have read much. ``root``
    must be a fresh or disposable folder on storage every executor can read.
    """
    spark = tables.customers.sparkSession
    for name, df in tables.items():
        df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file(df)).parquet(f"{root}/{name}")
    return read_parquet(spark, root)


def read_seed_customers(spark: SparkSession, path: str) -> DataFrame:
    """The customer seed CSV (header row), typed like the raw customers table.

    A row that does not parse, or a header that does not name the declared
    columns in order, fails the run.
    """
    seed = spark.read.schema(schemas.SEED_CUSTOMERS).option("header", True) \
        .option("mode", "FAILFAST").option("enforceSchema", False).csv(path)
    return _conform(seed, "customers")


def write_seed(df: DataFrame, table: str, mode: str = "overwrite") -> None:
    """Load a seed as a table (full replace)."""
    df.write.mode(mode).saveAsTable(table)
