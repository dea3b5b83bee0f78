"""Where the source tables come from: Parquet, CSV or JDBC."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# A source is a function from a table name to its DataFrame.
Source = Callable[[str], DataFrame]


def parquet_source(spark: SparkSession, root: str) -> Source:
    return lambda table: spark.read.parquet(f"{root}/{table}")


def csv_source(spark: SparkSession, root: str, schemas: Mapping[str, str]) -> Source:
    """Headed CSV files with declared schemas (DDL text); nothing is inferred."""
    return lambda table: spark.read.schema(schemas[table]).csv(f"{root}/{table}", header=True)


def frame_source(frames: Mapping[str, DataFrame | Callable[[], DataFrame]]) -> Source:
    def read(table: str) -> DataFrame:
        found = frames[table]
        return found() if callable(found) else found

    return read


@dataclass(frozen=True)
class Split:
    """How one JDBC table is cut into parallel range reads."""

    column: str
    lower: int
    upper: int
    partitions: int


def jdbc_source(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str] | None = None,
    schema: str | None = None,
    splits: Mapping[str, Split] | None = None,
    small: Collection[str] = (),
) -> Source:
    """Live database tables; a table with a ``Split`` is read by many executors at once.

    Without one a single task would read it over a single connection, so it is
    refused unless it is named in ``small``.
    """
    splits = splits or {}

    def read(table: str) -> DataFrame:
        if table not in splits and table not in small:
            raise ValueError(f"no Split for table {table!r}: give one, or name it in small")
        name = f"{schema}.{table}" if schema else table
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", name)
        reader = reader.options(**{"fetchsize": "10000", **dict(properties or {})})
        if table in splits:
            s = splits[table]
            reader = reader.options(
                partitionColumn=s.column, lowerBound=s.lower, upperBound=s.upper, numPartitions=s.partitions
            )
        return reader.load()

    return read
