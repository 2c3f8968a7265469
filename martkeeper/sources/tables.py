"""Named tables: parquet folders, catalog tables and DataFrames behind one lookup."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REGISTRY_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("type", T.StringType(), False),
        T.StructField("certified", T.BooleanType(), False),
    ]
)


def scan_parquet(
    spark: SparkSession, folder: str, name: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Scan ``folder/name.parquet``, optionally naming the columns."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


@dataclass
class ParquetFolder:
    """A folder of parquet tables. A table's files are listed once, however often it is scanned."""

    spark: SparkSession
    folder: str
    _tables: dict[str, DataFrame] = field(default_factory=dict)

    def scan(self, name: str, columns: Sequence[str] | None = None) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = scan_parquet(self.spark, self.folder, name)
        df = self._tables[name]
        return df.select(*columns) if columns else df


def scan_table(spark: SparkSession, *parts: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Scan a catalog table by its parts, such as ``scan_table(spark, catalog, schema, name)``."""
    df = spark.table(qualified(*parts))
    return df.select(*columns) if columns else df


def qualified(*parts: str) -> str:
    """Back-quoted qualified name; empty parts are left out."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts if p)


def evaluate(spark: SparkSession, **expressions: Column) -> DataFrame:
    """One row with the given expressions: a SELECT without FROM."""
    return spark.range(1).select(*[e.alias(n) for n, e in expressions.items()])


def local_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Small control data with an explicit schema. Bulk data is generated in Spark instead."""
    return spark.createDataFrame(list(rows), schema)


@dataclass
class TableRegistry:
    """Name to DataFrame. Entries built by a function are resolved when first asked for."""

    spark: SparkSession
    _entries: dict[str, DataFrame | Callable[[], DataFrame]] = field(default_factory=dict)
    _kinds: dict[str, str] = field(default_factory=dict)
    _certified: dict[str, bool] = field(default_factory=dict)

    def put(
        self,
        name: str,
        source: DataFrame | Callable[[], DataFrame],
        certified: bool = True,
        kind: str = "TABLE",
    ) -> None:
        """Define or replace an entry."""
        self._entries[name] = source
        self._kinds[name] = kind
        self._certified[name] = certified

    def get(self, name: str) -> DataFrame:
        if name not in self._entries:
            raise KeyError(f"unknown table: {name}")
        source = self._entries[name]
        if not isinstance(source, DataFrame):
            source = source()
            self._entries[name] = source
        return source

    def is_certified(self, name: str) -> bool:
        if name not in self._certified:
            raise KeyError(f"unknown table: {name}")
        return self._certified[name]

    def drop(self, name: str) -> None:
        for store in (self._entries, self._kinds, self._certified):
            store.pop(name, None)

    def names(self) -> list[str]:
        return sorted(self._entries)

    def describe(self) -> DataFrame:
        """(name, type, certified) of every entry."""
        rows = [(n, self._kinds[n], self._certified[n]) for n in self.names()]
        return local_rows(self.spark, rows, REGISTRY_SCHEMA)


def table_type(spark: SparkSession, name: str) -> DataFrame:
    """The ``Type`` row of ``DESCRIBE TABLE EXTENDED`` for a catalog table."""
    return spark.sql(f"DESCRIBE TABLE EXTENDED {qualified(*name.split('.'))}").filter(F.col("col_name") == "Type")
