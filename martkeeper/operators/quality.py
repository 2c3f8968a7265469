"""Data-quality checks. Each returns a small DataFrame instead of printing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def grain_check(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(table, row_count, unique_keys, grain_ok), one aggregate per table.

    As with a distinct count of several columns, keys with a NULL part are not counted.
    """
    out = None
    for name, (df, keys) in tables.items():
        checked = df.agg(
            F.count(F.lit(1)).alias("row_count"), F.count_distinct(*keys).alias("unique_keys")
        ).select(
            F.lit(name).alias("table_name"),
            "row_count",
            "unique_keys",
            (F.col("row_count") == F.col("unique_keys")).alias("grain_ok"),
        )
        out = checked if out is None else out.unionByName(checked)
    return out


def completeness(df: DataFrame, *columns: str) -> DataFrame:
    """(column, row_count, present, complete) in one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("row_count"), *[F.count(c).alias(f"_{c}") for c in columns]
    )
    per_column = F.explode(
        F.array(
            *[F.struct(F.lit(c).alias("c"), F.col(f"_{c}").alias("present")) for c in columns]
        )
    )
    return counted.select("row_count", per_column.alias("e")).select(
        F.col("e.c").alias("column_name"),
        "row_count",
        F.col("e.present").alias("present"),
        (F.col("e.present") == F.col("row_count")).alias("complete"),
    )


def distribution(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value of a category."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))


def distributions(df: DataFrame, *columns: str) -> DataFrame:
    """(column, value, row_count) of several categories in one pass over the table.

    Rows are counted per combination of values first, in the tasks that read them, so what is
    expanded to one row per column are combinations and not rows.
    """
    combined = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                for c in columns
            ]
        )
    )
    return combined.select(pairs.alias("e"), "_n").groupBy("e.column_name", "e.value").agg(
        F.sum("_n").alias("row_count")
    )


def row_totals(tables: Mapping[str, tuple[DataFrame, int | Column]]) -> DataFrame:
    """(table, row_count, expected, as_expected)."""
    out = None
    for name, (df, expected) in tables.items():
        checked = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(expected).cast("bigint").alias("expected"),
            (F.col("row_count") == expected).alias("as_expected"),
        )
        out = checked if out is None else out.unionByName(checked)
    return out


def level_order(levels: DataFrame, group: str, value: str, expected: Sequence[str]) -> DataFrame:
    """Add the rank of each group by ascending value and whether it is the expected one.

    ``levels`` has one row per group (a handful of rows), so the global rank is cheap.
    """
    place: Column = F.array_position(F.array(*[F.lit(e) for e in expected]), F.col(group))
    rank = F.row_number().over(Window.orderBy(F.asc(value), F.asc(group)))
    return levels.select("*", rank.alias("rank")).withColumn(
        "as_expected", F.col("rank") == place
    )
