"""Period analytics: calendar columns, monthly sums, running totals, growth."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkeeper.functions.calc import growth_pct, month_start, quarter_num, year_num
from martkeeper.operators.joins import attach
from martkeeper.sources.stored import staged


def with_calendar(df: DataFrame, at: str) -> DataFrame:
    """Add ``quarter_num`` and ``year_num``."""
    return df.select("*", quarter_num(at).alias("quarter_num"), year_num(at).alias("year_num"))


def monthly_sums(
    facts: DataFrame, keys: Sequence[str], at: str, sums: Mapping[str, str | Column]
) -> DataFrame:
    """Sums per key and calendar month; combined on the map side."""
    aggs = [F.sum(c).alias(out) for out, c in sums.items()]
    return facts.groupBy(*keys, month_start(at).alias("month")).agg(*aggs)


# Rows of one key that a single task may hold in a window; a key with more is split over tasks.
WINDOW_ROWS = 1_000_000
PART = "_part"


def _largest_key(df: DataFrame, keys: Sequence[str]) -> int:
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]


def split_by_range(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The rows with ``_part``: ranges of key and order, even in rows, so a large key has several.

    Spark samples the ranges and deals the rows; the result is written, which fixes the parts.
    Rows with equal key and order are in one part.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *[F.col(k) for k in keys], F.col(order))
    return staged(dealt.withColumn(PART, F.spark_partition_id()), "ranges")


def _prefix_sums(
    df: DataFrame, keys: Sequence[str], order: str, totals: Mapping[str, str]
) -> DataFrame:
    """Running sums on two levels: within a part of a key, plus the totals of its earlier parts.

    ``df`` comes from :func:`split_by_range`. No task holds more of a key than one part.
    """
    part = [*keys, PART]
    inside = Window.partitionBy(*part).orderBy(order)
    per_part = df.groupBy(*part).agg(*[F.sum(c).alias(f"_t_{out}") for out, c in totals.items()])
    before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select(*part, *[F.sum(f"_t_{out}").over(before).alias(f"_t_{out}") for out in totals])
    summed = df.select("*", *[F.sum(c).over(inside).alias(out) for out, c in totals.items()])
    joined = attach(summed, offsets, part, null_safe=True)
    types = {out: summed.schema[out].dataType for out in totals}
    whole = {
        out: F.coalesce(F.col(out) + F.col(f"_t_{out}"), out, f"_t_{out}").cast(types[out])
        for out in totals
    }
    return joined.withColumns(whole).drop(PART, *[f"_t_{out}" for out in totals])


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    totals: Mapping[str, str],
    one_row_per_period: bool = True,
) -> DataFrame:
    """Running sum per key in the default frame: rows with an equal ``order`` share a total.

    With one row per key and period (the grain of a monthly table) a key has at most as many rows
    as the calendar has periods, so the window is bounded. Otherwise the rows are first summed
    per key and period, the sums are written, and the totals are joined back: the result is the same,
    and a key with many rows is never sorted in one task. If a key has more than ``WINDOW_ROWS``
    periods, such as instants, the running sums are formed on two levels over ranges of the key.
    """
    spec = Window.partitionBy(*keys).orderBy(order)
    if one_row_per_period:
        return df.select("*", *[F.sum(c).over(spec).alias(out) for out, c in totals.items()])
    sums = {out: f"_sum_{out}" for out in totals}
    per_period = staged(
        df.groupBy(*keys, order).agg(*[F.sum(c).alias(sums[out]) for out, c in totals.items()]),
        "periods",
    )
    if _largest_key(per_period, keys) > WINDOW_ROWS:
        running = _prefix_sums(split_by_range(per_period, keys, order), keys, order, sums)
    else:
        running = per_period.select(
            "*", *[F.sum(c).over(spec).alias(out) for out, c in sums.items()]
        )
    return attach(df, running.select(*keys, order, *totals), [*keys, order], null_safe=True)


def with_growth(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    out: str,
    previous_out: str | None = None,
    split: bool = False,
) -> DataFrame:
    """Percent growth over the previous row of the key, two digits.

    The table has one row per key and period; a second row for a period is an error when its growth
    is computed. The predecessor is the previous row, which is the previous period only where no
    period is missing. ``split`` is for keys with more rows than one task should hold: the key is cut
    into ranges, and the last row of a range is carried over to the next one.
    """
    if split:
        rows, previous, last = _carried(df, keys, order, value)
    else:
        spec = Window.partitionBy(*keys).orderBy(order)
        rows, previous, last = df, F.lag(value).over(spec), F.lag(F.struct(order)).over(spec)
    marked = rows.select("*", previous.alias("_previous"), last.alias("_last"))
    twice = F.col("_last").isNotNull() & F.col(f"_last.{order}").eqNullSafe(F.col(order))
    error = F.raise_error(F.lit(f"two rows of a key for one {order}")).cast("boolean")
    checked = F.when(twice, error).otherwise(F.lit(True))
    added = [F.when(checked, growth_pct(value, F.col("_previous"))).alias(out)]
    if previous_out:
        added.append(F.col("_previous").alias(previous_out))
    return marked.select(*df.columns, *added)


def _carried(df: DataFrame, keys: Sequence[str], order: str, value: str):
    """(rows, previous value, previous order) where a key's rows are spread over ranges."""
    parts = split_by_range(df, keys, order)
    part = [*keys, PART]
    ends = parts.groupBy(*part).agg(
        F.max_by(F.struct(F.col(order), F.col(value)), F.struct(F.col(order).isNotNull(), order)).alias("_end")
    )
    carry = F.lag("_end").over(Window.partitionBy(*keys).orderBy(PART)).alias("_carry")
    rows = attach(parts, ends.select(*part, carry), part, null_safe=True)
    spec = Window.partitionBy(*part).orderBy(order)
    first = F.row_number().over(spec) == 1
    previous = F.when(first, F.col(f"_carry.{value}")).otherwise(F.lag(value).over(spec))
    last = F.when(first, F.when(F.col("_carry").isNotNull(), F.struct(F.col(f"_carry.{order}").alias(order))))
    return rows, previous, last.otherwise(F.lag(F.struct(order)).over(spec))
