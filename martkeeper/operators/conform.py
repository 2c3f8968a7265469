"""Conforming: one row per key, categories, derived attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkeeper.operators.joins import attach
from martkeeper.sources.stored import staged


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = ("_loaded_at",),
    tiebreak: Sequence[str] | None = None,
    by_digest: bool = False,
) -> DataFrame:
    """Keep the newest row per key.

    ``order_by`` is taken descending with NULLs last. Rows that tie there (all rows of one batch
    do) are ordered by ``tiebreak``, by default every other column ascending, so the survivor does
    not depend on the order in which rows arrive. Columns that cannot be ordered need an explicit
    ``tiebreak``.

    Spark turns the ``row number = 1`` filter into a limit per key on the map side, so a key with
    a large share of the rows sends one row per map task through the shuffle. ``by_digest`` groups
    by the SHA-256 of the whole key, so wide keys such as texts are not shuffled or sorted.
    """
    rest = tiebreak if tiebreak is not None else _others(df, [*keys, *order_by])
    order: list[Column] = [F.desc_nulls_last(c) for c in order_by]
    order += [F.asc_nulls_last(c) for c in rest]
    if by_digest:
        group = [g for k in keys for g in (F.sha2(F.col(k).cast("string"), 256), F.isnull(k))]
    else:
        group = [F.col(k) for k in keys]
    spec = Window.partitionBy(*group).orderBy(*(order or [F.asc(keys[0])]))
    return df.withColumn("_rn", F.row_number().over(spec)).filter("_rn = 1").drop("_rn")


FILE, ROW = "_file", "_row"


def dedup_stored(
    table: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = ("_loaded_at",),
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """:func:`dedup_latest` of a table read from files, with columns fetched late.

    The rows that go are found from the keys and ``order_by`` alone and named by file and row number.
    Only where several rows of a key have its newest values are whole rows compared, those rows and no
    others. The result is the table without the named rows: whatever uses it reads the columns it
    needs, and as few rows go, they are usually broadcast, so the table itself isn't shuffled.
    A key with many rows is never sorted in one task.
    """
    place = {FILE: F.col("_metadata.file_path"), ROW: F.col("_metadata.row_index")}
    newest = F.struct(
        *[f for c in order_by for f in (F.col(c).isNotNull().alias(f"_has_{c}"), F.col(c))]
    ) if order_by else F.lit(0)
    narrow = staged(
        table.select(
            *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
            newest.alias("_newest"),
            *[c.alias(n) for n, c in place.items()],
        ),
        "dedup-rows",
    )
    own = [f"_k{i}" for i in range(len(keys))]
    top = narrow.groupBy(*own).agg(F.max("_newest").alias("_top"), F.count(F.lit(1)).alias("_n"))
    several = staged(top.filter("_n > 1").select(*own, "_top"), "dedup-keys")
    matched = attach(narrow, several, own, "inner", null_safe=True)
    older = matched.filter(~F.col("_newest").eqNullSafe(F.col("_top")))
    level = matched.filter(F.col("_newest").eqNullSafe(F.col("_top")))
    tied = attach(
        level, level.groupBy(*own).agg(F.count(F.lit(1)).alias("_m")), own, null_safe=True
    ).filter("_m > 1")
    tied = staged(tied.select(FILE, ROW), "dedup-ties")
    rows = table.withColumns(place).join(tied, [FILE, ROW], "left_semi")
    rest = tiebreak if tiebreak is not None else _others(table, [*keys, *order_by])
    best = dedup_latest(rows, keys, order_by, rest).select(FILE, ROW)
    gone = staged(
        older.select(FILE, ROW).union(tied.join(best, [FILE, ROW], "left_anti")), "dedup-gone"
    )
    kept = table.withColumns(place).join(gone, [FILE, ROW], "left_anti")
    return kept.select(*table.columns)


def _others(df: DataFrame, used: Sequence[str]) -> list[str]:
    taken = {c.lower() for c in used}
    return [c for c in df.columns if c.lower() not in taken]
