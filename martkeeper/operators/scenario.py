"""What-if reweighting of a measure across categories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def shift_share(
    rows: DataFrame,
    category: str,
    revenue: str,
    margin: str,
    source: str,
    target: str,
    share: float,
    moved: Column,
) -> DataFrame:
    """Blended margin before and after ``share`` of the moved volume goes to another category.

    ``moved`` selects the rows whose volume shifts; those of category ``source`` keep
    ``1 - share`` of their weight, and the rest earns the mean margin rate of the ``target`` rows.
    The rows are summed per category and selection first, so the shift works on a handful of sums
    rather than on copies of the rows. A projection, not a recorded outcome.
    """
    rev, mar = F.col("rev"), F.col("mar")
    sums = rows.groupBy(
        F.col(category).alias("category"), F.coalesce(moved, F.lit(False)).alias("moved")
    ).agg(F.sum(revenue).cast("double").alias("rev"), F.sum(margin).cast("double").alias("mar"))
    leaving = F.col("moved") & (F.col("category") == source)
    arriving = F.col("category") == target
    totals = sums.agg(
        F.sum(rev).alias("rev"),
        F.sum(mar).alias("mar"),
        F.coalesce(F.sum(F.when(leaving, rev)), F.lit(0.0)).alias("out_rev"),
        F.coalesce(F.sum(F.when(leaving, mar)), F.lit(0.0)).alias("out_mar"),
        F.sum(F.when(arriving, rev)).alias("in_rev"),
        F.sum(F.when(arriving, mar)).alias("in_mar"),
    )
    moved_rev = F.col("out_rev") * share
    new_margin = (
        mar - F.col("out_mar") * share + moved_rev * F.try_divide(F.col("in_mar"), F.col("in_rev"))
    )
    return totals.select(
        F.round(moved_rev, 2).alias("moved_revenue"),
        F.round(F.try_divide(mar, rev) * 100, 4).alias("margin_pct_before"),
        F.round(F.try_divide(new_margin, rev) * 100, 4).alias("margin_pct_after"),
        F.round(new_margin - mar, 2).alias("margin_change"),
    )
