"""Milestones: first or last date of a kind per entity, cycle times, month offsets.

An entity's milestones are aggregated before they meet its facts. A self-join would multiply rows
for entities with several milestones of a kind, and a window over the entity would bring all rows
of a large entity into one task; the aggregate is combined on the map side, and the join back is
one that adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkeeper.functions.calc import month_offset
from martkeeper.operators.joins import attach


def milestone_dates(
    facts: DataFrame,
    key: str,
    kind: str,
    at: str,
    first: Mapping[str, str] | None = None,
    last: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per entity that has any of the kinds.

    ``first`` and ``last`` map an output column to the kind whose earliest or latest date it
    holds. Only rows of these kinds are read.
    """
    first, last = dict(first or {}), dict(last or {})
    kinds = sorted({*first.values(), *last.values()})
    picked = {
        **{out: F.min(F.when(F.col(kind) == k, F.col(at))) for out, k in first.items()},
        **{out: F.max(F.when(F.col(kind) == k, F.col(at))) for out, k in last.items()},
    }
    return (
        facts.filter(F.col(kind).isin(kinds))
        .groupBy(key)
        .agg(*[agg.alias(out) for out, agg in picked.items()])
    )


def cycle_times(
    facts: DataFrame, key: str, kind: str, at: str, start: str, end: str
) -> DataFrame:
    """Days from the first ``start`` to the first ``end``, for entities that have both."""
    dates = milestone_dates(facts, key, kind, at, first={"start_date": start, "end_date": end})
    return dates.filter("start_date IS NOT NULL AND end_date IS NOT NULL").withColumn(
        "cycle_days", F.datediff("end_date", "start_date")
    )


def cycle_time_by(cycles: DataFrame, *groups: str, digits: int = 0) -> DataFrame:
    """Rounded mean cycle time and number of entities per group."""
    return cycles.groupBy(*groups).agg(
        F.round(F.avg("cycle_days"), digits).alias("avg_days"), F.count(F.lit(1)).alias("entities")
    )


def with_cycle_time(
    facts: DataFrame,
    milestones: DataFrame,
    key: str,
    start: str = "start_date",
    end: str = "end_date",
    out: str = "days_to_end",
) -> DataFrame:
    """Every fact with the cycle time of its entity, NULL where a milestone is missing."""
    timed = milestones.select(key, F.datediff(end, start).alias(out))
    return attach(facts, timed, [key])


def with_month_offset(
    facts: DataFrame,
    key: str,
    kind: str,
    at: str,
    anchor: str,
    counted: Sequence[str],
    out: str = "month_offset",
) -> DataFrame:
    """Months from the entity's latest ``anchor`` milestone: 0 on the milestone itself.

    Facts of the ``counted`` kinds get the calendar-month difference, others NULL.
    """
    anchors = milestone_dates(facts, key, kind, at, last={"_anchor_date": anchor})
    offset = (
        F.when(F.col(kind) == anchor, F.lit(0))
        .when(F.col(kind).isin(list(counted)), month_offset(at, "_anchor_date"))
        .alias(out)
    )
    return attach(facts, anchors, [key], null_safe=True).select(*facts.columns, offset)
