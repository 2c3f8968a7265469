"""Roll-ups of several facts to one row per entity, without multiplying rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkeeper.functions.calc import flag, guarded_rate


def positive_sum(c: str, digits: int = 2) -> Column:
    """``ROUND(SUM(CASE WHEN c > 0 THEN c ELSE 0 END), digits)``."""
    return F.round(F.sum(F.when(F.col(c) > 0, F.col(c)).otherwise(F.lit(0))), digits)


def pivot_max(kind: str, wanted: str, c: str) -> Column:
    """``MAX(CASE WHEN kind = wanted THEN c END)``."""
    return F.max(F.when(F.col(kind) == wanted, F.col(c)))


def entity_rollup(
    entities: DataFrame, key: str, facts: Sequence[tuple[DataFrame, Sequence[Column]]]
) -> DataFrame:
    """Entities with aggregates of each fact; entities without facts stay, with NULL.

    Each fact is aggregated to one row per key before the join. Joining the raw facts to each
    other first would repeat every row of one fact for every row of the other.
    """
    out = entities
    for fact, aggs in facts:
        out = out.join(fact.groupBy(key).agg(*aggs), key, "left")
    return out


def referral_rollup(
    providers: DataFrame,
    entities: DataFrame,
    provider_key: str,
    referring: str,
    entity_key: str,
    active: Column,
    unique_entities: bool = True,
) -> DataFrame:
    """Providers with ``patients_referred``, ``active_placements`` and the rounded share.

    Providers without referrals stay, with zero counts and a NULL share. ``unique_entities`` says
    that a provider has one row per entity. Otherwise the rows are first reduced to one per
    provider and entity, which counts each entity once without expanding every row for the two
    distinct counts.
    """
    referred = entities.filter(F.col(referring).isNotNull()).select(
        F.col(referring).alias(provider_key),
        F.col(entity_key).alias("_entity"),
        flag(active).alias("_active"),
    )
    if not unique_entities:
        referred = referred.groupBy(provider_key, "_entity").agg(F.max("_active").alias("_active"))
    per_provider = referred.groupBy(provider_key).agg(
        F.count("_entity").alias("_referred"),
        F.count(F.when(F.col("_active"), F.col("_entity"))).alias("_placed"),
    )
    count, placed = (F.coalesce(F.col(c), F.lit(0)) for c in ("_referred", "_placed"))
    return providers.join(per_provider, provider_key, "left").select(
        *providers.columns,
        count.alias("patients_referred"),
        placed.alias("active_placements"),
        guarded_rate(placed, count).alias("placement_success_rate"),
    )


def fanout_check(entities: DataFrame, key: str, facts: Sequence[DataFrame]) -> DataFrame:
    """Rows before and after a left join of all facts, and their quotient.

    The joined rows are counted from the row counts per key; the join itself is not carried out.
    """
    out = entities.select(key)
    joined = F.lit(1).cast("bigint")
    for i, fact in enumerate(facts):
        out = out.join(fact.groupBy(key).agg(F.count(F.lit(1)).alias(f"_n{i}")), key, "left")
        joined = joined * F.coalesce(F.col(f"_n{i}"), F.lit(1))
    return out.agg(
        F.count(F.lit(1)).alias("rows_before"), F.sum(joined).cast("bigint").alias("rows_after")
    ).select(
        "rows_before",
        "rows_after",
        F.round(F.try_divide(F.col("rows_after").cast("double"), F.col("rows_before")), 4).alias(
            "fanout"
        ),
    )
