"""Bronze, silver and gold layers as functions from DataFrames to DataFrames.

:func:`build` composes them lazily: Catalyst gets one plan per requested output, in which unused
columns and joins disappear. :func:`materialize` writes every layer instead, which is what a
deployment does before many questions read the gold tables.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date, datetime
from functools import cached_property
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkeeper.functions.calc import (
    age_years,
    categorize,
    flag,
    lifecycle_status,
    ratio,
)
from martkeeper.operators.conform import dedup_latest
from martkeeper.operators.joins import attach
from martkeeper.operators.milestones import milestone_dates, with_month_offset
from martkeeper.operators.periods import running_totals, with_calendar, with_growth
from martkeeper.operators.rollup import entity_rollup, pivot_max, positive_sum, referral_rollup
from martkeeper.session import shared_folder
from martkeeper.sources.ingest import with_ingest_metadata
from martkeeper.sources.sinks import overwrite

# Fixed values of the domain.
INTAKE, PLACEMENT, SHIPMENT = "psa_intake", "pump_on_body", "consumable_shipment"
PAYER_SEGMENTS = {"DME": "Medicare", "Pharmacy": "Commercial", "DTC": "Cash-pay"}
HIGH_VALUE_USD = 500
SOURCE_NAME = "foundation"

RAW_CLAIM = [
    "patient_id",
    "claim_date",
    "claim_type",
    "channel",
    "product_line",
    "product_sku",
    "claim_amount_usd",
    "units",
]

GOLD_REVENUE = [
    "patient_id",
    "month",
    "upfront_recognized_usd",
    "recurring_recognized_usd",
    "gross_margin_pct",
    "fulfillment_cost_usd",
    "total_recognized_usd",
    "margin_usd",
    "channel",
    "device_type",
    "region",
    "margin_calculated_usd",
    "is_break_even",
    "quarter_num",
    "year_num",
    "cumulative_usd",
    "cumulative_margin_usd",
    "moM_growth_pct",
]


class RawTables(Protocol):
    """Whatever offers the four raw tables as attributes."""

    patients: DataFrame
    hcps: DataFrame
    claims: DataFrame
    revenue_summary: DataFrame


@dataclass(frozen=True)
class Seeds:
    """The raw tables as given DataFrames."""

    patients: DataFrame
    hcps: DataFrame
    claims: DataFrame
    revenue_summary: DataFrame


# Digits after the point of the amounts; margins and costs are products of an amount and a rate.
MONEY = {
    "claim_amount_usd": 2,
    "upfront_recognized_usd": 2,
    "recurring_recognized_usd": 2,
    "total_recognized_usd": 2,
    "fulfillment_cost_usd": 4,
    "margin_usd": 4,
}


def exact_money(df: DataFrame) -> DataFrame:
    """Amounts as decimals, so that sums don't depend on the order in which rows are added."""
    inexact = [f.name for f in df.schema if f.name in MONEY and not isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast(T.DecimalType(24, MONEY[c])) for c in inexact})


def bronze(table: str, df: DataFrame, batch_ts: datetime | str) -> DataFrame:
    """Raw copy with technical metadata and exact amounts; the patient table has personal data."""
    personal = table == "patients"
    df = exact_money(df)
    return with_ingest_metadata(df, SOURCE_NAME, batch_ts, has_phi=personal, has_pii=personal)


def silver_patients(
    bronze_patients: DataFrame, tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """One row per patient, with device category and age at enrolment."""
    kept = dedup_latest(bronze_patients, ["patient_id"], tiebreak=tiebreak)
    return kept.select(
        "patient_id",
        "device_type",
        F.lower(categorize("device_type", {"Mobi": "mobi"}, "slim")).alias("device_category"),
        "region",
        "ssn",
        "dob",
        "patient_name",
        "enrolled_date",
        "referring_hcp_id",
        age_years("enrolled_date", "dob").alias("patient_age_at_enrollment"),
        "_loaded_at",
        "_source",
        F.lit(1.0).alias("_quality_score"),
    )


def silver_hcps(bronze_hcps: DataFrame, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """One row per provider, with the share of repeat prescriptions."""
    kept = dedup_latest(bronze_hcps, ["hcp_id"], tiebreak=tiebreak)
    retained = F.col("trx_12m") - F.col("nbrx_12m")
    return kept.select(
        "hcp_id",
        "hcp_name",
        "facility",
        "specialty",
        "role_type",
        "region",
        "segment_priority",
        "primary_device_referred",
        "nbrx_12m",
        "trx_12m",
        ratio(retained, "trx_12m").alias("retention_rate"),
        "_loaded_at",
        "_source",
        F.lit(1.0).alias("_quality_score"),
    )


def silver_claims(
    bronze_claims: DataFrame,
    patients: DataFrame,
    high_value_usd: float = HIGH_VALUE_USD,
    bucketed: bool = False,
) -> DataFrame:
    """Claims of known patients with their attributes, cycle time and a high-value flag.

    The cycle time runs from the patient's first intake to the first placement. Attributes and
    milestones are one row per patient, so they are joined to each other first and the claims are
    shuffled once, or not at all where they lie in even buckets by patient.
    """
    dates = milestone_dates(
        bronze_claims,
        "patient_id",
        "claim_type",
        "claim_date",
        first={"start_date": INTAKE, "end_date": PLACEMENT},
    )
    days = F.datediff("end_date", "start_date").alias("days_to_pump_on_body")
    known = patients.select("patient_id", "device_type", "region").join(
        dates.select("patient_id", days), "patient_id", "left"
    )
    if bucketed:
        joined = bronze_claims.join(known, "patient_id")
    else:
        joined = attach(bronze_claims, known, ["patient_id"], "inner")
    rows = with_calendar(joined, "claim_date")
    return rows.select(
        "claim_id",
        "patient_id",
        "claim_date",
        "claim_type",
        "channel",
        "product_line",
        "product_sku",
        "claim_amount_usd",
        "units",
        "_loaded_at",
        "_source",
        "device_type",
        "region",
        "quarter_num",
        "year_num",
        "days_to_pump_on_body",
        flag(F.col("claim_amount_usd") > high_value_usd).alias("is_high_value"),
    )


def silver_revenue_summary(bronze_revenue: DataFrame, patients: DataFrame) -> DataFrame:
    """Monthly revenue with region, margin check, running totals and growth.

    One row per patient and month is kept, the newest load, so a table that was loaded twice counts
    once; that bounds the windows by the calendar.
    """
    monthly = dedup_latest(bronze_revenue, ["patient_id", "month"])
    rows = with_calendar(
        monthly.join(patients.select("patient_id", "region"), "patient_id"), "month"
    )
    rows = rows.withColumns(
        {
            "margin_calculated_usd": F.col("total_recognized_usd") * F.col("gross_margin_pct") / 100,
            "is_break_even": flag(F.col("margin_usd") > 0),
        }
    )
    rows = running_totals(
        rows,
        ["patient_id"],
        "month",
        {"cumulative_usd": "total_recognized_usd", "cumulative_margin_usd": "margin_usd"},
    )
    rows = with_growth(rows, ["patient_id"], "month", "total_recognized_usd", "moM_growth_pct")
    return rows.select(*GOLD_REVENUE, "_loaded_at", "_source")


def gold_patients(
    patients: DataFrame, claims: DataFrame, revenue: DataFrame, as_of: date | str
) -> DataFrame:
    """One row per patient with lifecycle, placement, channel and twelve-month revenue.

    ``claims`` and ``revenue`` may be the raw or the conformed tables: only rows of the given
    patients count either way. Each is aggregated before the join, so sums are not repeated.
    """
    placed = claims.filter(F.col("claim_type") == PLACEMENT)
    rolled = entity_rollup(
        patients,
        "patient_id",
        [
            (
                placed,
                [
                    pivot_max("claim_type", PLACEMENT, "claim_date").alias("pump_on_body_date"),
                    pivot_max("claim_type", PLACEMENT, "channel").alias("channel_primary"),
                ],
            ),
            (
                revenue,
                [
                    positive_sum("upfront_recognized_usd").alias("total_upfront_12m"),
                    positive_sum("recurring_recognized_usd").alias("total_consumable_spend_12m"),
                ],
            ),
        ],
    )
    # A patient without revenue rows has no amount to add up: the sum over the empty join is 0.
    no_revenue = F.lit(0)
    return rolled.select(
        "patient_id",
        "device_type",
        "region",
        "ssn",
        "dob",
        "patient_name",
        "enrolled_date",
        "referring_hcp_id",
        "device_category",
        lifecycle_status("pump_on_body_date", as_of).alias("patient_lifecycle_status"),
        "pump_on_body_date",
        "channel_primary",
        F.coalesce("total_upfront_12m", no_revenue).alias("total_upfront_12m"),
        F.coalesce("total_consumable_spend_12m", no_revenue).alias("total_consumable_spend_12m"),
    )


def kept_claims(claims: DataFrame, tiebreak: Sequence[str] | None = None) -> DataFrame:
    """One row per placement or shipment claim.

    Versions of a claim with equal load time are ordered by the raw columns; the derived ones
    follow from these.
    """
    wanted = claims.filter(F.col("claim_type").isin(PLACEMENT, SHIPMENT))
    kept = dedup_latest(wanted, ["claim_id"], tiebreak=tiebreak or RAW_CLAIM)
    return kept.drop("_loaded_at", "_source")


def gold_claims(kept: DataFrame) -> DataFrame:
    """Kept claims with months since the patient's placement.

    The claims are read twice, once for the placements and once for all rows, so a deployment
    writes them first.
    """
    return with_month_offset(
        kept,
        "patient_id",
        "claim_type",
        "claim_date",
        PLACEMENT,
        [SHIPMENT],
        "month_offset_from_placement",
    )


def gold_revenue_summary(revenue: DataFrame) -> DataFrame:
    """The conformed revenue without technical columns."""
    return revenue.select(*GOLD_REVENUE)


def gold_hcp(hcps: DataFrame, patients: DataFrame) -> DataFrame:
    """Providers with referral performance, from the gold patients."""
    profile = hcps.drop("_loaded_at", "_source", "_quality_score")
    active = F.col("patient_lifecycle_status") == "active"
    return referral_rollup(
        profile, patients, "hcp_id", "referring_hcp_id", "patient_id", active
    )


def payer_segments(patients: DataFrame) -> DataFrame:
    """Derived, uncertified product: the payer segment of each patient's primary channel."""
    return patients.select(
        "patient_id", categorize("channel_primary", PAYER_SEGMENTS).alias("payer_segment")
    )


PARTITIONED = ("gold_claims", "gold_revenue_summary")
PERIOD = ("year_num", "quarter_num")
LAYERS = (
    "bronze_patients",
    "bronze_hcps",
    "bronze_claims",
    "bronze_revenue_summary",
    "silver_patients",
    "silver_hcps",
    "silver_claims",
    "silver_revenue_summary",
    "gold_patients",
    "gold_claims",
    "gold_revenue_summary",
    "gold_hcp",
)


class Mart:
    """The twelve layers of one build; a layer is composed when it is first asked for.

    ``tiebreaks`` names, per raw table, columns that decide between versions of a row with equal
    load time, instead of all its columns. Where such columns identify the row, the dedup no longer
    needs the others, and Spark prunes what a question does not use.
    ``store`` is given a layer's name and a function that composes it, and returns the layer: it may
    keep it somewhere, and needn't compose what it has already. ``bucketed`` tells of a layer that was
    asked for whether it lies in buckets by patient.
    """

    def __init__(
        self,
        seeds: RawTables,
        batch_ts: datetime | str,
        as_of: date | str,
        high_value_usd: float = HIGH_VALUE_USD,
        tiebreaks: Mapping[str, Sequence[str]] | None = None,
        store: Callable[[str, Callable[[], DataFrame]], DataFrame] | None = None,
        bucketed: Callable[[str], bool] | None = None,
    ) -> None:
        self.seeds, self.batch_ts, self.as_of = seeds, batch_ts, as_of
        self.high_value_usd = high_value_usd
        self.tiebreaks = tiebreaks or {}
        self._store = store or (lambda name, build: build())
        self._bucketed = bucketed or (lambda name: False)

    def _bronze(self, table: str) -> DataFrame:
        return self._store(
            f"bronze_{table}", lambda: bronze(table, getattr(self.seeds, table), self.batch_ts)
        )

    @cached_property
    def bronze_patients(self) -> DataFrame:
        return self._bronze("patients")

    @cached_property
    def bronze_hcps(self) -> DataFrame:
        return self._bronze("hcps")

    @cached_property
    def bronze_claims(self) -> DataFrame:
        return self._bronze("claims")

    @cached_property
    def bronze_revenue_summary(self) -> DataFrame:
        return self._bronze("revenue_summary")

    @cached_property
    def silver_patients(self) -> DataFrame:
        return self._store(
            "silver_patients",
            lambda: silver_patients(self.bronze_patients, self.tiebreaks.get("patients")),
        )

    @cached_property
    def silver_hcps(self) -> DataFrame:
        return self._store(
            "silver_hcps", lambda: silver_hcps(self.bronze_hcps, self.tiebreaks.get("hcps"))
        )

    @cached_property
    def silver_claims(self) -> DataFrame:
        return self._store(
            "silver_claims",
            lambda: silver_claims(
                self.bronze_claims,
                self.silver_patients,
                self.high_value_usd,
                self._bucketed("bronze_claims"),
            ),
        )

    @cached_property
    def silver_revenue_summary(self) -> DataFrame:
        return self._store(
            "silver_revenue_summary",
            lambda: silver_revenue_summary(self.bronze_revenue_summary, self.silver_patients),
        )

    @cached_property
    def gold_patients(self) -> DataFrame:
        # The raw facts suffice: their aggregates are joined to the known patients only.
        return self._store(
            "gold_patients",
            lambda: gold_patients(
                self.silver_patients, self.bronze_claims, self.bronze_revenue_summary, self.as_of
            ),
        )

    @cached_property
    def stage_claims(self) -> DataFrame:
        return self._store(
            "stage_claims", lambda: kept_claims(self.silver_claims, self.tiebreaks.get("claims"))
        )

    @cached_property
    def gold_claims(self) -> DataFrame:
        return self._store("gold_claims", lambda: gold_claims(self.stage_claims))

    @cached_property
    def gold_revenue_summary(self) -> DataFrame:
        return self._store(
            "gold_revenue_summary", lambda: gold_revenue_summary(self.silver_revenue_summary)
        )

    @cached_property
    def gold_hcp(self) -> DataFrame:
        return self._store("gold_hcp", lambda: gold_hcp(self.silver_hcps, self.gold_patients))

    def tables(self) -> Mapping[str, DataFrame]:
        return {name: getattr(self, name) for name in LAYERS}


def build(seeds: RawTables, batch_ts: datetime | str, as_of: date | str, **options) -> Mart:
    """All layers as lazy DataFrames."""
    return Mart(seeds, batch_ts, as_of, **options)


def materialize(
    spark: SparkSession,
    seeds: RawTables,
    folder: str | None,
    batch_ts: datetime | str,
    as_of: date | str,
    **options,
) -> Mart:
    """Write each layer as parquet and build the next one from what was written.

    A layer is computed once, and a lost executor recomputes from the written layer below. The
    gold facts are partitioned by year and quarter, which is what questions filter on. Without a
    folder the layers go under the one that the cluster shares. A build replaces the one before in its
    folder; where jobs share layers, a :class:`~martkeeper.sources.stored.LayerStore` is the store.
    """
    folder = folder or f"{shared_folder(spark)}/mart"

    def store(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        overwrite(build(), f"{folder}/{name}", PERIOD if name in PARTITIONED else ())
        return spark.read.parquet(f"{folder}/{name}")

    mart = Mart(seeds, batch_ts, as_of, store=store, **options)
    mart.tables()
    return mart
