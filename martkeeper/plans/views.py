"""The seven metric views and the two question surfaces."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from martkeeper.operators.metrics import Join, MetricCatalog, MetricView, Surface
from martkeeper.plans.medallion import LAYERS, Mart, payer_segments
from martkeeper.sources.tables import TableRegistry

SEGMENT_TABLE = "patient_payer_segment"

# Names and expressions of the views' dimensions and measures.
CHANNEL = {"Channel": "channel"}
DEVICE = {"Device Type": "device_type"}
REGION = {"Region": "region"}
PERIOD = {"Quarter": "quarter_num", "Year": "year_num"}
PATIENTS = {"Patient Count": "COUNT(DISTINCT patient_id)"}
AVG_MARGIN = {"Avg Margin Pct": "AVG(gross_margin_pct)"}

REVENUE_BY_CHANNEL = MetricView(
    name="mv_revenue_by_channel",
    source="gold_revenue_summary",
    filter="is_break_even = true",
    dimensions={**CHANNEL, **DEVICE, **PERIOD},
    measures={
        **PATIENTS,
        "Total Upfront USD": "SUM(upfront_recognized_usd)",
        "Total Recurring USD": "SUM(recurring_recognized_usd)",
        "Total Revenue USD": "SUM(total_recognized_usd)",
        "Total Margin USD": "SUM(margin_usd)",
        **AVG_MARGIN,
    },
    comment="What each sales channel brings in, and what is left of it.",
)

FULFILLMENT_RATE = MetricView(
    name="mv_fulfillment_rate",
    source="gold_claims",
    filter="claim_type IN ('pump_on_body', 'consumable_shipment')",
    dimensions={
        **CHANNEL,
        **DEVICE,
        "Claim Type": "claim_type",
        **REGION,
        **PERIOD,
        "Claim Date": "claim_date",
    },
    measures={
        "Avg Cycle Time Days": "AVG(days_to_pump_on_body)",
        **PATIENTS,
        "Claim Count": "COUNT(1)",
    },
    comment="Cycle time from intake to placement, and claim volume.",
)

RECOGNIZED_REVENUE = MetricView(
    name="mv_recognized_revenue",
    source="gold_revenue_summary",
    dimensions={
        "Patient Id": "patient_id",
        "Month": "month",
        **CHANNEL,
        **DEVICE,
        **REGION,
        **PERIOD,
        "Is Break Even": "is_break_even",
    },
    measures={
        "Upfront USD": "SUM(upfront_recognized_usd)",
        "Recurring USD": "SUM(recurring_recognized_usd)",
        "Total Revenue USD": "SUM(total_recognized_usd)",
        "Margin USD": "SUM(margin_usd)",
        **AVG_MARGIN,
    },
    comment="Recognized revenue per patient and month.",
)

RECURRING_REVENUE = MetricView(
    name="mv_recurring_revenue",
    source="gold_revenue_summary",
    filter="recurring_recognized_usd > 0",
    joins=(Join("patient", "gold_patients", "source.patient_id = patient.patient_id"),),
    dimensions={
        **CHANNEL,
        **DEVICE,
        "Lifecycle Status": "patient.patient_lifecycle_status",
    },
    measures={
        "Patient Cohort Size": "COUNT(DISTINCT patient_id)",
        "Total Consumable Revenue 12m": "SUM(recurring_recognized_usd)",
        "Avg Monthly Consumable USD": "AVG(recurring_recognized_usd)",
        **AVG_MARGIN,
    },
    comment="How much patients in each stage keep spending after the first sale.",
)

GROSS_MARGIN = MetricView(
    name="mv_gross_margin",
    source="gold_revenue_summary",
    filter="is_break_even = true",
    dimensions={**CHANNEL, **DEVICE, **REGION, "Month": "month", **PERIOD},
    measures={
        **PATIENTS,
        "Revenue USD": "SUM(total_recognized_usd)",
        "Margin USD": "SUM(margin_usd)",
        "Fulfillment Cost USD": "SUM(fulfillment_cost_usd)",
        "Gross Margin Pct": "AVG(gross_margin_pct)",
        # The business definition, Margin USD / Revenue USD. It differs from the mean of the
        # rows' percentages wherever the percentage varies inside a group.
        "Blended Margin Pct": "TRY_DIVIDE(CAST(SUM(margin_usd) AS DOUBLE), "
        "CAST(SUM(total_recognized_usd) AS DOUBLE)) * 100",
    },
    comment="Margins as the mean of rows and as a share of the revenue.",
)

HCP_REFERRAL = MetricView(
    name="mv_hcp_referral_performance",
    source="gold_hcp",
    dimensions={
        "HCP Id": "hcp_id",
        "HCP Name": "hcp_name",
        "Facility": "facility",
        "Specialty": "specialty",
        "Role Type": "role_type",
        **REGION,
        "Segment Priority": "segment_priority",
        "Primary Device Referred": "primary_device_referred",
    },
    measures={
        "HCP Count": "COUNT(DISTINCT hcp_id)",
        "Patients Referred": "SUM(patients_referred)",
        "Active Placements": "SUM(active_placements)",
        "Avg Placement Success Rate": "AVG(placement_success_rate)",
        "Avg Retention Rate": "AVG(retention_rate)",
        "Total NBRx 12m": "SUM(nbrx_12m)",
        "Total TRx 12m": "SUM(trx_12m)",
    },
    comment="Provider referral and conversion.",
)

PAYER_SEGMENT_REVENUE = MetricView(
    name="mv_payer_segment_revenue",
    source="gold_revenue_summary",
    joins=(
        Join("segment", SEGMENT_TABLE, "source.patient_id = segment.patient_id"),
    ),
    dimensions={"Payer Segment": "segment.payer_segment"},
    measures={
        **PATIENTS,
        "Total Revenue USD": "SUM(total_recognized_usd)",
        **AVG_MARGIN,
    },
    comment="Revenue and margin by payer segment; rests on an uncertified table.",
)

CERTIFIED_VIEWS = (
    REVENUE_BY_CHANNEL,
    FULFILLMENT_RATE,
    RECOGNIZED_REVENUE,
    RECURRING_REVENUE,
    GROSS_MARGIN,
    HCP_REFERRAL,
)

ASKABLE = (
    "mv_fulfillment_rate",
    "mv_gross_margin",
    "mv_recognized_revenue",
    "mv_recurring_revenue",
    "mv_revenue_by_channel",
)
HIDDEN = {"mv_recognized_revenue": ("Patient Id",)}

COMMERCIAL = Surface("commercial", ASKABLE, HIDDEN)
COMMERCIAL_AND_PAYER = Surface(
    "commercial and payer", ASKABLE, HIDDEN, allow_uncertified=("mv_payer_segment_revenue",)
)


def mart_tables(mart: Mart) -> dict[str, Callable[[], DataFrame]]:
    """The mart's gold tables and the payer segments, each composed when a view needs it."""
    gold = {n: (lambda n=n: getattr(mart, n)) for n in LAYERS if n.startswith("gold_")}
    return {**gold, SEGMENT_TABLE: lambda: payer_segments(mart.gold_patients)}


def metric_catalog(
    spark: SparkSession, tables: Mapping[str, DataFrame | Callable[[], DataFrame]]
) -> MetricCatalog:
    """Catalog over gold tables; a view is defined when all its sources are given.

    The payer segments are the one table that is not certified.
    """
    registry = TableRegistry(spark)
    for name, df in tables.items():
        registry.put(name, df, certified=name != SEGMENT_TABLE)
    catalog = MetricCatalog(registry)
    for view in (*CERTIFIED_VIEWS, PAYER_SEGMENT_REVENUE):
        if all(s in tables for s in view.sources()):
            catalog.define(view)
    return catalog
