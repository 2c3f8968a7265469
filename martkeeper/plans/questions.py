"""The question set over the metric views.

Where a stated answer and the stated question differ, both forms are here: the answer as given
(same rows as the original query) and a ``..._corrected`` or explicitly filtered form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martkeeper.operators.metrics import MetricCatalog
from martkeeper.operators.joins import attach
from martkeeper.operators.scenario import shift_share
from martkeeper.plans.medallion import PLACEMENT

CYCLE, COUNT = "Avg Cycle Time Days", "Patient Count"
CHANNEL, DEVICE = "Channel", "Device Type"


def cycle_time_verify(c: MetricCatalog, quarter: int, year: int) -> DataFrame:
    """Rounded cycle time and patients by channel and device, placements of one quarter."""
    return c.query(
        "mv_fulfillment_rate",
        [CYCLE, COUNT],
        [CHANNEL, DEVICE],
        {"Claim Type": PLACEMENT, "Quarter": quarter, "Year": year},
    ).select(
        CHANNEL,
        DEVICE,
        F.round(F.col(CYCLE)).alias("avg_cycle_days"),
        F.col(COUNT).alias("patient_count"),
    ).orderBy("avg_cycle_days", CHANNEL, DEVICE)


def cycle_time_unfiltered(c: MetricCatalog, quarter: int, year: int) -> DataFrame:
    """As asked without a claim type: patients weigh in by their number of claims."""
    return c.query(
        "mv_fulfillment_rate",
        [CYCLE],
        [CHANNEL, DEVICE],
        {"Quarter": quarter, "Year": year},
        order_by=[F.col(CYCLE), CHANNEL, DEVICE],
    )


def fastest_combination(c: MetricCatalog, quarter: int, year: int) -> DataFrame:
    """Top one of :func:`cycle_time_unfiltered`; ties go to the first name."""
    return cycle_time_unfiltered(c, quarter, year).limit(1)


def margin_by_channel(c: MetricCatalog) -> DataFrame:
    """Margin percent by channel, one digit."""
    return c.query("mv_gross_margin", ["Gross Margin Pct"], [CHANNEL]).select(
        CHANNEL, F.round("Gross Margin Pct", 1).alias("gross_margin_pct")
    ).orderBy(F.desc("gross_margin_pct"), CHANNEL)


def margin_all_quarters(c: MetricCatalog) -> DataFrame:
    """Margin percent by channel over all quarters, as the stated answer computes it."""
    return c.query(
        "mv_gross_margin",
        ["Gross Margin Pct"],
        [CHANNEL],
        order_by=[F.desc("Gross Margin Pct"), CHANNEL],
    )


def margin_latest_quarter_corrected(c: MetricCatalog) -> DataFrame:
    """Margin percent by channel in the most recent quarter.

    The measure is evaluated per quarter and the latest quarter is kept. The window runs over one
    row per channel and quarter, not over the facts, and the facts are read once.
    """
    period = F.struct("Year", "Quarter")
    per_quarter = c.query("mv_gross_margin", ["Gross Margin Pct"], [CHANNEL, "Year", "Quarter"])
    return (
        per_quarter.withColumn("_latest", F.max(period).over(Window.partitionBy()))
        .filter(period == F.col("_latest"))
        .drop("_latest")
        .orderBy(F.desc("Gross Margin Pct"), CHANNEL)
    )


def revenue_by_channel_device(c: MetricCatalog, quarter: int, year: int) -> DataFrame:
    return c.query(
        "mv_revenue_by_channel",
        ["Total Revenue USD"],
        [CHANNEL, DEVICE],
        {"Quarter": quarter, "Year": year},
        order_by=[F.desc("Total Revenue USD"), CHANNEL, DEVICE],
    )


def recurring_by_channel(c: MetricCatalog) -> DataFrame:
    return c.query(
        "mv_recurring_revenue",
        ["Total Consumable Revenue 12m"],
        [CHANNEL],
        order_by=[F.desc("Total Consumable Revenue 12m"), CHANNEL],
    )


def upfront_vs_recurring(c: MetricCatalog, quarter: int, year: int) -> DataFrame:
    return c.query(
        "mv_revenue_by_channel",
        ["Total Upfront USD", "Total Recurring USD"],
        [CHANNEL],
        {"Quarter": quarter, "Year": year},
    )


def avg_recurring_by_device(c: MetricCatalog) -> DataFrame:
    return c.query(
        "mv_recurring_revenue",
        ["Avg Monthly Consumable USD"],
        [DEVICE],
        order_by=[F.desc("Avg Monthly Consumable USD"), DEVICE],
    )


def margin_by_region_device(c: MetricCatalog) -> DataFrame:
    return c.query(
        "mv_gross_margin",
        ["Margin USD", "Gross Margin Pct"],
        ["Region", DEVICE],
        order_by=[F.desc("Gross Margin Pct"), "Region", DEVICE],
    )


def patients_by_channel(
    c: MetricCatalog, quarter: int, year: int, placements_only: bool = False
) -> DataFrame:
    """Patients with any claim of the quarter, or with a placement in it."""
    where: dict[str, object] = {"Quarter": quarter, "Year": year}
    if placements_only:
        where["Claim Type"] = PLACEMENT
    return c.query(
        "mv_fulfillment_rate", [COUNT], [CHANNEL], where, order_by=[F.desc(COUNT), CHANNEL]
    )


def cost_by_channel_quarter(c: MetricCatalog, year: int) -> DataFrame:
    return c.query(
        "mv_gross_margin",
        ["Fulfillment Cost USD"],
        [CHANNEL, "Quarter"],
        {"Year": year},
        order_by=[CHANNEL, "Quarter"],
    )


def payer_segment_margin(c: MetricCatalog) -> DataFrame:
    """Patients, revenue and margin percent by payer segment (uncertified)."""
    return c.query(
        "mv_payer_segment_revenue",
        [COUNT, "Total Revenue USD", "Avg Margin Pct"],
        ["Payer Segment"],
    ).select(
        "Payer Segment",
        F.col(COUNT).alias("patients"),
        F.round("Total Revenue USD").alias("revenue_usd"),
        F.round("Avg Margin Pct", 1).alias("avg_gross_margin_pct"),
    ).orderBy(F.desc("avg_gross_margin_pct"), "Payer Segment")


def ratio_vs_avg_margin(c: MetricCatalog) -> DataFrame:
    """Mean of percentages beside margin over revenue, by region and device."""
    return c.query(
        "mv_gross_margin", ["Gross Margin Pct", "Blended Margin Pct"], ["Region", DEVICE]
    )


def segment_speed_and_margin(c: MetricCatalog) -> DataFrame:
    """Cycle time and margin by payer segment, with the best of each marked.

    Cycle time comes from the gold placements, margin from the payer view; the two aggregates have
    one row per segment and are joined after the fact.
    """
    placements = c.tables.get("gold_claims").filter(F.col("claim_type") == PLACEMENT)
    segments = c.tables.get("patient_payer_segment")
    speed = (
        attach(placements, segments, ["patient_id"], "inner")
        .groupBy(F.col("payer_segment").alias("Payer Segment"))
        .agg(F.avg("days_to_pump_on_body").alias("avg_cycle_days"))
    )
    margin = c.query("mv_payer_segment_revenue", ["Avg Margin Pct"], ["Payer Segment"])
    both = speed.join(margin, "Payer Segment")
    fastest = F.row_number().over(Window.orderBy(F.asc("avg_cycle_days"), "Payer Segment"))
    best = F.row_number().over(Window.orderBy(F.desc("Avg Margin Pct"), "Payer Segment"))
    return both.select(
        "Payer Segment",
        "avg_cycle_days",
        F.col("Avg Margin Pct").alias("avg_margin_pct"),
        (fastest == 1).alias("is_fastest"),
        (best == 1).alias("is_best_margin"),
    )


def whatif_shift(
    revenue: DataFrame, share: float = 0.15, device: str = "Mobi", quarters: tuple = (2, 3)
) -> DataFrame:
    """Margin when a share of the device's DME volume of these quarters goes to DTC."""
    moved = (F.col("device_type") == device) & F.col("quarter_num").isin(*quarters)
    return shift_share(
        revenue, "channel", "total_recognized_usd", "margin_usd", "DME", "DTC", share, moved
    )
