"""The four raw tables derived from an order-management schema.

Customers stand in for patients, suppliers for providers, order lines for claims and for monthly
revenue. The mapping is a projection and a few joins; the layers then run as on any other seeds.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkeeper.functions.calc import from_units, sum_units, units
from martkeeper.functions.draws import padded_key
from martkeeper.operators.periods import monthly_sums
from martkeeper.plans.medallion import INTAKE, PLACEMENT, SHIPMENT
from martkeeper.sources.seeds import SPECIALTIES
from martkeeper.sources.tables import ParquetFolder

CLAIM_TYPES = {"A": INTAKE, "N": PLACEMENT, "R": SHIPMENT}


def channel() -> Column:
    """One channel per customer, from the market segment."""
    segment = F.col("c_mktsegment")
    return (
        F.when(segment.isin("MACHINERY", "BUILDING"), "DME")
        .when(segment.isin("AUTOMOBILE", "FURNITURE"), "Pharmacy")
        .otherwise("DTC")
    )


def device() -> Column:
    return F.when(F.col("c_acctbal") > 4300, "Mobi").otherwise("t:slim X2")


def customers(src: ParquetFolder) -> DataFrame:
    """Customer key with channel and device."""
    return src.scan("customer").select(
        "c_custkey", channel().alias("channel"), device().alias("device_type")
    )


def _places(src: ParquetFolder) -> DataFrame:
    nation, region = (src.scan(t) for t in ("nation", "region"))
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", F.col("r_name").alias("region")
    )


def patients(src: ParquetFolder, per_order: DataFrame | None = None) -> DataFrame:
    """Enrolment is the first order; the referring provider is the supplier of its first line.

    The first order of a customer with lines is the minimum of one long as well, of a day and an
    order below 2^44; a minimum of a struct would sort all orders before the shuffle.
    """
    per_order = order_facts(src) if per_order is None else per_order
    first_line = per_order.select("l_orderkey", "suppkey")
    orders = src.scan("orders")
    day = F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint")
    order = F.shiftleft(day, 44) + F.col("o_orderkey")
    history = (
        orders.join(first_line, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .groupBy("o_custkey")
        .agg(
            F.min("o_orderdate").cast("date").alias("enrolled_date"),
            F.min(F.when(F.col("suppkey").isNotNull(), order)).bitwiseAND(2**44 - 1).alias("first"),
        )
        .join(first_line, F.col("first") == F.col("l_orderkey"), "left")
    )
    key = F.col("c_custkey")
    ssn = F.format_string("%03d-%02d-%04d", 100 + key % 900, 10 + key % 90, 1000 + key % 9000)
    born = F.date_sub(F.lit("2024-01-01").cast("date"), (365 * (18 + key % 58)).cast("int"))
    return (
        src.scan("customer")
        .join(_places(src), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(history, key == F.col("o_custkey"), "left")
        .select(
            padded_key("PAT", "c_custkey").alias("patient_id"),
            device().alias("device_type"),
            "region",
            ssn.alias("ssn"),
            born.alias("dob"),
            F.col("c_name").alias("patient_name"),
            "enrolled_date",
            F.when(F.col("suppkey").isNotNull(), padded_key("HCP", "suppkey")).alias(
                "referring_hcp_id"
            ),
        )
    )


def hcps(src: ParquetFolder) -> DataFrame:
    """Prescriptions are order lines; new ones are those that were not returned or accepted."""
    lines = src.scan("lineitem")
    volume = lines.groupBy("l_suppkey").agg(
        F.count_if(F.col("l_returnflag") == "N").alias("nbrx"), F.count(F.lit(1)).alias("trx")
    )
    key, balance = F.col("s_suppkey"), F.col("s_acctbal")
    specialty = F.array(*[F.lit(s) for s in SPECIALTIES])
    return (
        src.scan("supplier")
        .join(_places(src), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(volume, key == F.col("l_suppkey"), "left")
        .select(
            padded_key("HCP", "s_suppkey").alias("hcp_id"),
            F.col("s_name").alias("hcp_name"),
            F.col("n_name").alias("facility"),
            F.element_at(specialty, (key % 5 + 1).cast("int")).alias("specialty"),
            F.when(key % 10 < 7, "prescriber").otherwise("influencer").alias("role_type"),
            "region",
            F.when(balance > 6000, "High")
            .when(balance > 2000, "Medium")
            .otherwise("Low")
            .alias("segment_priority"),
            F.when(key % 5 < 2, "t:slim X2")
            .when(key % 5 < 4, "Mobi")
            .otherwise("Competitor")
            .alias("primary_device_referred"),
            F.coalesce("nbrx", F.lit(0)).alias("nbrx_12m"),
            F.coalesce("trx", F.lit(0)).alias("trx_12m"),
        )
    )


def claims(src: ParquetFolder) -> DataFrame:
    """Order lines; order and line number make the claim key, which occurs more than once."""
    lines = src.scan("lineitem")
    orders = src.scan("orders", ["o_orderkey", "o_custkey"])
    owners = orders.join(
        customers(src), F.col("o_custkey") == F.col("c_custkey")
    ).select("o_orderkey", "o_custkey", "channel", "device_type")
    kind = F.col("l_returnflag")
    return lines.join(owners, F.col("l_orderkey") == F.col("o_orderkey")).select(
        padded_key("CLM", F.col("l_orderkey") * 10 + F.col("l_linenumber"), 7).alias("claim_id"),
        padded_key("PAT", "o_custkey").alias("patient_id"),
        F.col("l_shipdate").cast("date").alias("claim_date"),
        F.when(kind == "A", INTAKE).when(kind == "N", PLACEMENT).otherwise(SHIPMENT).alias(
            "claim_type"
        ),
        "channel",
        F.when(kind == "R", "Consumables").otherwise("Durables").alias("product_line"),
        F.when(kind == "A", F.lit("psa"))
        .when(kind == "N", F.col("device_type"))
        .otherwise("infusion_set")
        .alias("product_sku"),
        F.col("l_extendedprice").alias("claim_amount_usd"),
        F.col("l_quantity").cast("int").alias("units"),
    )


def order_facts(src: ParquetFolder) -> DataFrame:
    """One row per order: its amounts, and the supplier of its first line.

    Amounts are whole cents, the margin hundredths of cents. All is combined before the order keys
    are shuffled. The first line is the minimum of one long, which Spark aggregates by hashing; it
    holds a line number and a supplier below 2^40.
    """
    price, status = units("l_extendedprice"), F.col("l_linestatus")
    rate = F.lit(100) - units("l_discount") - units("l_tax")
    nothing = F.lit(0).cast("bigint")
    line = F.shiftleft(F.col("l_linenumber").cast("bigint"), 40) + F.col("l_suppkey")
    return (
        src.scan("lineitem")
        .groupBy("l_orderkey")
        .agg(
            sum_units(F.when(status == "F", price).otherwise(nothing)).alias("upfront"),
            sum_units(F.when(status == "O", price).otherwise(nothing)).alias("recurring"),
            sum_units(price).alias("total"),
            sum_units(price * rate).alias("margin"),
            F.min(line).bitwiseAND(2**40 - 1).alias("suppkey"),
        )
    )


def monthly_money(src: ParquetFolder, per_order: DataFrame | None = None) -> DataFrame:
    """Exact amounts per customer and month of the order, from :func:`order_facts`."""
    orders = src.scan("orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    per_order = order_facts(src) if per_order is None else per_order
    joined = orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
    digits = {"upfront": 2, "recurring": 2, "total": 2, "margin": 4}
    sums = monthly_sums(joined, ["o_custkey"], "o_orderdate", {n: n for n in digits})
    exact = [from_units(n, d).alias(n) for n, d in digits.items()]
    return sums.select("o_custkey", "month", *exact)


def revenue_summary(src: ParquetFolder, per_order: DataFrame | None = None) -> DataFrame:
    """Monthly revenue; shipped lines are upfront, open ones recurring. Margin varies by row."""
    total, margin = F.col("total"), F.col("margin")
    return (
        monthly_money(src, per_order)
        .join(customers(src), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            padded_key("PAT", "o_custkey").alias("patient_id"),
            "month",
            F.col("upfront").alias("upfront_recognized_usd"),
            F.col("recurring").alias("recurring_recognized_usd"),
            (F.try_divide(margin.cast("double"), total.cast("double")) * 100).alias(
                "gross_margin_pct"
            ),
            (total - margin).cast("decimal(30,4)").alias("fulfillment_cost_usd"),
            total.alias("total_recognized_usd"),
            margin.alias("margin_usd"),
            "channel",
            "device_type",
        )
    )


class StandinSeeds:
    """The raw tables of a folder, composed when they are asked for.

    ``store`` keeps the facts per order, which patients and revenue share.
    """

    def __init__(
        self,
        src: ParquetFolder,
        store: Callable[[str, Callable[[], DataFrame]], DataFrame] | None = None,
    ) -> None:
        self.src = src
        self._store = store or (lambda name, build: build())

    @cached_property
    def order_facts(self) -> DataFrame:
        return self._store("order_facts", lambda: order_facts(self.src))

    @cached_property
    def patients(self) -> DataFrame:
        return patients(self.src, self.order_facts)

    @cached_property
    def hcps(self) -> DataFrame:
        return hcps(self.src)

    @cached_property
    def claims(self) -> DataFrame:
        return claims(self.src)

    @cached_property
    def revenue_summary(self) -> DataFrame:
        return revenue_summary(self.src, self.order_facts)
