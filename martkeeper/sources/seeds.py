"""Distributed generation of the four seed tables.

Input is a table of dense numbers (``spark.range(n)`` or the keys of another table); every column
is an expression over the number, so the tables are generated in parallel without a shuffle. The
planted relations are those a user checks the mart with: cycle time and margin by channel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkeeper.functions.calc import categorize
from martkeeper.functions.draws import (
    cents_between,
    chance,
    choose,
    choose_weighted,
    draw,
    int_between,
    padded_key,
)

# Fixed values of the seed tables.
REGIONS = ["US West", "US South", "US East"]
SPECIALTIES = ["Endocrinologist", "Diabetes Specialist", "PCP", "Nurse Educator", "PA-NP"]
ROLE_WEIGHTS = {"prescriber": 70, "influencer": 30}
PRIORITY_WEIGHTS = {"High": 35, "Medium": 35, "Low": 30}
REFERRED_DEVICE_WEIGHTS = {"t:slim X2": 40, "Mobi": 40, "Competitor": 20}
DEVICE_WEIGHTS = {"Mobi": 60, "t:slim X2": 40}
CHANNEL_WEIGHTS = {"DME": 40, "Pharmacy": 30, "DTC": 30}
FACILITIES = [
    "Lakeside Practice",
    "Northgate Hospital",
    "Hillcrest Clinic",
    "Riverbend Care",
    "Old Mill Surgery",
    "Harbour Medical House",
]
FIRST_NAMES = ["Ada", "Ben", "Cleo", "Dan", "Eva", "Finn", "Gwen", "Hugo", "Iris", "Jon"]
LAST_NAMES = ["Ash", "Birch", "Cedar", "Elm", "Hazel", "Larch", "Maple", "Oak", "Pine", "Rowan"]
CYCLE_DAYS = {"DME": (45, 75), "Pharmacy": (30, 60), "DTC": (15, 45)}
MARGIN_PCT = {"DME": 40, "Pharmacy": 45, "DTC": 50}
UPFRONT_USD = {"Mobi": 4500, "t:slim X2": 5400}
FIRST_DAY = "2024-01-01"
COHORT_DAY = "2026-01-01"
MONTHS = 12


def provider_region(number: Column) -> Column:
    """Region of a provider: each run of three numbers holds the three regions in a drawn order.

    The order is a rotation drawn per run, so regions are equally frequent and the provider of a
    given run and region is found by arithmetic instead of a lookup.
    """
    run = F.floor(number / F.lit(len(REGIONS))).cast("bigint")
    turn = F.pmod(draw(run, "region-turn"), F.lit(len(REGIONS)))
    slot = F.pmod(number + turn, F.lit(len(REGIONS))).cast("int") + 1
    return F.element_at(F.array(*[F.lit(r) for r in REGIONS]), slot)


def affine_provider(key: Column, region: Column, providers: Column | int) -> Column:
    """Number of the referring provider: 75 % from the entity's own region, the rest from all.

    Needs only the number of providers: no per-region index, no join. The providers must be numbered
    0 to ``providers`` - 1 without gaps, as :func:`dense_providers` checks.
    """
    providers = F.lit(providers).cast("bigint") if isinstance(providers, int) else providers
    size = len(REGIONS)
    anyone = F.pmod(draw(key, "provider-any"), providers)
    runs = F.floor(providers / F.lit(size)).cast("bigint")
    run = F.pmod(draw(key, "provider-run"), F.greatest(runs, F.lit(1)))
    turn = F.pmod(draw(run, "region-turn"), F.lit(size))
    position = F.array_position(F.array(*[F.lit(r) for r in REGIONS]), region) - 1
    # 3 * run is a multiple of the number of regions, so only the place in the run matters.
    same_region = run * size + F.pmod(position - turn, F.lit(size))
    return F.when(chance(key, "provider-affinity", 75) & (runs > 0), same_region).otherwise(anyone)


def dense_providers(numbers: DataFrame, number: str = "id") -> Column:
    """The number of providers as a scalar; fails when they aren't numbered 0..n-1 without gaps."""
    n, distinct = F.count(F.lit(1)), F.count_distinct(F.col(number))
    dense = (F.min(number) == 0) & (F.max(number) == n - 1) & (distinct == n)
    checked = F.when(n == 0, 0).when(dense, n).otherwise(
        F.raise_error(F.lit("providers must be numbered from 0 without gaps")).cast("bigint")
    )
    return numbers.agg(checked.alias("n")).scalar()


def generate_hcps(numbers: DataFrame, number: str = "id") -> DataFrame:
    """Provider table, one row per number."""
    n = F.col(number)
    nbrx = int_between(n, "hcp-nbrx", 5, 50)
    return numbers.select(
        padded_key("HCP", n).alias("hcp_id"),
        F.concat_ws(
            " ", choose(n, "hcp-first", FIRST_NAMES), choose(n, "hcp-last", LAST_NAMES)
        ).alias("hcp_name"),
        choose(n, "hcp-facility", FACILITIES).alias("facility"),
        choose(n, "hcp-specialty", SPECIALTIES).alias("specialty"),
        choose_weighted(n, "hcp-role", ROLE_WEIGHTS).alias("role_type"),
        provider_region(n).alias("region"),
        choose_weighted(n, "hcp-priority", PRIORITY_WEIGHTS).alias("segment_priority"),
        choose_weighted(n, "hcp-device", REFERRED_DEVICE_WEIGHTS).alias("primary_device_referred"),
        nbrx.alias("nbrx_12m"),
        (nbrx + int_between(n, "hcp-repeat", 20, 100)).alias("trx_12m"),
    )


def generate_patients(
    numbers: DataFrame, providers: Column | int, number: str = "id"
) -> DataFrame:
    """Patient table, one row per number, referred by one of ``providers`` providers."""
    n = F.col(number)
    region = choose(n, "pat-region", REGIONS)
    ssn = F.format_string(
        "%d-%d-%d",
        int_between(n, "pat-ssn-a", 100, 999),
        int_between(n, "pat-ssn-b", 10, 99),
        int_between(n, "pat-ssn-c", 1000, 9999),
    )
    return numbers.select(
        padded_key("PAT", n).alias("patient_id"),
        _device(n).alias("device_type"),
        region.alias("region"),
        ssn.alias("ssn"),
        F.date_sub(F.lit(FIRST_DAY).cast("date"), int_between(n, "pat-age", 18, 75) * 365).alias(
            "dob"
        ),
        F.concat_ws(
            " ", choose(n, "pat-first", FIRST_NAMES), choose(n, "pat-last", LAST_NAMES)
        ).alias("patient_name"),
        _enrolled(n).alias("enrolled_date"),
        padded_key("HCP", affine_provider(n, region, providers)).alias("referring_hcp_id"),
    )


def generate_claims(numbers: DataFrame, number: str = "id") -> DataFrame:
    """Claim table: intake, placement and twelve monthly shipments per patient.

    One row explodes into fourteen inside its own task; claim keys follow from the patient number.
    """
    n, k = F.col(number), F.col("k")
    shipment = k >= 2
    per_patient = 2 + MONTHS
    claim_no = n * per_patient + k
    base = numbers.select(
        n.alias(number),
        _channel(n).alias("channel"),
        _device(n).alias("device"),
        _intake(n).alias("intake"),
        F.explode(F.sequence(F.lit(0), F.lit(per_patient - 1))).alias("k"),
    ).withColumn("placement", _placement(F.col("intake"), F.col("channel"), n))
    return base.select(
        padded_key("CLM", claim_no, 7).alias("claim_id"),
        padded_key("PAT", n).alias("patient_id"),
        F.when(k == 0, F.col("intake"))
        .when(k == 1, F.col("placement"))
        .otherwise(F.add_months(F.trunc("placement", "MM"), k - 1))
        .alias("claim_date"),
        F.when(k == 0, "psa_intake")
        .when(k == 1, "pump_on_body")
        .otherwise("consumable_shipment")
        .alias("claim_type"),
        F.col("channel"),
        F.when(shipment, "Consumables").otherwise("Durables").alias("product_line"),
        F.when(k == 0, F.lit("psa"))
        .when(k == 1, F.col("device"))
        .otherwise("infusion_set")
        .alias("product_sku"),
        F.when(k == 0, F.lit(0.0))
        .when(k == 1, _upfront(F.col("device")))
        .otherwise(cents_between(claim_no, "claim-amount", 100, 150))
        .alias("claim_amount_usd"),
        F.lit(1).alias("units"),
    )


def generate_revenue(numbers: DataFrame, number: str = "id") -> DataFrame:
    """Monthly revenue: placement month 0..11, upfront in month 0 only.

    Channel and placement are recomputed from the patient number, so the claims are not read.
    """
    n = F.col(number)
    base = numbers.select(
        n.alias(number),
        padded_key("PAT", n).alias("patient_id"),
        _channel(n).alias("channel"),
        _device(n).alias("device_type"),
        _placement(_intake(n), _channel(n), n).alias("placement"),
    )
    return _revenue_rows(base, n)


def revenue_from_claims(claims: DataFrame, patients: DataFrame) -> DataFrame:
    """Monthly revenue of given claims: an equi-join on the placement claim of each patient."""
    placed = claims.filter(F.col("claim_type") == "pump_on_body").select(
        "patient_id", "channel", F.col("claim_date").alias("placement")
    )
    number = F.substring_index("patient_id", "-", -1).cast("bigint")
    base = patients.select("patient_id", "device_type").join(placed, "patient_id")
    return _revenue_rows(base, number)


def _revenue_rows(base: DataFrame, number: Column) -> DataFrame:
    upfront, recurring = F.col("upfront_recognized_usd"), F.col("recurring_recognized_usd")
    pct = F.col("gross_margin_pct")
    rows = base.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(MONTHS - 1))))
    return rows.select(
        "patient_id",
        F.add_months(F.trunc("placement", "MM"), F.col("k")).alias("month"),
        F.when(F.col("k") == 0, _upfront(F.col("device_type")))
        .otherwise(0.0)
        .alias("upfront_recognized_usd"),
        cents_between(number * MONTHS + F.col("k"), "revenue-amount", 100, 150).alias(
            "recurring_recognized_usd"
        ),
        _per_category("channel", MARGIN_PCT).cast("double").alias("gross_margin_pct"),
        _per_category("channel", MARGIN_PCT).cast("double").alias("fulfillment_cost_usd"),
        "channel",
        "device_type",
    ).select(
        "patient_id",
        "month",
        upfront,
        recurring,
        pct,
        "fulfillment_cost_usd",
        (upfront + recurring).alias("total_recognized_usd"),
        ((upfront + recurring) * (pct / 100)).alias("margin_usd"),
        "channel",
        "device_type",
    )


def _per_category(name: str, values: dict[str, int]) -> Column:
    """Parameter of a category, from a small fixed mapping."""
    return categorize(name, {k: str(v) for k, v in values.items()}).cast("int")


def _device(n: Column) -> Column:
    return choose_weighted(n, "pat-device", DEVICE_WEIGHTS)


def _channel(n: Column) -> Column:
    return choose_weighted(n, "pat-channel", CHANNEL_WEIGHTS)


def _enrolled(n: Column) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), int_between(n, "pat-enrolled", 0, 730))


def _intake(n: Column) -> Column:
    """30 % soon after enrolment, 70 % in the first quarter that the questions ask about."""
    cohort = F.date_add(F.lit(COHORT_DAY).cast("date"), int_between(n, "intake-cohort", 0, 89))
    natural = F.date_add(_enrolled(n), int_between(n, "intake-delay", 0, 30))
    return F.when(chance(n, "intake-forced", 70), cohort).otherwise(natural)


def _placement(intake: Column, channel: Column, n: Column) -> Column:
    days = None
    for name, (low, high) in CYCLE_DAYS.items():
        drawn = int_between(n, "cycle-days", low, high)
        days = F.when(channel == name, drawn) if days is None else days.when(channel == name, drawn)
    return F.date_add(intake, days)


def _upfront(device: Column) -> Column:
    return F.when(device == "Mobi", float(UPFRONT_USD["Mobi"])).otherwise(
        float(UPFRONT_USD["t:slim X2"])
    )
