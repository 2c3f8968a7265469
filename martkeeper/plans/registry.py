"""Registered queries: every operator of the mart over a folder of parquet tables.

Each query reads whole tables. Results are lazy; clocks are fixed so that reruns agree.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkeeper.functions.calc import month_start
from martkeeper.functions.draws import padded_key
from martkeeper.functions.masks import (
    mask_dob_year,
    mask_last4,
    mask_last4_strict,
    mask_redact,
    region_row_filter,
    register_sql_functions,
    tokenize_key,
)
from martkeeper.operators import grants as G
from martkeeper.operators.conform import dedup_latest, dedup_stored
from martkeeper.operators.govern import (
    CERTIFIED_SCHEMA,
    SANDBOX_SCHEMA,
    Caller,
    default_governance,
    entitled_rows,
)
from martkeeper.operators.metrics import MetricCatalog
from martkeeper.operators.milestones import cycle_time_by, cycle_times, with_month_offset
from martkeeper.operators.milestones import milestone_dates, with_cycle_time
from martkeeper.operators.periods import monthly_sums, running_totals, with_calendar, with_growth
from martkeeper.operators.quality import (
    completeness,
    distribution,
    distributions,
    grain_check,
    level_order,
    row_totals,
)
from martkeeper.operators.rollup import fanout_check, referral_rollup
from martkeeper.operators.sketches import (
    MetricRollup,
    distinct_rollup,
    roll_up,
    united,
    within_bound,
)
from martkeeper.plans import medallion as M
from martkeeper.plans import questions as Q
from martkeeper.plans import standins as S
from martkeeper.plans.reconcile import hourly_summary, reconcile
from martkeeper.plans.views import (
    COMMERCIAL,
    COMMERCIAL_AND_PAYER,
    SEGMENT_TABLE,
    mart_tables,
    metric_catalog,
)
from martkeeper.session import prepare
from martkeeper.sources import seeds as gen
from martkeeper.sources.ingest import with_ingest_metadata
from martkeeper.sources.runlog import RunLog
from martkeeper.sources.sinks import read_version, write_version
from martkeeper.sources.stored import (
    LayerStore,
    code_fingerprint,
    input_fingerprint,
    staged,
    work_root,
)
from martkeeper.sources.tables import ParquetFolder

Query = Callable[[SparkSession, str], DataFrame]

BATCH_TS = "2001-09-01 00:00:00"
AS_OF = "2001-08-01"
NOW = "2024-01-04 00:00:00"
LATER = "2024-01-05 00:00:00"
AUDIT_NOW = "2024-01-20 12:30:00"
QUARTER, YEAR = 1, 1998
HIGH_VALUE_USD = 50000
VISIBLE_REGION = "AMERICA"
ANALYST = Caller("analyst@example.com")
STEWARD = Caller("steward@example.com", ("stewards",))

_QUERIES: dict[str, Callable[[ParquetFolder], DataFrame]] = {}


def query(function: Callable[[ParquetFolder], DataFrame]) -> Callable[[ParquetFolder], DataFrame]:
    """Register a function under its own name, without ``_query`` at the end."""
    _QUERIES[function.__name__.removesuffix("_query")] = function
    return function


def plain(df: DataFrame, rounded: Mapping[str, int] | None = None) -> DataFrame:
    """Comparable columns: doubles for decimals, zone-free timestamps, rounded quotients."""
    rounded = rounded or {}
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        if f.name in rounded:
            c = F.round(c, rounded[f.name])
        out.append(c.alias(f.name))
    return df.select(*out)


# Raw tables that the layers are derived from, and the layers that are written: those which several
# others read. The rest are projections and joins of these.
RAW = ("customer", "lineitem", "nation", "orders", "region", "supplier")
WRITTEN = (
    "order_facts",
    "bronze_claims",
    "bronze_revenue_summary",
    "silver_patients",
    "stage_claims",
    "gold_patients",
    "gold_claims",
    "gold_revenue_summary",
    "gold_hcp",
)


def layer_store(src: ParquetFolder) -> LayerStore:
    """The layers of a folder, under the fingerprint of its files, the parameters and the code."""
    files = input_fingerprint(src.spark, [f"{src.folder}/{t}.parquet" for t in RAW])
    parameters = (files, BATCH_TS, AS_OF, HIGH_VALUE_USD, code_fingerprint())
    by = {**dict.fromkeys(M.PARTITIONED, M.PERIOD), "silver_patients": ("region",)}
    facts = dict.fromkeys(("bronze_claims", "bronze_revenue_summary"), "patient_id")
    return LayerStore(src.spark, repr(parameters), partition_by=by, bucket_by=facts)


def _mart(src: ParquetFolder) -> M.Mart:
    """The mart over stored layers. Whoever asks first builds what is missing."""
    store = layer_store(src)

    def kept(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return store.layer(name, build) if name in WRITTEN else build()

    return M.build(
        S.StandinSeeds(src, kept),
        BATCH_TS,
        AS_OF,
        high_value_usd=HIGH_VALUE_USD,
        store=kept,
        bucketed=store.bucketed,
    )


def _catalog(src: ParquetFolder) -> MetricCatalog:
    return metric_catalog(src.spark, mart_tables(_mart(src)))


# Layers ------------------------------------------------------------------------------------------


def _register_layers() -> None:
    rounded = {
        "bronze_revenue_summary": {"gross_margin_pct": 6},
        "silver_revenue_summary": {"gross_margin_pct": 6, "margin_calculated_usd": 4},
        "gold_revenue_summary": {"gross_margin_pct": 6, "margin_calculated_usd": 4},
        "silver_hcps": {"retention_rate": 6},
        "gold_hcp": {"retention_rate": 6},
    }
    for layer in M.LAYERS:

        def run(src: ParquetFolder, layer: str = layer) -> DataFrame:
            return plain(getattr(_mart(src), layer), rounded.get(layer))

        _QUERIES[layer] = run


_register_layers()


@query
def ingest_orders(src):
    df = with_ingest_metadata(src.scan("orders"), "orders", BATCH_TS)
    return plain(df)


@query
def patient_payer_segment(src):
    return M.payer_segments(_mart(src).gold_patients)


# Conforming, milestones, periods, roll-ups -------------------------------------------------------


@query
def dedup_lineitem(src):
    lines = src.scan("lineitem")
    return plain(dedup_latest(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"]))


@query
def deduped_quantity(src):
    """Quantity by flag over the newest version of each line; other columns aren't read."""
    lines = src.scan("lineitem")
    kept = dedup_stored(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    total = F.sum(F.col("l_quantity").cast("decimal(18,2)"))
    return plain(
        kept.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_lines"), total.alias("quantity"))
    )


@query
def dedup_documents(src):
    docs = src.scan("documents", ["doc_id", "text", "lang", "source"])
    kept = dedup_latest(docs, ["text"], [], ["doc_id", "lang", "source"], by_digest=True)
    return kept.select("doc_id", "lang", "source")


def _steps(src: ParquetFolder) -> DataFrame:
    return src.scan("events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("date").alias("day")
    )


@query
def milestone_cycle_time(src):
    days = cycle_times(_steps(src), "user_id", "event_type", "day", "signup", "purchase")
    who = S.customers(src)
    joined = days.join(who, F.col("user_id") == F.col("c_custkey"), "left")
    return cycle_time_by(joined, "channel", digits=2)


@query
def self_pivot_cycle_time(src):
    steps = _steps(src)
    dates = milestone_dates(
        steps, "user_id", "event_type", "day", {"start_date": "signup", "end_date": "purchase"}
    )
    return with_cycle_time(steps, dates, "user_id", out="days_to_purchase")


@query
def event_month_offset(src):
    return with_month_offset(
        _steps(src), "user_id", "event_type", "day", "purchase", ["click", "view"]
    )


@query
def month_offset_from_placement(src):
    """Months from each customer's last placement line to every order line."""
    claims = S.claims(src).select("claim_id", "patient_id", "claim_type", "claim_date")
    return with_month_offset(
        claims, "patient_id", "claim_type", "claim_date", M.PLACEMENT, [M.SHIPMENT]
    )


@query
def monthly_revenue(src):
    return plain(with_calendar(S.monthly_money(src), "month"))


@query
def running_revenue(src):
    monthly = S.monthly_money(src).select("o_custkey", "month", "total")
    return plain(running_totals(monthly, ["o_custkey"], "month", {"running_total": "total"}))


@query
def running_order_value(src):
    """Running totals on a table with several rows per customer and month."""
    orders = src.scan("orders").select(
        "o_orderkey",
        "o_custkey",
        month_start("o_orderdate").alias("month"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("value"),
    )
    totals = {"running_value": "value"}
    return plain(running_totals(orders, ["o_custkey"], "month", totals, one_row_per_period=False))


@query
def month_growth(src):
    monthly = S.monthly_money(src).select("o_custkey", "month", "total")
    return plain(
        with_growth(monthly, ["o_custkey"], "month", "total", "growth_pct", "previous_total")
    )


@query
def fanout_check_query(src):
    orders = src.scan("orders").select("o_custkey", "o_orderdate")
    months = orders.groupBy("o_custkey", month_start("o_orderdate").alias("m")).agg(
        F.count(F.lit(1)).alias("n")
    )
    who = src.scan("customer").select(F.col("c_custkey").alias("o_custkey"))
    return fanout_check(who, "o_custkey", [orders, months])


@query
def provider_retention(src):
    return plain(
        M.silver_hcps(M.bronze("hcps", S.hcps(src), BATCH_TS)).select(
            "hcp_id", "nbrx_12m", "trx_12m", "retention_rate"
        ),
        {"retention_rate": 6},
    )


@query
def provider_referral_rollup_query(src):
    """Suppliers with the customers they served, where a customer has several suppliers."""
    lines = src.scan("lineitem", ["l_orderkey", "l_suppkey"])
    orders = src.scan("orders", ["o_orderkey", "o_custkey"])
    who = src.scan("customer", ["c_custkey", "c_acctbal"])
    pairs = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select("l_suppkey", "o_custkey")
        .distinct()
    )
    served = pairs.join(who, F.col("o_custkey") == F.col("c_custkey"))
    suppliers = src.scan("supplier", ["s_suppkey", "s_name"])
    return referral_rollup(
        suppliers,
        served,
        "s_suppkey",
        "l_suppkey",
        "o_custkey",
        F.col("c_acctbal") > 0,
    )


# Metric views ------------------------------------------------------------------------------------

_MV = {
    "mv_revenue_by_channel": (["Channel", "Device Type", "Quarter", "Year"], {}),
    "mv_fulfillment_rate": (
        ["Channel", "Device Type", "Claim Type", "Region", "Quarter", "Year"],
        {"Avg Cycle Time Days": 6},
    ),
    "mv_recognized_revenue": (
        ["Month", "Channel", "Device Type", "Region", "Quarter", "Year", "Is Break Even"],
        {},
    ),
    "mv_recurring_revenue": (["Channel", "Device Type", "Lifecycle Status"], {}),
    "mv_gross_margin": (["Channel", "Device Type", "Region", "Quarter", "Year"], {}),
    "mv_hcp_referral_performance": (
        ["Specialty", "Role Type", "Region", "Segment Priority", "Primary Device Referred"],
        {},
    ),
    "mv_payer_segment_revenue": (["Payer Segment"], {}),
}
_QUOTIENTS = {
    "Avg Margin Pct": 6,
    "Gross Margin Pct": 6,
    "Blended Margin Pct": 6,
    "Avg Monthly Consumable USD": 6,
    "Avg Placement Success Rate": 6,
    "Avg Retention Rate": 6,
}


def _register_views() -> None:
    for name, (dims, rounded) in _MV.items():

        def run(src, name=name, dims=dims, rounded=rounded):
            catalog = _catalog(src)
            measures = list(catalog.view(name).measures)
            return plain(catalog.query(name, measures, dims), {**_QUOTIENTS, **rounded})

        _QUERIES[name] = run


_register_views()


@query
def recognized_revenue_by_patient(src):
    """The per-patient dimension, for callers outside the restricted surfaces."""
    df = _catalog(src).query(
        "mv_recognized_revenue",
        ["Total Revenue USD", "Margin USD"],
        ["Patient Id", "Year"],
        lambda d: (d["Year"] >= 1997) & d["Is Break Even"],
    )
    return plain(df)


@query
def revenue_total(src):
    """Measures without dimensions: one row."""
    df = _catalog(src).query(
        "mv_revenue_by_channel", ["Patient Count", "Total Revenue USD"]
    )
    return plain(df)


@query
def payer_segment_on_surface(src):
    """The uncertified view through a surface, with the notice column."""
    df = COMMERCIAL_AND_PAYER.query(
        _catalog(src),
        "mv_payer_segment_revenue",
        ["Patient Count", "Total Revenue USD"],
        ["Payer Segment"],
    )
    return plain(df)


@query
def join_key_check(src):
    return _catalog(src).join_check("mv_recurring_revenue")


ROLLED_UP = "mv_revenue_by_channel"


def stored_rollup(src: ParquetFolder) -> MetricRollup:
    """The states of the view's measures by all its dimensions, kept beside the layers."""
    store, catalog = layer_store(src), _catalog(src)
    dims = list(catalog.view(ROLLED_UP).dimensions)
    name = f"rollup_{ROLLED_UP}"
    return roll_up(catalog, ROLLED_UP, dims, store=lambda df: store.layer(name, lambda: df))


def _checked(exact: DataFrame, estimated: DataFrame, keys: list[str]) -> DataFrame:
    """Exact counts, and whether the estimates are within the sketches' bound."""
    both = exact.join(estimated.withColumnRenamed("Patient Count", "_estimate"), keys)
    near = within_bound("_estimate", "Patient Count").alias("estimate_within_bound")
    return both.select(*keys, "Patient Count", *[c for c in estimated.columns if c not in (*keys, "Patient Count")], near)


@query
def rollup_by_channel_year(src):
    """A stored roll-up asked at a coarser grouping: sums exact, distinct patients by union of sketches."""
    keys = ["Channel", "Year"]
    exact = _catalog(src).query(ROLLED_UP, ["Patient Count"], keys)
    measures = ["Patient Count", "Total Revenue USD", "Total Margin USD", "Avg Margin Pct"]
    return plain(_checked(exact, stored_rollup(src).query(measures, keys), keys), _QUOTIENTS)


@query
def rollup_by_device_in_quarter(src):
    """The same roll-up filtered by dimensions that the result doesn't have."""
    keys, where = ["Device Type"], {"Quarter": [1, 2], "Channel": "DTC"}
    exact = _catalog(src).query(ROLLED_UP, ["Patient Count"], keys, where)
    measures = ["Patient Count", "Total Recurring USD"]
    return plain(_checked(exact, stored_rollup(src).query(measures, keys, where), keys))


@query
def event_users_by_type(src):
    """Distinct users by event type: exact, and by uniting the sketches of every day and type."""
    day = F.col("ts").cast("date").alias("day")
    events = src.scan("events").select("user_id", "event_type", day)
    daily = distinct_rollup(events, ["event_type", "day"], {"users": "user_id"})
    estimated = daily.groupBy("event_type").agg(united("users").alias("_estimate"))
    exact = events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))
    return exact.join(estimated, "event_type").select(
        "event_type", "users", within_bound("_estimate", "users").alias("estimate_within_bound")
    )


# Question set ------------------------------------------------------------------------------------

_QUESTIONS = {
    "cycle_time_verify": lambda c: Q.cycle_time_verify(c, QUARTER, YEAR),
    "margin_by_channel": Q.margin_by_channel,
    "payer_segment_margin": Q.payer_segment_margin,
    "cycle_time_unfiltered": lambda c: Q.cycle_time_unfiltered(c, QUARTER, YEAR),
    "fastest_channel_device": lambda c: Q.fastest_combination(c, QUARTER, YEAR),
    "margin_all_quarters": Q.margin_all_quarters,
    "margin_latest_quarter": Q.margin_latest_quarter_corrected,
    "revenue_by_channel_device": lambda c: Q.revenue_by_channel_device(c, QUARTER, YEAR),
    "recurring_by_channel": Q.recurring_by_channel,
    "upfront_vs_recurring": lambda c: Q.upfront_vs_recurring(c, QUARTER, YEAR),
    "avg_recurring_by_device": Q.avg_recurring_by_device,
    "margin_by_region_device": Q.margin_by_region_device,
    "patients_by_channel": lambda c: Q.patients_by_channel(c, QUARTER, YEAR),
    "patients_placed_by_channel": lambda c: Q.patients_by_channel(c, QUARTER, YEAR, True),
    "cost_by_channel_quarter": lambda c: Q.cost_by_channel_quarter(c, YEAR),
    "ratio_vs_avg_margin": Q.ratio_vs_avg_margin,
}


def _register_questions() -> None:
    for name, ask in _QUESTIONS.items():

        def run(src, ask=ask):
            return plain(ask(_catalog(src)), {**_QUOTIENTS, "Avg Cycle Time Days": 6})

        _QUERIES[name] = run


_register_questions()


@query
def segment_speed_and_margin(src):
    catalog = _catalog(src)
    df = Q.segment_speed_and_margin(catalog)
    return plain(df, {"avg_cycle_days": 6, "avg_margin_pct": 6})


@query
def whatif_shift(src):
    return plain(Q.whatif_shift(_mart(src).gold_revenue_summary))


@query
def cycle_time_by_start_quarter(src):
    """Cycle time of the cohort that starts in the quarter, instead of the one that ends in it."""
    claims = S.claims(src)
    days = cycle_times(
        claims, "patient_id", "claim_type", "claim_date", M.INTAKE, M.PLACEMENT
    )
    cohort = days.filter(
        (F.quarter("start_date") == QUARTER) & (F.year("start_date") == YEAR)
    )
    who = S.customers(src).withColumn("patient_id", padded_key("PAT", "c_custkey"))
    return cycle_time_by(cohort.join(who, "patient_id"), "channel", "device_type", digits=2)


# Masks and governed reads ------------------------------------------------------------------------


def _people(src: ParquetFolder) -> DataFrame:
    return src.scan("customer", ["c_custkey", "c_name"])


@query
def mask_last4_query(src):
    return _people(src).select(
        "c_custkey",
        mask_last4("c_name").alias("masked"),
        mask_last4(F.col("c_custkey").cast("string")).alias("masked_short"),
        mask_last4_strict(F.col("c_custkey").cast("string")).alias("masked_strict"),
    )


@query
def mask_year_query(src):
    orders = src.scan("orders", ["o_orderkey", "o_orderdate"])
    day = F.col("o_orderdate").cast("date")
    return orders.select("o_orderkey", mask_dob_year(day).alias("masked"))


@query
def mask_redact_query(src):
    return _people(src).select("c_custkey", mask_redact("c_name").alias("masked"))


@query
def tokenize_key_query(src):
    return _people(src).select(
        tokenize_key(F.col("c_custkey").cast("string")).alias("token"),
        tokenize_key("c_name", salt="pepper").alias("salted_token"),
    )


@query
def sql_function_masks(src):
    """The masks as SQL functions; names are missing for some keys, and regions repeat the rule's."""
    register_sql_functions(src.spark)
    key = F.col("c_custkey")
    people = src.scan("customer").select(
        "c_custkey",
        F.when(key % 5 != 0, F.col("c_name")).alias("c_name"),
        F.element_at(F.array(*map(F.lit, gen.REGIONS)), (key % 3 + 1).cast("int")).alias("region"),
    )
    return people.selectExpr(
        "c_custkey",
        "mask_last4(c_name) AS last4",
        "mask_redact(c_name) AS redacted",
        "tokenize_key(c_name) AS token",
        "region_row_filter(region) AS in_region",
        "mask_dob_year(DATE '1990-06-15' + INT(c_custkey % 1000)) AS year_start",
    )


@query
def masks_of_missing(src):
    """NULL and short values under the masks."""
    name = F.when(F.col("c_custkey") % 5 != 0, F.substring("c_name", F.lit(1), (F.col("c_custkey") % 7).cast("int")))
    people = src.scan("customer").select("c_custkey", name.alias("name"))
    return people.select(
        "c_custkey",
        mask_last4("name").alias("last4"),
        mask_last4_strict("name").alias("strict"),
        mask_redact("name").alias("redacted"),
    )


@query
def surface_without_excluded(src):
    """Every dimension that a restricted surface offers of a view with a hidden one."""
    catalog = _catalog(src)
    dims = COMMERCIAL.dimensions(catalog, "mv_recognized_revenue")
    df = COMMERCIAL.query(catalog, "mv_recognized_revenue", ["Total Revenue USD"], sorted(dims))
    return plain(df)


@query
def sandbox_segments_masked(src):
    """The sandbox's own policy: keys of the payer segments are tokens for an analyst."""
    segments = M.payer_segments(_mart(src).gold_patients)
    return default_governance().secure(segments, SANDBOX_SCHEMA, SEGMENT_TABLE, ANALYST)


@query
def row_totals_query(src):
    """Gold tables with one row per raw one, beside the rows they should have."""
    mart = _mart(src)
    counted = F.count(F.lit(1)).alias("n")
    tables = {"gold_patients": "customer", "gold_hcp": "supplier"}
    return row_totals(
        {n: (getattr(mart, n), src.scan(t).agg(counted).scalar()) for n, t in tables.items()}
    )


@query
def ordered_by_ordinal(src):
    """A view sorted by the number of an output column, descending, then by name."""
    df = _catalog(src).query(
        "mv_revenue_by_channel", ["Total Revenue USD", "Patient Count"], ["Channel", "Device Type"],
        order_by=[-3, 1, 2], limit=4,
    )
    return plain(df)


@query
def region_rows(src):
    people = S.patients(src).select("patient_id", "region")
    return people.filter(region_row_filter("region", [VISIBLE_REGION, "ASIA"]))


def _governed(src: ParquetFolder, table: str, caller: Caller) -> DataFrame:
    gov = default_governance(regions=[VISIBLE_REGION])
    return gov.secure(getattr(_mart(src), table), CERTIFIED_SCHEMA, table, caller)


@query
def secure_patients_analyst(src):
    return plain(_governed(src, "gold_patients", ANALYST))


@query
def secure_patients_steward(src):
    return plain(_governed(src, "gold_patients", STEWARD))


@query
def secure_revenue_analyst(src):
    df = _governed(src, "gold_revenue_summary", ANALYST)
    return plain(df.select("patient_id", "month", "total_recognized_usd", "region"))


@query
def blocked_rows(src):
    gov = default_governance(regions=[VISIBLE_REGION])
    gold = _mart(src).gold_patients
    return gov.blocked_rows(gold, CERTIFIED_SCHEMA, "gold_patients", ANALYST)


@query
def token_join(src):
    """A masked caller joins two tables on the tokenised key: no row is lost."""
    people = _governed(src, "gold_patients", ANALYST).select(
        "patient_id", "device_category"
    )
    revenue = _governed(src, "gold_revenue_summary", ANALYST).select(
        "patient_id", "total_recognized_usd"
    )
    return plain(
        people.join(revenue, "patient_id")
        .groupBy("device_category")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct("patient_id").alias("patients"),
            F.sum("total_recognized_usd").alias("revenue_usd"),
        )
    )


@query
def entitled_patients(src):
    """Rows by an entitlement table: suppliers see the customers of their own region.

    The stored patients are partitioned by region, so the entitlement rows prune what is read.
    """
    entitlements = S.hcps(src).select(
        F.col("hcp_id").alias("principal"), F.col("region").alias("value")
    )
    people = _mart(src).silver_patients.select("patient_id", "region", "device_type")
    return entitled_rows(people, "region", entitlements, "HCP-000001")


# Grants ------------------------------------------------------------------------------------------


def _grants(src: ParquetFolder) -> DataFrame:
    key = F.col("c_custkey")
    return src.scan("customer").select(
        F.format_string("nation-%02d@example.com", "c_nationkey").alias("principal_id"),
        F.when(key % 4 == 0, "group").otherwise("user").alias("principal_type"),
        F.when(key % 3 == 0, "SCHEMA").when(key % 3 == 1, "TABLE").otherwise("VIEW").alias(
            "securable_type"
        ),
        F.concat(F.lit("main.analytics.t"), key.cast("string")).alias("securable_name"),
        F.when(key % 3 == 0, "USE_SCHEMA").otherwise("SELECT").alias("privilege"),
        F.expr(
            "CASE WHEN c_acctbal >= 0 THEN timestampadd(MINUTE, CAST(floor(c_acctbal) AS INT), "
            "TIMESTAMP '2024-01-01 00:00:00') END"
        ).alias("expires_at"),
        (key % 7 != 0).alias("_active"),
    )


@query
def active_grants(src):
    return G.active_grants(_grants(src), NOW)


@query
def grant_counts(src):
    return G.grant_counts(_grants(src), NOW)


@query
def grant_actions(src):
    return G.grant_actions(_grants(src), NOW)


@query
def expired_sweep(src):
    """The sweep as a new version of the grant table, read back."""
    path = f"{work_root(src.spark)}/grants-{uuid.uuid4().hex}"
    write_version(_grants(src), path, 1)
    write_version(G.deactivate_expired(read_version(src.spark, path), NOW), path, 2)
    return plain(read_version(src.spark, path))


@query
def audit_append(src):
    """Audit rows of one cycle, numbered after the highest id of the earlier log."""
    earlier = src.scan("supplier").select(F.col("s_suppkey").alias("audit_id"))
    rows = G.audit_rows(G.grant_actions(_grants(src), NOW), NOW)
    return plain(G.with_audit_id(rows, G.highest_audit_id(earlier), stage=staged))


@query
def reconcile_cycles(src):
    """The log after a cycle, a repeat of it, and a second cycle that logs what has changed since."""
    root = f"{work_root(src.spark)}/reconcile-{uuid.uuid4().hex}"
    control, log = f"{root}/control", f"{root}/audit"
    write_version(_grants(src), control, 1)
    for version, run, now in ((1, "first", NOW), (1, "first", NOW), (2, "second", LATER)):
        reconcile(src.spark, control, log, version, run, now, diff=True)
    return plain(RunLog(src.spark, log).read())


def event_log(src: ParquetFolder) -> RunLog:
    """The events as a log, compacted by day: written once for a state of the table."""
    files = input_fingerprint(src.spark, [f"{src.folder}/events.parquet"])
    name = hashlib.sha256(repr((files, code_fingerprint())).encode()).hexdigest()[:32]
    log = RunLog(src.spark, f"{work_root(src.spark)}/logs/{name}")
    rows = src.scan("events").select(
        F.col("event_id").alias("audit_id"),
        F.col("ts").cast("timestamp").alias("action_time"),
        F.col("event_type").alias("action"),
    )
    own = log.reservation("load") or log.reserve("load", rows.count())
    log.commit(own, rows)
    log.compact()
    return log


@query
def audit_hourly(src):
    """The last day of the log; folders of other days aren't read."""
    return plain(hourly_summary(event_log(src), AUDIT_NOW))


# Quality -----------------------------------------------------------------------------------------


@query
def grain_check_query(src):
    return grain_check(
        {
            "patients": (S.patients(src), ["patient_id"]),
            "hcps": (S.hcps(src), ["hcp_id"]),
            "claims": (S.claims(src), ["claim_id"]),
        }
    )


@query
def composite_grain(src):
    return grain_check(
        {"revenue_summary": (S.revenue_summary(src), ["patient_id", "month"])}
    )


@query
def fk_completeness(src):
    return completeness(S.patients(src), "referring_hcp_id", "enrolled_date")


@query
def hcp_distribution(src):
    return distributions(S.hcps(src), "segment_priority", "specialty", "role_type")


@query
def priority_distribution(src):
    return distribution(src.scan("orders"), "o_orderpriority")


@query
def cycle_time_check(src):
    """Cycle time by channel on the raw claims, ranked against the planted order."""
    claims = S.claims(src)
    days = cycle_times(claims, "patient_id", "claim_type", "claim_date", M.INTAKE, M.PLACEMENT)
    who = S.customers(src).withColumn("patient_id", padded_key("PAT", "c_custkey"))
    levels = cycle_time_by(days.join(who, "patient_id"), "channel", digits=2)
    return level_order(levels, "channel", "avg_days", ["DTC", "Pharmacy", "DME"])


@query
def margin_check(src):
    """Mean margin by channel on the raw revenue."""
    revenue = S.revenue_summary(src)
    levels = revenue.groupBy("channel").agg(
        F.round(F.avg("gross_margin_pct"), 2).alias("avg_margin"),
        F.count(F.lit(1)).alias("row_count"),
    )
    return level_order(levels, "channel", "avg_margin", ["DME", "Pharmacy", "DTC"])


# Generated seeds, one entity per key of a given table --------------------------------------------


def _patient_numbers(src: ParquetFolder) -> DataFrame:
    return src.scan("customer").select(F.col("c_custkey").alias("id"))


def _provider_numbers(src: ParquetFolder) -> DataFrame:
    return src.scan("supplier").select(F.col("s_suppkey").alias("id"))


def _generated(src: ParquetFolder) -> M.Seeds:
    numbers, providers = _patient_numbers(src), _provider_numbers(src)
    count = gen.dense_providers(providers)
    return M.Seeds(
        gen.generate_patients(numbers, count),
        gen.generate_hcps(providers),
        gen.generate_claims(numbers),
        gen.generate_revenue(numbers),
    )


@query
def seed_hcps(src):
    return _generated(src).hcps


@query
def seed_patients(src):
    return _generated(src).patients


@query
def seed_claims(src):
    return _generated(src).claims


@query
def seed_revenue(src):
    return plain(_generated(src).revenue_summary, {"margin_usd": 6})


@query
def seed_revenue_from_claims(src):
    made = _generated(src)
    return plain(gen.revenue_from_claims(made.claims, made.patients), {"margin_usd": 6})


@query
def seed_cycle_time(src):
    """Planted relation 1 on the generated claims."""
    claims = _generated(src).claims
    days = cycle_times(claims, "patient_id", "claim_type", "claim_date", M.INTAKE, M.PLACEMENT)
    who = claims.filter(F.col("claim_type") == M.INTAKE).select("patient_id", "channel")
    levels = cycle_time_by(days.join(who, "patient_id"), "channel", digits=2)
    return level_order(levels, "channel", "avg_days", ["DTC", "Pharmacy", "DME"])


@query
def seed_margin(src):
    """Planted relation 2 on the generated revenue."""
    revenue = _generated(src).revenue_summary
    levels = revenue.groupBy("channel").agg(
        F.round(F.avg("gross_margin_pct"), 2).alias("avg_margin"),
        F.count(F.lit(1)).alias("row_count"),
    )
    return level_order(levels, "channel", "avg_margin", ["DME", "Pharmacy", "DTC"])


def queries() -> dict[str, Query]:
    """Each query as a function of session and folder."""

    def bound(ask: Callable[[ParquetFolder], DataFrame]) -> Query:
        return lambda spark, folder: ask(ParquetFolder(prepare(spark, folder), folder))

    return {name: bound(ask) for name, ask in _QUERIES.items()}
