"""The layers on generated seeds: the planted relations, counts and grains hold."""

from datetime import date, datetime

import pytest
from compare import plan_text
from pyspark.sql import functions as F

from martkeeper.operators import quality
from martkeeper.operators.milestones import cycle_time_by, cycle_times
from martkeeper.plans import medallion as M
from martkeeper.plans import questions as Q
from martkeeper.plans.views import COMMERCIAL, COMMERCIAL_AND_PAYER, mart_tables, metric_catalog
from martkeeper.sources import seeds as gen

BATCH, AS_OF = datetime(2026, 8, 1), date(2026, 8, 1)


@pytest.fixture(scope="module")
def raw(spark):
    people = spark.range(300)
    made = M.Seeds(
        gen.generate_patients(people, 120),
        gen.generate_hcps(spark.range(120)),
        gen.generate_claims(people),
        gen.generate_revenue(people),
    )
    return M.Seeds(**{n: getattr(made, n).cache() for n in M.Seeds.__dataclass_fields__})


@pytest.fixture(scope="module")
def mart(spark, raw, tmp_path_factory):
    return M.materialize(spark, raw, str(tmp_path_factory.mktemp("mart")), BATCH, AS_OF)


@pytest.fixture(scope="module")
def catalog(spark, mart):
    return metric_catalog(spark, mart_tables(mart))


def test_row_totals_and_grain(raw, mart):
    totals = quality.row_totals({
        "hcps": (raw.hcps, 120), "patients": (raw.patients, 300), "claims": (raw.claims, 4200),
        "revenue_summary": (raw.revenue_summary, 3600), "gold_patients": (mart.gold_patients, 300),
        "gold_claims": (mart.gold_claims, 3900), "gold_hcp": (mart.gold_hcp, 120),
        "gold_revenue_summary": (mart.gold_revenue_summary, 3600),
    })
    assert all(r.as_expected for r in totals.collect())
    grain = quality.grain_check({
        "hcps": (raw.hcps, ["hcp_id"]), "patients": (raw.patients, ["patient_id"]),
        "claims": (raw.claims, ["claim_id"]),
        "revenue_summary": (raw.revenue_summary, ["patient_id", "month"]),
    })
    assert all(r.grain_ok for r in grain.collect())


def test_seed_rules(raw):
    assert raw.hcps.filter("trx_12m < nbrx_12m + 20 OR nbrx_12m NOT BETWEEN 5 AND 50").count() == 0
    assert quality.completeness(raw.patients, "referring_hcp_id").first().complete
    assert raw.patients.filter("ssn NOT RLIKE '^[0-9]{3}-[0-9]{2}-[0-9]{4}$'").count() == 0
    orphan = raw.patients.join(raw.hcps, F.col("referring_hcp_id") == F.col("hcp_id"), "left")
    assert orphan.filter("hcp_id IS NULL").count() == 0
    same = (
        raw.patients.alias("p").join(raw.hcps.alias("h"), F.expr("p.referring_hcp_id = h.hcp_id"))
        .agg(F.avg((F.col("p.region") == F.col("h.region")).cast("int"))).first()[0]
    )
    assert 0.73 < same < 0.93  # 75 % by affinity and a third of the rest by chance
    counts = {r.region: r["count"] for r in raw.hcps.groupBy("region").count().collect()}
    assert counts == {"US West": 40, "US South": 40, "US East": 40}


def test_schema_of_the_seeds(raw):
    assert dict(raw.claims.dtypes) == {
        "claim_id": "string", "patient_id": "string", "claim_date": "date", "claim_type": "string",
        "channel": "string", "product_line": "string", "product_sku": "string",
        "claim_amount_usd": "double", "units": "int"}
    assert dict(raw.revenue_summary.dtypes)["month"] == "date"


def test_cycle_days_within_planted_ranges(raw):
    days = cycle_times(raw.claims, "patient_id", "claim_type", "claim_date", M.INTAKE, M.PLACEMENT)
    who = raw.claims.filter(F.col("claim_type") == M.INTAKE).select("patient_id", "channel")
    joined = days.join(who, "patient_id")
    for channel, (low, high) in gen.CYCLE_DAYS.items():
        outside = joined.filter((F.col("channel") == channel)
                                & ~F.col("cycle_days").between(low, high))
        assert outside.count() == 0
    ranked = quality.level_order(cycle_time_by(joined, "channel"), "channel", "avg_days",
                                 ["DTC", "Pharmacy", "DME"])
    assert all(r.as_expected for r in ranked.collect())


def test_revenue_from_claims_equals_direct(raw):
    again = gen.revenue_from_claims(raw.claims, raw.patients)
    assert again.exceptAll(raw.revenue_summary).count() == 0
    assert again.count() == 3600


def test_more_patients_than_a_task(spark):
    few, many = spark.range(0, 500, 1, 1), spark.range(0, 500, 1, 16)
    assert gen.generate_claims(few).exceptAll(gen.generate_claims(many)).count() == 0
    tiny = gen.generate_patients(spark.range(50), 2).select("referring_hcp_id").distinct()
    assert {r[0] for r in tiny.collect()} <= {"HCP-000000", "HCP-000001"}


def test_gold_values(mart, raw):
    p = mart.gold_patients
    per_device = {r.device_type: r.t for r in p.groupBy("device_type").agg(
        F.max("total_upfront_12m").alias("t")).collect()}
    assert per_device == {"Mobi": 4500.0, "t:slim X2": 5400.0}
    assert p.filter("total_upfront_12m NOT IN (4500, 5400)").count() == 0
    offsets = {r.o for r in mart.gold_claims.select(
        F.col("month_offset_from_placement").alias("o")).distinct().collect()}
    assert offsets == set(range(13))
    off = mart.silver_revenue_summary.filter("abs(margin_usd - margin_calculated_usd) > 1e-6")
    assert off.count() == 0
    check = mart.gold_patients.join(mart.gold_claims.filter("claim_type = 'pump_on_body'").select(
        "patient_id", "claim_date"), "patient_id").filter("claim_date <> pump_on_body_date")
    assert check.count() == 0
    referred = mart.gold_hcp.agg(F.sum("patients_referred")).first()[0]
    assert referred == 300


def test_lazy_and_materialized_agree(raw, mart):
    lazy = M.build(raw, BATCH, AS_OF)
    for name in M.LAYERS:
        a, b = lazy.tables()[name], mart.tables()[name]
        assert sorted(a.columns) == sorted(b.columns), name
        assert a.select(b.columns).exceptAll(b).count() == 0, name


def test_question_answers(catalog):
    margin = {r.Channel: r.gross_margin_pct for r in Q.margin_by_channel(catalog).collect()}
    assert margin == {"DTC": 50.0, "Pharmacy": 45.0, "DME": 40.0}
    payer = {r["Payer Segment"]: r.avg_gross_margin_pct
             for r in Q.payer_segment_margin(catalog).collect()}
    assert payer == {"Cash-pay": 50.0, "Commercial": 45.0, "Medicare": 40.0}
    cycle = Q.cycle_time_verify(catalog, 1, 2026).collect()
    assert cycle[0].Channel == "DTC" and 15 <= cycle[0].avg_cycle_days <= 35
    best = {r["Payer Segment"]: (r.is_fastest, r.is_best_margin)
            for r in Q.segment_speed_and_margin(catalog).collect()}
    assert best == {"Cash-pay": (True, True), "Commercial": (False, False),
                    "Medicare": (False, False)}
    assert Q.fastest_combination(catalog, 1, 2026).count() == 1
    latest = Q.margin_latest_quarter_corrected(catalog)
    newest = catalog.tables.get("gold_revenue_summary").agg(
        F.max(F.struct("year_num", "quarter_num"))).first()[0]
    assert {(r.Year, r.Quarter) for r in latest.collect()} == {tuple(newest)}


def test_surfaces(catalog):
    from martkeeper.operators.metrics import MetricError

    with pytest.raises(MetricError):
        COMMERCIAL.query(catalog, "mv_recognized_revenue", ["Upfront USD"], ["Patient Id"])
    with pytest.raises(MetricError):
        COMMERCIAL.query(catalog, "mv_payer_segment_revenue", ["Patient Count"])
    df = COMMERCIAL_AND_PAYER.query(
        catalog, "mv_payer_segment_revenue", ["Patient Count"], ["Payer Segment"])
    assert "_uncertified" in df.columns
    kinds = {r.name: (r.type, r.certified) for r in catalog.tables.describe().collect()}
    views = [n for n, (kind, _) in kinds.items() if kind == "METRIC_VIEW"]
    assert len(views) == 7 and kinds["mv_payer_segment_revenue"] == ("METRIC_VIEW", False)


def test_whatif_shifts_toward_the_richer_channel(mart):
    row = Q.whatif_shift(mart.gold_revenue_summary).first()
    expected = row.moved_revenue * 0.10  # DTC earns 50 %, DME 40 %
    assert row.margin_pct_after > row.margin_pct_before
    assert abs(row.margin_change - expected) < 0.02


def test_questions_prune_partitions_and_columns(catalog):
    plan = plan_text(Q.cycle_time_verify(catalog, 1, 2026))
    assert "quarter_num" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(claim_type,pump_on_body)" in plan
    assert "claim_amount_usd" not in plan.split("ReadSchema: ")[1].split("\n")[0]
