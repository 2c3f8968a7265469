"""Amounts, grain and survivors of the layers don't depend on how rows arrive."""

from pyspark.sql import functions as F

from martkeeper.operators.govern import Caller, ColumnTag, Governance, GovernanceError, Policy
from martkeeper.operators.metrics import MetricView
from martkeeper.plans import medallion as M
from martkeeper.plans.views import mart_tables, metric_catalog
from martkeeper.session import RECOMMENDED, prepare
from martkeeper.sources import seeds as gen
from martkeeper.sources.ingest import with_ingest_metadata

import pytest

BATCH, AS_OF = "2026-08-01 00:00:00", "2026-08-01"


def seeds(spark, parts=3):
    people = spark.range(0, 60, 1, parts)
    return M.Seeds(
        gen.generate_patients(people, 12), gen.generate_hcps(spark.range(12)),
        gen.generate_claims(people), gen.generate_revenue(people),
    )


def test_sums_are_equal_over_any_partitions(spark):
    def sums(parts):
        gold = M.build(seeds(spark, parts), BATCH, AS_OF).gold_revenue_summary
        rows = gold.repartition(parts).groupBy("channel").agg(
            F.sum("margin_usd").alias("m"), F.sum("total_recognized_usd").alias("t"))
        return {r.channel: (r.m, r.t) for r in rows.collect()}

    assert sums(3) == sums(7) == sums(13)


def test_a_doubled_load_counts_once(spark):
    once = seeds(spark)
    twice = M.Seeds(once.patients, once.hcps, once.claims, once.revenue_summary.union(once.revenue_summary))
    one, two = (M.build(s, BATCH, AS_OF).silver_revenue_summary for s in (once, twice))
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_tied_versions_of_a_patient_leave_one_for_sure(spark):
    made = seeds(spark)
    other = made.patients.withColumn("region", F.lit("US East")).withColumn("ssn", F.lit("1-1-1"))
    kept = []
    for both in (made.patients.union(other), other.union(made.patients)):
        silver = M.silver_patients(with_ingest_metadata(both, "s", BATCH, True, True))
        kept.append({tuple(r) for r in silver.drop("_loaded_at").collect()})
    assert kept[0] == kept[1] and len(kept[0]) == 60


def test_views_read_the_same_columns_lazy_and_stored(spark, tmp_path):
    lazy = M.build(seeds(spark), BATCH, AS_OF)
    stored = M.materialize(spark, seeds(spark), str(tmp_path / "mart"), BATCH, AS_OF)
    view = MetricView(
        name="mv_offsets", source="gold_claims", dimensions={"Offset": "month_offset_from_placement"},
        measures={"Claim Count": "COUNT(1)"}, comment="Claims by month since the placement.",
    )
    answers = []
    for mart in (lazy, stored):
        catalog = metric_catalog(spark, mart_tables(mart))
        assert set(catalog.tables.get("gold_claims").columns) == set(mart.gold_claims.columns)
        catalog.define(view)
        answers.append({tuple(r) for r in catalog.query("mv_offsets", ["Claim Count"], ["Offset"]).collect()})
    assert answers[0] == answers[1] and len(answers[0]) > 2


def test_providers_must_be_dense(spark):
    numbers = spark.range(1, 5)
    with pytest.raises(Exception, match="without gaps"):
        spark.range(1).select(gen.dense_providers(numbers)).collect()


def test_tags_ignore_case_and_masks_keep_the_type(spark):
    gov = Governance({"pii": ["ssn"]})
    gov.classify(ColumnTag("People", "SSN", "pii", "ssn"), ["ssn"])
    gov.add_policy(Policy("p", "s", "mask", lambda c: F.concat(F.lit("*"), c), "pii", "ssn"))
    people = spark.createDataFrame([("1",)], "ssn string")
    assert gov.secure(people, "s", "people", Caller("u")).collect()[0][0] == "*1"
    assert gov.coverage_gaps(spark, {"people": people}).isEmpty()
    gov.add_policy(Policy("p", "s", "mask", lambda c: F.length(c), "pii", "ssn"))
    with pytest.raises(GovernanceError, match="into int"):
        gov.secure(people, "s", "people", Caller("u"))


def test_a_bare_session_is_prepared(spark, folder):
    bare = spark.newSession()
    bare.conf.set("spark.sql.shuffle.partitions", "4")
    bare.conf.unset("spark.sql.adaptive.forceOptimizeSkewedJoin")
    prepare(bare, folder)
    assert all(bare.conf.get(k) == v for k, v in RECOMMENDED.items())
    assert bare.conf.get("spark.sql.shuffle.partitions") == "4"


def test_provider_roll_up_aggregates_by_hashing(spark, folder):
    from martkeeper.plans.standins import StandinSeeds
    from martkeeper.sources.tables import ParquetFolder

    people = StandinSeeds(ParquetFolder(spark, folder)).patients
    assert "SortAggregate" not in people._jdf.queryExecution().executedPlan().toString()
