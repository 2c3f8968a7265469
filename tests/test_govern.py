from datetime import date

import pytest
from pyspark.sql import functions as F

from martkeeper.functions.masks import mask_last4, region_row_filter
from martkeeper.operators.govern import (
    Caller,
    ColumnTag,
    Governance,
    GovernanceError,
    Policy,
    default_governance,
    entitled_rows,
    parse_principals,
)

ANALYST, STEWARD = Caller("a@example.com"), Caller("s@example.com", ("stewards",))
PEOPLE = [
    ("PAT-1", "521-84-7793", date(1980, 5, 6), "Ann", "US West"),
    ("PAT-2", None, date(1990, 1, 1), None, "US West"),
    ("PAT-3", "111-11-1111", None, "Cid", "US East"),
    ("PAT-4", "222-22-2222", None, "Dee", None),
]


@pytest.fixture()
def people(spark):
    return spark.createDataFrame(
        PEOPLE, "patient_id string, ssn string, dob date, patient_name string, region string")


def test_principals():
    assert parse_principals(" a , b,, ") == ["a", "b"] and parse_principals("") == []


def test_masks_and_row_filter(people):
    gov = default_governance()
    seen = gov.secure(people, "analytics", "gold_patients", ANALYST)
    assert seen.schema == people.schema or seen.dtypes == people.dtypes
    got = {r.ssn: r for r in seen.collect()}
    assert set(got) == {"***-**-7793", None}
    row = got["***-**-7793"]
    assert (row.dob, row.patient_name, len(row.patient_id)) == (date(1980, 1, 1), "[Redacted]", 64)
    assert got[None].patient_name is None
    assert gov.secure(people, "analytics", "gold_patients", STEWARD).count() == 4
    assert gov.secure(people, "other", "gold_patients", ANALYST).count() == 4


def test_callers_filters_see_masked_values_only(people):
    seen = default_governance().secure(people, "analytics", "gold_patients", ANALYST)
    assert seen.filter("ssn = '521-84-7793' OR patient_name = 'Ann'").count() == 0
    assert seen.filter("region = 'US East'").count() == 0
    assert seen.filter("ssn = '***-**-7793'").count() == 1


def test_blank_exemption_masks_everyone(people):
    gov = default_governance(exempt=parse_principals(""))
    assert gov.secure(people, "analytics", "gold_patients", STEWARD).count() == 2


def test_blocked_rows_count_unknown_regions(people):
    gov = default_governance()
    row = gov.blocked_rows(people, "analytics", "gold_patients", ANALYST).first()
    assert tuple(row) == (4, 2, 2)
    row = gov.blocked_rows(people, "analytics", "gold_patients", STEWARD).first()
    assert tuple(row) == (4, 4, 0)


def test_token_join_loses_no_row(spark, people):
    facts = spark.createDataFrame(
        [("PAT-1", 1), ("PAT-1", 2), ("PAT-2", 3), ("PAT-3", 4)], "patient_id string, x int")
    gov = default_governance(regions=["US West", "US East"])
    left = gov.secure(people, "analytics", "gold_patients", ANALYST)
    right = gov.secure(facts, "analytics", "gold_claims", ANALYST)
    assert left.join(right, "patient_id").count() == people.join(facts, "patient_id").count() == 4
    sandbox = gov.secure(people.select("patient_id"), "sandbox", "patient_payer_segment", ANALYST)
    assert sandbox.join(right, "patient_id").count() == 4
    raw = people.select("patient_id").join(right, "patient_id")
    assert raw.count() == 0


def test_validation(people):
    gov = Governance({"pii": ["ssn"]})
    with pytest.raises(GovernanceError):
        gov.classify(ColumnTag("t", "ssn", "pii", "nope"))
    with pytest.raises(GovernanceError):
        gov.classify(ColumnTag("t", "nope", "pii", "ssn"), people.columns)
    with pytest.raises(GovernanceError):
        gov.add_policy(Policy("p", "s", "mask", mask_last4, "pii", "nope"))
    with pytest.raises(GovernanceError):
        gov.add_policy(Policy("p", "s", "other", mask_last4, "pii", "ssn"))
    gov.classify(ColumnTag("t", "ssn", "pii", "ssn"), people.columns)
    gov.add_policy(Policy("p", "s", "mask", mask_last4, "pii", "ssn"))
    gov.add_policy(Policy("q", "s", "mask", mask_last4, "pii", "ssn"))
    with pytest.raises(GovernanceError):
        gov.secure(people, "s", "t", ANALYST)


def test_mask_of_another_type_is_refused(spark):
    gov = Governance({"k": ["v"]})
    gov.classify(ColumnTag("t", "d", "k", "v"))
    gov.add_policy(Policy("p", "s", "mask", lambda c: F.date_trunc("YEAR", c), "k", "v"))
    df = spark.createDataFrame([(date(2020, 2, 29),)], "d date")
    with pytest.raises(GovernanceError, match="into timestamp"):
        gov.secure(df, "s", "t", ANALYST)
    gov.add_policy(Policy("p", "s", "mask", lambda c: F.trunc(c, "YEAR"), "k", "v"))
    assert gov.secure(df, "s", "t", ANALYST).first().d == date(2020, 1, 1)


def test_metadata_tables_and_coverage(spark, people):
    gov = default_governance()
    assert gov.taxonomy_df(spark).count() == 5
    assert gov.tags_df(spark).count() == 8
    gaps = gov.coverage_gaps(
        spark, {"gold_patients": people, "gold_claims": people.select("patient_id", "region")})
    assert [tuple(r) for r in gaps.collect()] == [
        ("gold_claims", "region", "access_scope", "region", "gold_patients")]


def test_entitlements(spark, people):
    allowed = spark.createDataFrame(
        [("a", "US West"), ("a", "US West"), ("b", "US East")], "principal string, value string")
    assert entitled_rows(people, "region", allowed, "a").count() == 2
    assert entitled_rows(people, "region", allowed, "c").count() == 0


def test_row_filter_reaches_the_scan(spark, people, tmp_path):
    path = str(tmp_path / "people")
    people.write.parquet(path)
    seen = default_governance().secure(
        spark.read.parquet(path), "analytics", "gold_patients", ANALYST)
    plan = seen.filter(F.col("patient_name") == "[Redacted]")._jdf.queryExecution().executedPlan()
    assert "EqualTo(region,US West)" in plan.toString()
    assert spark.read.parquet(path).filter(region_row_filter("region", ["x", "US East"])).count() == 1
