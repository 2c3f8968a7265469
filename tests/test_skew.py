"""A key with a third of the rows is spread over several tasks, and no row is lost."""

import pytest
from pyspark.sql import functions as F

from martkeeper.operators.conform import dedup_latest
from martkeeper.operators.joins import attach
from martkeeper.operators.periods import running_totals
from martkeeper.plans import medallion as M

ROWS = 60_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture()
def large_cluster(spark):
    """Limits scaled down so that small data behaves as large data would."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture()
def claims(large_cluster, tmp_path):
    spark = large_cluster
    hot = F.when(F.col("id") % 3 == 0, F.lit("PAT-HOT")).otherwise(
        F.concat(F.lit("PAT-"), (F.col("id") % 500).cast("string")))
    kinds = F.array(F.lit(M.INTAKE), F.lit(M.PLACEMENT), F.lit(M.SHIPMENT))
    spark.range(0, ROWS, 1, 8).select(
        F.concat(F.lit("C"), (F.col("id") % 50_000).cast("string")).alias("claim_id"),
        hot.alias("patient_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 700).cast("int")).alias(
            "claim_date"),
        F.element_at(kinds, (F.pmod(F.xxhash64("id"), F.lit(3)) + 1).cast("int")).alias(
            "claim_type"),
        F.lit("DTC").alias("channel"),
        F.lit("l").alias("product_line"),
        F.lit("s").alias("product_sku"),
        (F.col("id") % 97).cast("double").alias("claim_amount_usd"),
        F.lit(1).alias("units"),
    ).write.parquet(str(tmp_path / "claims"))
    return spark.read.parquet(str(tmp_path / "claims"))


@pytest.fixture()
def people(claims):
    return claims.select("patient_id").distinct().select(
        "patient_id", F.lit("Mobi").alias("device_type"), F.lit("US West").alias("region"))


def splits(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString().count("skew=true")


def test_claims_of_a_hot_patient(claims, people):
    silver = M.silver_claims(M.bronze("claims", claims, "2025-01-01 00:00:00"), people)
    rows, split = splits(silver)
    assert len(rows) == ROWS and split >= 1
    by = {}
    for r in claims.groupBy("patient_id", "claim_type").agg(F.min("claim_date").alias("d")).collect():
        by[(r.patient_id, r.claim_type)] = r.d
    assert all(
        r.days_to_pump_on_body
        == (by[(r.patient_id, M.PLACEMENT)] - by[(r.patient_id, M.INTAKE)]).days
        for r in rows
    )
    gold, split = splits(M.gold_claims(M.kept_claims(silver)))
    wanted = claims.filter(F.col("claim_type") != M.INTAKE).select("claim_id").distinct().count()
    assert len(gold) == wanted and split >= 1


def test_running_totals_of_a_hot_key(claims):
    facts = claims.select("patient_id", "claim_date", "units")
    out = running_totals(
        facts, ["patient_id"], "claim_date", {"t": "units"}, one_row_per_period=False)
    rows, _ = splits(out)  # joined on key and date, so the hot key is already spread
    assert len(rows) == ROWS
    assert max(r.t for r in rows if r.patient_id == "PAT-HOT") == ROWS // 3


def test_copies_are_dropped_before_the_shuffle(large_cluster):
    """A third of the rows are copies of one row: a map task sends one of them."""
    spark = large_cluster
    df = spark.range(0, ROWS, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit("copy")).otherwise(F.col("id").cast("string")).alias("k"),
        F.lit("x").alias("v"),
    )
    out = dedup_latest(df, ["k"], [])
    assert out.count() == ROWS - ROWS // 3 + 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2  # before and after the exchange
    before_shuffle = plan.split("Exchange")[1]
    assert "Partial" in before_shuffle and "WindowGroupLimit" in before_shuffle


@pytest.mark.parametrize("null_safe, matched", [(False, 2), (True, 3)])
def test_attach_and_null_keys(spark, null_safe, matched):
    facts = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    attributes = spark.createDataFrame([(1, 10), (None, 30), (9, 90)], "k int, x int")
    out = attach(facts, attributes, ["k"], null_safe=null_safe)
    assert out.columns == ["k", "v", "x"] and out.count() == 4
    assert out.filter("x IS NOT NULL").count() == matched
    assert attach(facts, attributes, ["k"], "inner", null_safe).count() == matched
