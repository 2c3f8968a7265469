"""Facts in buckets by patient: no exchange of the facts, and a way back where a key is large."""

import re

import pytest
from pyspark.sql import functions as F

from martkeeper.plans import medallion as M
from martkeeper.plans import registry
from martkeeper.sources import stored
from martkeeper.sources.stored import LayerStore
from martkeeper.sources.tables import ParquetFolder


@pytest.fixture()
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture()
def bucketed_mart(no_broadcast, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(stored, "BUCKET_ROWS", 1)
    monkeypatch.setattr(registry, "code_fingerprint", lambda: str(tmp_path))
    return registry._mart(ParquetFolder(no_broadcast, folder))


def exchanged(df):
    """The scans below an exchange of the planned query: the layer of a bucketed one, else "plain"."""
    found, above = [], []
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        at = len(line) - len(line.lstrip(" :+-"))
        above = [d for d in above if d < at]
        if "Exchange hashpartitioning" in line:
            above.append(at)
        if "FileScan" in line and above:
            name = re.search(r"layer_(\w+?)_[0-9a-f]{32}", line)
            found.append(name[1] if name else "plain")
    return found


def test_joins_and_rollups_of_bucketed_facts_exchange_no_facts(spark, bucketed_mart, folder):
    claims = bucketed_mart.silver_claims
    assert "Bucketed: true" in claims._jdf.queryExecution().executedPlan().toString()
    assert exchanged(claims) == ["plain"]  # the patients
    patients = M.gold_patients(
        bucketed_mart.silver_patients, bucketed_mart.bronze_claims, bucketed_mart.bronze_revenue_summary, registry.AS_OF)
    assert exchanged(patients) == ["plain"]
    plain = registry.queries()["silver_claims"](spark, folder)
    again = registry.plain(claims)
    assert plain.columns == again.columns
    assert plain.exceptAll(again).isEmpty() and again.exceptAll(plain).isEmpty()


def store(spark, folder):
    return LayerStore(spark, "f", str(folder), bucket_by={"t": "k"})


def test_a_large_key_keeps_the_layer_out_of_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stored, "BUCKET_ROWS", 1)
    hot = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
        F.col("id").cast("string")).alias("k"), "id")
    one = store(spark, tmp_path)
    assert one.layer("t", lambda: hot).count() == 900 and not one.bucketed("t")
    even = spark.range(900).select((F.col("id") % 300).cast("string").alias("k"), "id")
    two = store(spark, tmp_path / "even")
    df = two.layer("t", lambda: even)
    assert two.bucketed("t") and df.columns == ["k", "id"] and df.count() == 900
    assert "Exchange" not in df.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()


def test_small_and_empty_layers_stay_as_they_are(spark, tmp_path, monkeypatch):
    small = store(spark, tmp_path)
    assert small.layer("t", lambda: spark.range(9).selectExpr("id AS k")).count() == 9
    assert not small.bucketed("t")
    monkeypatch.setattr(stored, "BUCKET_ROWS", 0)
    empty = store(spark, tmp_path / "empty")
    assert empty.layer("t", lambda: spark.range(0).selectExpr("id AS k")).count() == 0


def test_another_application_finds_the_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stored, "BUCKET_ROWS", 1)
    rows = spark.range(400).selectExpr("id % 100 AS k", "CAST(id AS DECIMAL(10,2)) AS `a b`")
    first = store(spark, tmp_path).layer("t", lambda: rows)
    name = next(t.name for t in spark.catalog.listTables() if t.name.startswith("layer_t_") and str(tmp_path) in str(
        spark.sql(f"DESCRIBE EXTENDED {t.name}").filter("col_name = 'Location'").first()))
    spark.sql(f"DROP TABLE {name}")  # the files of an external table stay
    second = store(spark, tmp_path).layer("t", lambda: None)
    assert second.exceptAll(first.sparkSession.createDataFrame(rows.collect(), rows.schema)).isEmpty()
    assert "Exchange" not in second.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
