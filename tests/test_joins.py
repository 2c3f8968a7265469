"""The many-to-one join gives the plain join's rows for every kind of key."""

import pytest
from pyspark.sql import functions as F

from martkeeper.operators.joins import attach


def sides(spark, left, right):
    facts = spark.createDataFrame([(1,)], "n int").select("n", *[F.expr(e).alias(k) for k, e in left.items()])
    own = spark.createDataFrame([("x",)], "attr string").select("attr", *[F.expr(e).alias(k) for k, e in right.items()])
    return facts, own


@pytest.mark.parametrize(
    ("left", "right"),
    [
        ("CAST(1 AS DECIMAL(10,2))", "CAST(1 AS DECIMAL(10,4))"),
        ("1", "1.0D"),
        ("CAST(1 AS INT)", "CAST(1 AS BIGINT)"),
        ("-0.0D", "0.0D"),
        ("DATE '2024-01-01'", "DATE '2024-01-01'"),
        ("'a'", "'a'"),
    ],
)
@pytest.mark.parametrize("how", ["left", "inner"])
def test_equal_keys_of_other_types_match(spark, left, right, how):
    facts, own = sides(spark, {"k": left}, {"k": right})
    assert [r.attr for r in attach(facts, own, ["k"], how).collect()] == ["x"]


def test_several_keys_and_nulls(spark):
    facts = spark.createDataFrame([(1, None, 1), (2, "a", 1), (3, "a", 2)], "n int, k string, m int")
    own = spark.createDataFrame([(None, 1, "none"), ("a", 1, "one")], "k string, m int, attr string")
    plain = {r.n: r.attr for r in attach(facts, own, ["k", "m"]).collect()}
    assert plain == {1: None, 2: "one", 3: None}
    safe = {r.n: r.attr for r in attach(facts, own, ["k", "m"], null_safe=True).collect()}
    assert safe == {1: "none", 2: "one", 3: None}


def test_key_keeps_its_type_in_the_shuffle(spark):
    facts = spark.range(10).withColumnRenamed("id", "k")
    own = facts.groupBy("k").agg(F.count("*").alias("n"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = attach(facts, own, ["k"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "cast(k" not in plan and "as string" not in plan
