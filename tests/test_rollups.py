"""Roll-ups of states, and windows over keys that are split."""

import pytest
from pyspark.sql import functions as F

from martkeeper.operators import periods
from martkeeper.operators.metrics import MetricCatalog, MetricError, MetricView
from martkeeper.operators.sketches import distinct_rollup, relative_error, roll_up, united
from martkeeper.sources.tables import TableRegistry


@pytest.fixture(scope="module")
def catalog(spark):
    table = spark.range(40_000).select(
        (F.col("id") % 7).cast("string").alias("a"), (F.col("id") % 11).alias("b"),
        F.when(F.col("id") % 5 > 0, F.pmod(F.xxhash64("id"), F.lit(9_000))).alias("who"),
        F.when(F.col("id") % 3 > 0, (F.col("id") % 100).cast("decimal(10,2)")).alias("money"),
    )
    registry = TableRegistry(spark)
    registry.put("t", table)
    catalog = MetricCatalog(registry)
    catalog.define(MetricView(
        "v", "t", {"A": "a", "B": "b"},
        {"who": "COUNT(DISTINCT who)", "rows": "COUNT(1)", "sum": "SUM(money)", "mean": "AVG(money)",
         "least": "MIN(money)", "share": "TRY_DIVIDE(CAST(SUM(money) AS DOUBLE), COUNT(1)) * 100",
         "odd": "PERCENTILE(money, 0.5)", "nested": "SUM(COALESCE(money, 0) + 1)"},
        filter="b <> 3"))
    return catalog


EXACT = ["rows", "sum", "least", "share", "nested"]


@pytest.mark.parametrize("dims, where", [([], None), (["A"], None), (["B"], {"A": ["1", "2"]}), (["A", "B"], {"B": 4})])
def test_coarser_groupings_of_a_rollup(spark, catalog, dims, where):
    kept = roll_up(catalog, "v", ["A", "B"], [*EXACT, "mean", "who"])
    direct = catalog.query("v", EXACT, dims, where)
    rolled = kept.query(EXACT, dims, where)
    assert direct.schema.simpleString() == rolled.schema.simpleString()
    assert direct.exceptAll(rolled).isEmpty() and rolled.exceptAll(direct).isEmpty()
    both = catalog.query("v", ["who", "mean"], dims, where).join(
        kept.query(["who", "mean"], dims, where).withColumnsRenamed({"who": "w", "mean": "m"}), dims or F.lit(True))
    for r in both.collect():
        assert abs(r.w - r.who) <= 4 * relative_error() * r.who and abs(float(r.m - r["mean"])) < 1e-5


def test_the_states_are_one_pass_and_sums_of_counts_would_be_wrong(spark, catalog):
    kept = roll_up(catalog, "v", ["A", "B"], ["who"])
    plan = kept.states._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Expand" not in plan
    summed = catalog.query("v", ["who"], ["A", "B"]).agg(F.sum("who")).first()[0]
    exact = catalog.query("v", ["who"]).first()[0]
    assert summed > 3 * exact > 2 * kept.query(["who"]).first()[0]


def test_what_a_rollup_refuses(catalog):
    with pytest.raises(MetricError, match="odd"):
        roll_up(catalog, "v", ["A"])
    kept = roll_up(catalog, "v", ["A"], ["sum"])
    for measures, dims, where in ((["rows"], [], None), (["sum"], ["B"], None), (["sum"], [], {"B": 1})):
        with pytest.raises(MetricError, match="keeps no"):
            kept.query(measures, dims, where)
    with pytest.raises(MetricError, match="unknown measure"):
        roll_up(catalog, "v", ["A"], ["none"])


def test_sketches_of_nothing(spark):
    empty = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    got = distinct_rollup(empty, ["k"], {"s": "v"}).groupBy("k").agg(united("s").alias("n")).collect()
    assert {(r.k, r.n) for r in got} == {(1, 0), (2, 1)}
    assert distinct_rollup(empty.limit(0), [], {"s": "v"}).agg(united("s").alias("n")).first().n == 0


# Split windows -------------------------------------------------------------------------------


@pytest.fixture()
def hot(spark):
    """A key with most of the rows, each at an instant of its own; gaps, NULL values and a NULL key."""
    return spark.range(0, 60_000, 1, 5).select(
        F.when(F.col("id") % 10 < 8, F.lit("hot")).when(F.col("id") % 10 == 8, F.lit(None)).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("key"),
        (F.pmod(F.xxhash64("id"), F.lit(10**12)) * 60_000 + F.col("id")).alias("at"),
        F.when(F.col("id") % 13 > 0, (F.col("id") % 101).cast("decimal(12,2)")).alias("v"),
    )


def test_running_totals_of_a_split_key(spark, hot, monkeypatch):
    facts = hot.union(hot.filter("v > 50"))  # some instants occur twice
    one = periods.running_totals(facts, ["key"], "at", {"t": "v"}, one_row_per_period=False)
    monkeypatch.setattr(periods, "WINDOW_ROWS", 1_000)
    parts = []
    split = periods.split_by_range
    monkeypatch.setattr(periods, "split_by_range", lambda *a: parts.append(split(*a)) or parts[-1])
    two = periods.running_totals(facts, ["key"], "at", {"t": "v"}, one_row_per_period=False)
    assert one.schema.simpleString() == two.schema.simpleString()
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()
    sizes = [r["count"] for r in parts[0].filter("key = 'hot'").groupBy(periods.PART).count().collect()]
    assert len(sizes) >= 3 and max(sizes) < 0.6 * sum(sizes)


def test_growth_of_a_split_key(spark, hot):
    one = periods.with_growth(hot, ["key"], "at", "v", "g", "p")
    two = periods.with_growth(hot, ["key"], "at", "v", "g", "p", split=True)
    assert one.columns == two.columns == ["key", "at", "v", "g", "p"]
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


@pytest.mark.parametrize("split", [False, True])
def test_a_second_row_for_a_period_is_an_error(spark, split):
    rows = spark.createDataFrame([("a", 1, 2.0), ("a", 2, 3.0), ("a", 2, 4.0)], "key string, at int, v double")
    with pytest.raises(Exception, match="two rows of a key for one at"):
        periods.with_growth(rows, ["key"], "at", "v", "g", split=split).collect()
