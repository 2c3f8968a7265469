import pytest
from pyspark.sql import functions as F

from martkeeper.operators.metrics import Join, MetricCatalog, MetricError, MetricView, Surface
from martkeeper.sources.tables import TableRegistry

SALES = [
    ("p1", "DME", 10.0, 40.0, 1, True), ("p1", "DME", 30.0, 40.0, 2, True),
    ("p2", "DTC", 50.0, 50.0, 1, True), ("p3", "DTC", 10.0, 20.0, 1, True),
    ("p4", "DTC", 99.0, 99.0, 1, False), ("p5", None, 1.0, 5.0, 2, True),
]
VIEW = MetricView(
    name="mv",
    source="sales",
    filter="ok = true",
    joins=(Join("who", "people", "source.id = who.id"),),
    dimensions={"Channel": "channel", "Quarter No": "q", "Status": "who.status", "Id": "id"},
    measures={
        "People": "COUNT(DISTINCT id)",
        "Usd": "SUM(usd)",
        "Pct": "AVG(pct)",
        "Active Usd": "SUM(CASE WHEN who.status = 'active' THEN usd ELSE 0 END)",
    },
)


@pytest.fixture()
def catalog(spark):
    tables = TableRegistry(spark)
    tables.put("sales", spark.createDataFrame(
        SALES, "id string, channel string, usd double, pct double, q int, ok boolean"))
    tables.put("people", spark.createDataFrame(
        [("p1", "active"), ("p2", "lapsed"), ("p9", "active")], "id string, status string"))
    out = MetricCatalog(tables)
    out.define(VIEW)
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_measures_follow_the_grouping(catalog):
    assert rows(catalog.query("mv", ["People", "Usd", "Pct"])) == [(4, 101.0, 31.0)]
    assert rows(catalog.query("mv", ["People", "Pct"], ["Channel"])) == sorted(
        [("DME", 1, 40.0), ("DTC", 2, 35.0), (None, 1, 5.0)], key=repr)


def test_names_that_differ_by_case_only(catalog):
    df = catalog.query("mv", ["Usd"], ["Channel"], {"Channel": "DTC"})
    assert df.columns == ["Channel", "Usd"] and rows(df) == [("DTC", 60.0)]


@pytest.mark.parametrize(
    "where",
    [
        {"Quarter No": 1, "Channel": ["DTC"]},
        "`Quarter No` = 1 AND Channel = 'DTC'",
        lambda d: (d["Quarter No"] == 1) & (d["Channel"] == "DTC"),
    ],
)
def test_filter_forms_agree(catalog, where):
    assert rows(catalog.query("mv", ["Usd", "People"], ["Quarter No"], where)) == [(1, 60.0, 2)]


def test_joined_dimension_keeps_unmatched_rows(catalog):
    assert rows(catalog.query("mv", ["Usd"], ["Status"])) == sorted(
        [("active", 40.0), ("lapsed", 50.0), (None, 11.0)], key=repr)
    assert rows(catalog.query("mv", ["Active Usd"])) == [(40.0,)]
    assert rows(catalog.query("mv", ["Usd"], [], {"Status": "active"})) == [(40.0,)]


def test_unused_join_is_not_executed(catalog):
    def joins(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("Join ")

    assert joins(catalog.query("mv", ["Usd"], ["Channel"])) == 0
    assert joins(catalog.query("mv", ["Usd"], ["Status"])) == 1


def test_duplicate_join_keys_are_reported(catalog, spark):
    assert rows(catalog.join_check("mv")) == [("who", 3, 0)]
    catalog.tables.put("people", spark.createDataFrame(
        [("p1", "a"), ("p1", "b")], "id string, status string"))
    assert rows(catalog.join_check("mv")) == [("who", 1, 1)]


def test_post_order_and_limit(catalog):
    df = catalog.query(
        "mv", ["Pct"], ["Channel"], lambda d: d["Channel"].isNotNull(),
        order_by=[F.col("Pct"), "Channel"], limit=1, post={"Rounded": "ROUND(Pct, 1)"},
    )
    assert rows(df) == [("DTC", 35.0, 35.0)]


@pytest.mark.parametrize(
    "call",
    [
        lambda c: c.query("nope", ["Usd"]),
        lambda c: c.query("mv", ["Nope"]),
        lambda c: c.query("mv", ["Usd"], ["Nope"]),
        lambda c: c.query("mv", ["Usd"], [], {"Nope": 1}),
        lambda c: c.query("mv", []),
    ],
)
def test_unknown_names_are_refused(catalog, call):
    with pytest.raises(MetricError):
        call(catalog)


def test_surface_rules(catalog, spark):
    surface = Surface("s", ["mv"], {"mv": ["Id"]})
    assert rows(surface.query(catalog, "mv", ["Usd"], ["Channel"], {"Channel": "DME"})) == [
        ("DME", 40.0)]
    for call in (
        lambda: surface.query(catalog, "mv", ["Usd"], ["Id"]),
        lambda: surface.query(catalog, "mv", ["Usd"], [], {"Id": "p1"}),
        lambda: surface.query(catalog, "mv", ["Usd"], [], "Id = 'p1'"),
        lambda: surface.query(catalog, "other", ["Usd"]),
    ):
        with pytest.raises(MetricError):
            call()
    catalog.tables.put("people", catalog.tables.get("people"), certified=False)
    with pytest.raises(MetricError):
        surface.query(catalog, "mv", ["Usd"])
    relaxed = Surface("s", [], allow_uncertified=["mv"])
    assert relaxed.query(catalog, "mv", ["Usd"]).first()["_uncertified"] is True


def test_registry_lists_types(catalog):
    listed = {r.name: (r.type, r.certified) for r in catalog.tables.describe().collect()}
    assert listed == {
        "mv": ("METRIC_VIEW", True), "people": ("TABLE", True), "sales": ("TABLE", True)}
    with pytest.raises(KeyError):
        catalog.tables.get("nope")
    catalog.define(MetricView("mv", "sales", {}, {"N": "COUNT(1)"}))
    assert rows(catalog.query("mv", ["N"])) == [(6,)]
