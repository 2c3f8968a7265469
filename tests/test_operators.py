"""Conforming, milestones, periods and roll-ups on small tables with awkward rows."""

import random
from collections import defaultdict
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from martkeeper.operators.conform import dedup_latest
from martkeeper.operators.milestones import (
    cycle_time_by,
    cycle_times,
    milestone_dates,
    with_cycle_time,
    with_month_offset,
)
from martkeeper.operators.periods import monthly_sums, running_totals, with_calendar, with_growth
from martkeeper.operators.rollup import entity_rollup, fanout_check, referral_rollup


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_dedup_keeps_latest_and_breaks_ties(spark):
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    data = [
        ("a", t1, "x"), ("a", t2, "z"), ("a", t2, "y"),
        ("b", None, "n"), ("b", t1, "m"),
        ("c", None, "q"), ("c", None, "p"),
    ]
    expected = [("a", t2, "y"), ("b", t1, "m"), ("c", None, "p")]
    schema = "id string, _loaded_at timestamp, payload string"
    for seed in range(3):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, schema).repartition(3)
        assert rows(dedup_latest(df, ["id"])) == sorted(expected, key=repr)


def test_dedup_by_digest_equals_dedup_by_key(spark):
    data = [("t" * n, n) for n in range(5)] + [("t", 9), (None, 1), (None, 0), ("", 7)]
    df = spark.createDataFrame(data, "text string, n int")
    plain = dedup_latest(df, ["text"], [])
    assert rows(plain) == rows(dedup_latest(df, ["text"], [], by_digest=True))
    assert plain.count() == 6


STEPS = [
    ("p1", "in", date(2024, 1, 5)), ("p1", "in", date(2024, 1, 3)),
    ("p1", "out", date(2024, 2, 3)), ("p1", "out", date(2024, 1, 13)), ("p1", "use", date(2024, 4, 1)),
    ("p2", "out", date(2024, 3, 1)), ("p2", "use", date(2025, 1, 1)),
    ("p3", "in", date(2024, 5, 10)), ("p3", "out", date(2024, 5, 1)),
    ("p4", "use", date(2024, 6, 1)),
]
STEP_SCHEMA = "id string, kind string, d date"


def test_several_milestones_do_not_multiply_rows(spark):
    facts = spark.createDataFrame(STEPS, STEP_SCHEMA)
    days = cycle_times(facts, "id", "kind", "d", "in", "out")
    assert rows(days.select("id", "cycle_days")) == [("p1", 10), ("p3", -9)]
    dates = milestone_dates(facts, "id", "kind", "d", {"start_date": "in", "end_date": "out"})
    timed = with_cycle_time(facts, dates, "id")
    assert timed.count() == len(STEPS)
    assert {(r.id, r.days_to_end) for r in timed.collect()} == {
        ("p1", 10), ("p2", None), ("p3", -9), ("p4", None)
    }
    mean = cycle_time_by(days.withColumn("g", F.lit("all")), "g").first()
    assert (mean.avg_days, mean.entities) == (1.0, 2)  # 0.5 rounds away from zero


def test_month_offset_is_from_the_last_milestone(spark):
    facts = spark.createDataFrame(STEPS, STEP_SCHEMA)
    out = with_month_offset(facts, "id", "kind", "d", "out", ["use"])
    got = {(r.id, r.kind, r.d): r.month_offset for r in out.collect()}
    assert got[("p1", "out", date(2024, 1, 13))] == 0
    assert got[("p1", "use", date(2024, 4, 1))] == 2
    assert got[("p2", "use", date(2025, 1, 1))] == 10
    assert got[("p4", "use", date(2024, 6, 1))] is None
    assert got[("p1", "in", date(2024, 1, 3))] is None


SPARSE = [
    ("a", date(2024, 1, 1), 100.0), ("a", date(2024, 3, 1), 150.0), ("a", date(2024, 4, 1), 0.0),
    ("a", date(2024, 5, 1), 80.0), ("b", date(2024, 1, 1), -5.0), ("b", date(2024, 2, 1), 10.0),
    ("c", date(2024, 7, 1), 1.0),
]


def test_growth_uses_the_previous_row(spark):
    df = spark.createDataFrame(SPARSE, "id string, month date, total double")
    got = {
        (r.id, r.month.month): r.g for r in with_growth(df, ["id"], "month", "total", "g").collect()
    }
    assert got == {
        ("a", 1): 0.0, ("a", 3): 50.0, ("a", 4): -100.0, ("a", 5): 0.0,
        ("b", 1): 0.0, ("b", 2): 0.0, ("c", 7): 0.0,
    }


def test_running_totals_share_ties_in_both_modes(spark):
    data = SPARSE + [("a", date(2024, 3, 1), 7.0), ("a", date(2024, 3, 1), None), (None, None, 4.0)]
    df = spark.createDataFrame(data, "id string, month date, total double")
    totals = {"running": "total"}
    direct = rows(running_totals(df, ["id"], "month", totals))
    summed = rows(running_totals(df, ["id"], "month", totals, one_row_per_period=False))
    assert direct == summed
    assert ("a", date(2024, 3, 1), 7.0, 257.0) in direct


def test_calendar_and_monthly_sums(spark):
    df = spark.createDataFrame(
        [("a", date(2024, 5, 17), 2), ("a", date(2024, 5, 3), 3), ("a", date(2024, 12, 31), 1)],
        "id string, d date, x int",
    )
    got = rows(with_calendar(monthly_sums(df, ["id"], "d", {"x": "x"}), "month"))
    assert got == [("a", date(2024, 12, 1), 1, 4, 2024), ("a", date(2024, 5, 1), 5, 2, 2024)]


def test_rollup_does_not_fan_out(spark):
    people = spark.createDataFrame([("a",), ("b",)], "id string")
    claims = spark.createDataFrame([("a", i) for i in range(14)], "id string, n int")
    money = spark.createDataFrame([("a", Decimal(4500))] * 1 + [("a", Decimal(0))] * 11,
                                  "id string, usd decimal(18,2)")
    out = entity_rollup(
        people, "id",
        [(claims, [F.max("n").alias("last")]), (money, [F.sum("usd").alias("usd")])],
    )
    assert rows(out) == [("a", 13, Decimal(4500)), ("b", None, None)]
    check = fanout_check(people, "id", [claims, money]).first()
    naive = people.join(claims, "id", "left").join(money, "id", "left").count()
    assert (check.rows_before, check.rows_after, check.fanout) == (2, naive, 84.5)


def test_referrals_keep_providers_without_any(spark):
    providers = spark.createDataFrame([("h1",), ("h2",)], "hcp string")
    data = [("p1", "h1", "active"), ("p2", "h1", "lapsed"), ("p3", "h1", "active"), ("p4", None, "active")]
    people = spark.createDataFrame(data, "pid string, ref string, status string")
    active = F.col("status") == "active"
    unique = referral_rollup(providers, people, "hcp", "ref", "pid", active)
    expected = [("h1", 3, 2, 0.667), ("h2", 0, 0, None)]
    assert rows(unique) == expected
    doubled = people.union(people)
    assert rows(referral_rollup(providers, doubled, "hcp", "ref", "pid", active, False)) == expected


def test_hot_key_results_equal_brute_force(spark):
    """A third of all rows on one key."""
    rng = random.Random(7)
    data = []
    for i in range(6000):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(500)}"
        kind = rng.choice(["in", "out", "use"])
        data.append((key, kind, date(2024, rng.randrange(1, 13), rng.randrange(1, 28)), rng.randrange(100)))
    facts = spark.createDataFrame(data, "id string, kind string, d date, x int").repartition(6)
    first, last = defaultdict(dict), {}
    for k, kind, d, _ in data:
        first[k][kind] = min(first[k].get(kind, d), d)
        if kind == "out":
            last[k] = max(last.get(k, d), d)
    days = {k: (v["out"] - v["in"]).days for k, v in first.items() if {"in", "out"} <= set(v)}
    got = cycle_times(facts, "id", "kind", "d", "in", "out")
    assert {r.id: r.cycle_days for r in got.collect()} == days
    offsets = with_month_offset(facts, "id", "kind", "d", "out", ["use"])
    assert offsets.count() == len(data)
    bad = [
        r for r in offsets.filter("kind = 'use'").collect()
        if r.month_offset
        != (None if r.id not in last else r.d.month - last[r.id].month)
    ]
    assert not bad
    sums = defaultdict(int)
    for k, _, d, x in data:
        sums[(k, d)] += x
    running = running_totals(
        facts.select("id", "d", "x"), ["id"], "d", {"t": "x"}, one_row_per_period=False
    )
    hot = {r.d: r.t for r in running.filter("id = 'hot'").collect()}
    total, expected = 0, {}
    for d in sorted(d for k, d in sums if k == "hot"):
        total += sums[("hot", d)]
        expected[d] = total
    assert hot == expected and running.count() == len(data)
