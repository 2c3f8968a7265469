from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martkeeper.functions import calc, draws, masks
from martkeeper.sources.tables import evaluate


def one(spark, **columns):
    return evaluate(spark, **columns).first()


@pytest.mark.parametrize(
    "value, masked, strict",
    [
        ("521-84-7793", "***-**-7793", "***-**-7793"),
        ("12345", "***-**-2345", "***-**-2345"),
        ("1234", "***-**-1234", "***-**-****"),
        ("123", "***-**-123", "***-**-****"),
        ("", "***-**-", "***-**-****"),
        (None, None, None),
    ],
)
def test_mask_last4(spark, value, masked, strict):
    v = F.lit(value).cast("string")
    row = one(spark, m=masks.mask_last4(v), s=masks.mask_last4_strict(v))
    assert (row.m, row.s) == (masked, strict)


def test_other_masks(spark):
    row = one(
        spark,
        y=masks.mask_dob_year(F.lit(date(1996, 2, 29))),
        r=masks.mask_redact(F.lit("Ann")),
        n=masks.mask_redact(F.lit(None).cast("string")),
        t=masks.tokenize_key(F.lit("PAT-000001")),
        u=masks.tokenize_key(F.lit("PAT-000001"), salt="x"),
        none=masks.tokenize_key(F.lit(None).cast("string")),
    )
    assert row.y == date(1996, 1, 1)
    assert (row.r, row.n, row.none) == ("[Redacted]", None, None)
    assert len(row.t) == 64 and row.t != row.u


def test_sql_functions_equal_builders(spark):
    masks.register_sql_functions(spark)
    row = spark.sql(
        "SELECT mask_last4('521-84-7793') a, mask_redact('x') b, tokenize_key('k') c, "
        "mask_dob_year(DATE '1990-05-06') d, region_row_filter('US West') e, "
        "region_row_filter('US East') f"
    ).first()
    token = one(spark, t=masks.tokenize_key(F.lit("k"))).t
    assert tuple(row) == ("***-**-7793", "[Redacted]", token, date(1990, 1, 1), True, False)


@pytest.mark.parametrize(
    "value, previous, growth",
    [(150.0, 100.0, 50.0), (50.0, 0.0, 0.0), (50.0, -10.0, 0.0), (50.0, None, 0.0), (1.0, 3.0, -66.67)],
)
def test_growth(spark, value, previous, growth):
    row = one(spark, g=calc.growth_pct(F.lit(value), F.lit(previous).cast("double")))
    assert row.g == growth


def test_guards_and_flags(spark):
    none = F.lit(None).cast("int")
    row = one(
        spark,
        zero=calc.ratio(F.lit(3), F.lit(0)),
        half=calc.ratio(F.lit(1), F.lit(2)),
        rate=calc.guarded_rate(F.lit(1), F.lit(3)),
        no_rate=calc.guarded_rate(F.lit(0), F.lit(0)),
        unknown=calc.flag(none > 5),
        age=calc.age_years(F.lit(date(2024, 1, 1)), F.lit(date(2000, 1, 2))),
        offset=calc.month_offset(F.lit(date(2025, 2, 1)), F.lit(date(2024, 11, 30))),
    )
    assert (row.zero, row.half, row.rate, row.no_rate) == (None, 0.5, 0.333, None)
    assert (row.unknown, row.age, row.offset) == (False, 23, 3)


def test_lifecycle_is_inclusive_and_null_is_lapsed(spark):
    df = spark.createDataFrame(
        [(date(2024, 8, 1),), (date(2024, 7, 31),), (None,)], "d date"
    ).select(calc.lifecycle_status("d", "2025-08-01").alias("s"))
    assert [r.s for r in df.collect()] == ["active", "lapsed", "lapsed"]


def test_units_are_exact(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (1.15,), (84197.04,), (-5.5,)], "x double")
    total = df.agg(calc.sum_units(calc.units("x")).alias("u"))
    assert total.select(calc.from_units("u", 2).alias("d")).first().d == Decimal("84192.99")
    huge = spark.range(30).select(F.lit(9 * 10**17).alias("u")).agg(
        calc.sum_units(F.col("u")).alias("u"))
    assert huge.select(calc.from_units("u", 4).alias("d")).first().d == Decimal(27 * 10**14)


def test_padded_key_keeps_long_numbers(spark):
    row = one(spark, a=draws.padded_key("PAT", F.lit(42)), b=draws.padded_key("PAT", F.lit(12345678)))
    assert tuple(row) == ("PAT-000042", "PAT-12345678")


def test_draws_do_not_depend_on_partitioning(spark):
    def picks(parts):
        df = spark.range(0, 3000, 1, parts).select(
            "id",
            draws.choose_weighted(F.col("id"), "w", {"a": 40, "b": 40, "c": 20}).alias("w"),
            draws.int_between(F.col("id"), "i", 5, 9).alias("i"),
        )
        return sorted(tuple(r) for r in df.collect())

    once, again = picks(1), picks(7)
    assert once == again
    share = {w: sum(r[1] == w for r in once) / len(once) for w in "abc"}
    assert abs(share["a"] - 0.4) < 0.04 and abs(share["c"] - 0.2) < 0.04
    assert {r[2] for r in once} == {5, 6, 7, 8, 9}
