"""Columns that are fetched late, and scans that are pruned at run time."""

import re

import pytest
from compare import plan_text
from pyspark.sql import functions as F

from martkeeper.operators.conform import dedup_latest, dedup_stored
from martkeeper.plans import registry

SCHEMA = "k int, j string, at int, x double, y string"


@pytest.fixture()
def stored(spark, tmp_path):
    def write(rows, parts=3):
        spark.createDataFrame(rows, SCHEMA).repartition(parts).write.mode("overwrite").parquet(str(tmp_path / "t"))
        return spark.read.parquet(str(tmp_path / "t"))

    return write


def same(a, b):
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("order", [["at"], ["at", "x"], []])
def test_the_survivors_are_those_of_the_plain_dedup(stored, order):
    rows = [(i % 40, "a" if i % 3 else None, i % 5 if i % 7 else None, float(i % 4), str(i % 6)) for i in range(900)]
    rows += [(None, None, 1, 1.0, "z"), (None, None, 1, 1.0, "b"), (7, "solo", None, None, None)]
    rows += [(99, "copy", 3, 2.0, "same")] * 30  # equal rows: one stays
    table = stored(rows)
    assert same(dedup_stored(table, ["k", "j"], order), dedup_latest(table, ["k", "j"], order))
    tie = ["y", "x"]
    assert same(
        dedup_stored(table, ["k"], ["at"], tie).select("k", "at", "y", "x"),
        dedup_latest(table, ["k"], ["at"], tie).select("k", "at", "y", "x"),
    )


def test_nothing_to_drop_and_no_rows(stored):
    table = stored([(i, "a", 1, 1.0, "y") for i in range(20)])
    assert same(dedup_stored(table, ["k"], ["at"]), table)
    assert dedup_stored(stored([]), ["k"], ["at"]).count() == 0


def test_only_the_columns_that_are_used_are_read(spark, folder):
    df = registry.queries()["deduped_quantity"](spark, folder)
    read = re.findall(r"lineitem.parquet.*?ReadSchema: (\S+)", plan_text(df), re.S)
    assert [re.sub(r",?_tmp_metadata_row_index:bigint", "", r) for r in read] == [
        "struct<l_quantity:double,l_returnflag:string>"]
    assert "BroadcastHashJoin LeftAnti" in plan_text(df)


def test_a_hot_key_is_never_sorted(stored):
    table = stored([(0 if i % 3 else i, "a", i, 1.0, "y") for i in range(3000)])
    kept = dedup_stored(table, ["k"], ["at"])
    assert kept.count() == 1000 and kept.filter("k = 0").first()["at"] == 2999
    assert "Window" not in plan_text(kept)


def test_entitlements_prune_the_partitions_that_are_read(spark, folder):
    df = registry.queries()["entitled_patients"](spark, folder)
    assert "dynamicpruning" in plan_text(df).lower()
    regions = {r.region for r in df.select("region").distinct().collect()}
    files = [m for m in df.inputFiles() if "silver_patients" in m]
    assert len(regions) == 1 and len({f.split("region=")[1].split("/")[0] for f in files}) == 5
