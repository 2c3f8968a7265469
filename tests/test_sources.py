from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import types as T

from martkeeper.session import recommend, shared_folder
from martkeeper.sources import sinks, tables
from martkeeper.sources.ingest import with_ingest_metadata


def test_ingest_metadata(spark):
    df = with_ingest_metadata(spark.range(2), "s", "2024-01-01 00:00:00", has_pii=True)
    assert tuple(df.first()) == (0, datetime(2024, 1, 1), "s", False, True)


def test_overwrite_append_and_merge(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite(spark.range(3), path)
    sinks.overwrite(spark.range(2), path)
    sinks.append(spark.range(1).selectExpr("id", "'x' AS extra"), path)
    df = sinks.read_merged(spark, path)
    assert sorted(df.columns) == ["extra", "id"] and df.count() == 3
    parts = str(tmp_path / "p")
    sinks.overwrite(spark.range(10).selectExpr("id", "id % 2 AS k"), parts, ["k"])
    plan = spark.read.parquet(parts).filter("k = 1")._jdf.queryExecution().executedPlan().toString()
    assert spark.read.parquet(parts).filter("k = 1").count() == 5
    assert "PartitionFilters: [isnotnull(k" in plan


def test_create_if_absent(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = T.StructType([T.StructField("a", T.LongType())])
    assert sinks.create_if_absent(spark, path, schema) is True
    sinks.append(spark.range(2).selectExpr("id AS a"), path)
    assert sinks.create_if_absent(spark, path, schema) is False
    assert spark.read.parquet(path).count() == 2


def test_versions_may_be_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_version(spark.range(2), path, 1)
    sinks.write_version(spark.range(0), path, 2)
    assert sinks.latest_version(spark, path) == 2
    assert sinks.read_version(spark, path).count() == 0
    assert sinks.read_version(spark, path, 1).count() == 2


def test_catalog_tables_and_comments(spark, tmp_path):
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS mk_test LOCATION '{tmp_path}/db'")
    sinks.create_schema(spark, "mk_test", "it's there")
    sinks.replace_table(spark.range(2), "mk_test.t", "first")
    sinks.replace_table(spark.range(3), "mk_test.t", "it's new")
    sinks.comment_columns(spark, "mk_test.t", {"id": "the 'key'"})
    assert tables.scan_table(spark, "mk_test", "t", columns=["id"]).count() == 3
    assert tables.table_type(spark, "mk_test.t").first().data_type == "MANAGED"
    column = spark.sql("DESCRIBE TABLE mk_test.t").filter("col_name = 'id'").first()
    assert column.comment == "the 'key'"
    spark.sql("DROP TABLE mk_test.t")
    spark.sql("DROP SCHEMA mk_test")


def test_comments_travel_with_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.overwrite(sinks.with_comments(spark.range(1), {"id": "key"}), path)
    assert spark.read.parquet(path).schema["id"].metadata["comment"] == "key"


def test_shared_folder_is_the_clusters(tmp_path):
    def session(folder):
        conf = SimpleNamespace(get=lambda key, default: folder or default)
        return SimpleNamespace(conf=conf)

    assert shared_folder(session("/shared/x")) == "/shared/x"
    with pytest.raises(ValueError):
        shared_folder(session(None))


def test_shuffle_partitions_follow_the_input(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    recommend(spark, input_bytes=2**20)
    assert spark.conf.get(key) == before
    recommend(spark, input_bytes=100 * 2**40)
    assert spark.conf.get(key) == str(100 * 2**40 // (128 * 2**20))
    spark.conf.set(key, before)


def test_scan_and_evaluate(spark, tmp_path, capsys):
    spark.range(4).write.parquet(str(tmp_path / "x.parquet"))
    folder = tables.ParquetFolder(spark, str(tmp_path))
    assert folder.scan("x").count() == folder.scan("x", ["id"]).count() == 4
    assert tables.qualified("a", "", "b`c") == "`a`.`b``c`"
    sinks.show(spark.range(1))
    assert "|id |" in capsys.readouterr().out
