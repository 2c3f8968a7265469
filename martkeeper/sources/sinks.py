"""Writes: overwrite, append, versioned rewrite, schemas, comments.

Parquet tables have no UPDATE, MERGE or identity columns. A changed table is therefore written as
a new version next to the old one (a path is never overwritten while the same plan reads it), which
counts from the moment its marker exists; and a run's append lands in its own ``_run`` partition, so
that a retried run replaces its own rows instead of adding them twice. A log whose runs need ids of
their own, or which several processes append to, is a :class:`~martkeeper.sources.runlog.RunLog`.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkeeper.sources import markers
from martkeeper.sources.runlog import COMMITS, RUN, RunLog
from martkeeper.sources.tables import qualified

VERSIONS, VERSION_DATA = "_versions", "_version_data"
RUN_MARK = "run-"


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the whole table.

    Partitioned tables are rebalanced on the partition columns first: few files per partition, and
    a large partition is split over several tasks.
    """
    if not partition_by:
        df.write.mode("overwrite").parquet(path)
        return
    rebalanced = df.hint("rebalance", *partition_by)
    rebalanced.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Add rows; columns that are new are merged when the table is read."""
    df.write.mode("append").parquet(path)


def append_run(df: DataFrame, path: str, run_id: str) -> None:
    """Add the rows of one run. Repeating the run replaces its rows and leaves other runs alone.

    The folder's value carries a mark, so that no run id is taken for a number, a date or nothing.
    """
    (
        df.withColumn(RUN, F.lit(RUN_MARK + run_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(RUN)
        .parquet(path)
    )


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Read a table whose files were written with different column sets.

    Rows of plain appends and of runs may lie side by side; both are read. ``_run`` is the run's own
    id as text, NULL for plain rows, and missing if there are no runs.
    """
    names = folder_names(spark, path)
    if COMMITS in (names or []):
        return RunLog(spark, path).read()
    reader = spark.read.option("mergeSchema", "true")
    runs = [f"{path}/{n}" for n in names if n.startswith(f"{RUN}=")]
    plain = [f"{path}/{n}" for n in names if not n.startswith(("_", ".")) and n not in runs]
    if not runs:
        return reader.parquet(path)
    own = F.substring(F.col(RUN), len(RUN_MARK) + 1, F.length(RUN))
    by_run = reader.option("basePath", path).parquet(*runs).withColumn(RUN, own)
    if not plain:
        return by_run
    return spark.read.option("mergeSchema", "true").parquet(*plain).unionByName(
        by_run, allowMissingColumns=True
    )


folder_names = markers.names


def create_if_absent(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    """Create an empty table with the schema unless there is one. True when it was created."""
    if folder_names(spark, path) is not None:
        return False
    spark.createDataFrame([], schema).write.mode("errorifexists").parquet(path)
    return True


class VersionConflict(RuntimeError):
    """Another writer has published this version of the table."""


def _versions(spark: SparkSession, path: str) -> list[int]:
    return [int(n) for n in folder_names(spark, f"{path}/{VERSIONS}") or [] if n.isdigit()]


def _version_entry(spark: SparkSession, path: str, version: int) -> dict | None:
    text = markers.read(spark, f"{path}/{VERSIONS}/{version:012d}")
    return None if text is None else json.loads(text)


def write_version(df: DataFrame, path: str, version: int, owner: str | None = None) -> bool:
    """Write a new version of a table; readers of the previous one are not disturbed.

    The rows are written to a folder of their own and count once the version's marker exists, which
    only one writer can create: a writer that dies half-way leaves no version. Returns True if the
    version is made of these rows, False if the same ``owner`` had published it before (a repeated
    run); raises :class:`VersionConflict` if someone else did.
    """
    spark = df.sparkSession

    def mine() -> bool:
        entry = _version_entry(spark, path, version)
        if entry is None:
            return False
        if owner is None or entry["owner"] != owner:
            raise VersionConflict(f"version {version} of {path} was published by {entry['owner']!r}")
        return True

    if mine():
        return False
    folder = f"{VERSION_DATA}/{version:012d}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    entry = json.dumps({"folder": folder, "owner": owner, "schema": df.schema.json()})
    if markers.publish(spark, f"{path}/{VERSIONS}/{version:012d}", entry):
        return True
    return not mine()


def latest_version(spark: SparkSession, path: str, upto: int | None = None) -> int:
    """The highest published version (which may have no rows), or the highest of those to ``upto``."""
    versions = [v for v in _versions(spark, path) if upto is None or v <= upto]
    if not versions:
        raise ValueError(f"no version in {path}")
    return max(versions)


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of a table, by default the newest."""
    version = latest_version(spark, path) if version is None else version
    entry = _version_entry(spark, path, version)
    if entry is None:
        raise ValueError(f"no version {version} in {path}")
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    return spark.read.schema(schema).parquet(f"{path}/{entry['folder']}")


def replace_table(df: DataFrame, name: str, comment: str | None = None) -> None:
    """``CREATE OR REPLACE TABLE name AS SELECT``."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)
    if comment:
        comment_table(df.sparkSession, name, comment)


def create_schema(spark: SparkSession, name: str, comment: str | None = None) -> None:
    note = f" COMMENT '{_quoted(comment)}'" if comment else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {qualified(*name.split('.'))}{note}")


def comment_table(spark: SparkSession, name: str, comment: str) -> None:
    table = qualified(*name.split("."))
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('comment' = '{_quoted(comment)}')")


def comment_columns(spark: SparkSession, name: str, comments: Mapping[str, str]) -> None:
    table = qualified(*name.split("."))
    for column, comment in comments.items():
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN {qualified(column)} COMMENT '{_quoted(comment)}'")


def with_comments(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column comments as metadata, which parquet files keep."""
    for column, comment in comments.items():
        df = df.withMetadata(column, {**df.schema[column].metadata, "comment": comment})
    return df


def show(df: DataFrame, rows: int = 20) -> None:
    """Console sink for small results."""
    df.show(rows, truncate=False)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
