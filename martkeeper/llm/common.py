"""What several operators share: the shared folder, written intermediates, checked broadcasts,
connected groups.

Conventions of all operators in this package: only the columns an operator names are read, and where
an operator hands on the caller's other columns its own have names that the caller doesn't use
(:func:`unused`), so extra columns never matter; a NULL text counts as an empty one; rows are never
dropped unless the operator is a filter.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
RELEASE_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Rows of a few longs each: a broadcast of this many is some tens of megabytes in a task.
BROADCAST_ROWS = 2_000_000


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the one that the cluster shares.

    Only a local session, whose executors are the driver, may do without ``spark.checkpoint.dir``;
    it gets a temporary folder, which is then set for the session.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_KEY} names no folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set(CHECKPOINT_KEY, root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores behind it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(names: Sequence[str]) -> list[Column]:
    """Columns by their names, whatever signs these have."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and safe from lost executors.

    A join of written tables also has a shuffle of its own on either side, which lets adaptive
    execution split a key with many rows. The files of its shuffles go when it is written, where the
    session leaves that option at Spark's default; else they stay until the driver collects its garbage.
    """
    spark = df.sparkSession
    folder = work_folder(spark, name)
    kept = spark.conf.isModifiable(RELEASE_KEY) and spark.conf.get(RELEASE_KEY) == "false"
    if kept:
        spark.conf.set(RELEASE_KEY, "true")
    try:
        df.write.parquet(folder)
    finally:
        if kept:
            spark.conf.unset(RELEASE_KEY)
    return spark.read.schema(df.schema).parquet(folder)


def dropped(spark: SparkSession, folders: Sequence[str]) -> None:
    """Deletes tables of :func:`written` that nothing reads any more; the others are computed already, so a lost
    executor doesn't ask for them."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def folder_of(table: DataFrame) -> list[str]:
    """The folder of a table of :func:`written`, if it has a file."""
    return sorted({name.rsplit("/", 1)[0] for name in table.inputFiles()})


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a written table for broadcast if it has at most ``rows`` rows; else it is shuffled."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); a component is its smallest node.

    Each round gives a node the smallest label among its own, its neighbours' and its label's label
    and writes the labels, so the number of rounds follows the logarithm of the longest path. The
    neighbours' minimum is combined before the shuffle; the label lookup joins two written tables,
    so that a component with most of the nodes is split. Raises if the rounds don't suffice.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.filter("a <> b").distinct(), "links")
    first = both.groupBy("a").agg(F.min("b").alias("m"))
    labels = written(
        first.select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels"
    )
    for _ in range(rounds):
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        stepped = written(
            labels.join(near, "node").select(
                "node", F.least("label", "near").alias("label"), F.col("label").alias("old")
            ),
            "labels",
        )
        target = stepped.select(F.col("node").alias("label"), F.col("label").alias("up"))
        jumped = written(
            stepped.join(target, "label", "left").select(
                "node", F.coalesce(F.least("label", "up"), "label").alias("label"), "old"
            ),
            "labels",
        )
        labels = jumped.select("node", "label")
        if jumped.filter("label <> old").isEmpty():
            return labels.withColumnRenamed("label", "component")
    raise RuntimeError(f"labels still change after {rounds} rounds")
