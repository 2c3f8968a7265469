"""Session settings. On a cluster the session that is passed in is used as it is."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Adaptive execution measures shuffle output at run time: it merges small partitions, splits skewed
# join partitions (also where that costs one more shuffle) and broadcasts a side only after its
# size is known to be below the limit.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


# Spark's defaults of options that are not already as recommended.
DEFAULTS = {
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "false",
    "spark.sql.shuffle.partitions": "200",
}

TASK_BYTES = 128 * 2**20


def shuffle_partitions(input_bytes: int, task_bytes: int = TASK_BYTES) -> int:
    """Partitions that keep a shuffle of the whole input at ``task_bytes`` a task."""
    return max(1, -(-input_bytes // task_bytes))


def recommend(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Set the run-time options above on a session.

    With the size of the input the number of shuffle partitions is raised so that a task's share
    fits in memory; partitions that turn out small are merged at run time.
    """
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    if input_bytes is not None:
        key = "spark.sql.shuffle.partitions"
        wanted = shuffle_partitions(input_bytes)
        spark.conf.set(key, str(max(wanted, int(spark.conf.get(key)))))
    return spark


def local_session(
    cores: int | str | None = None, name: str = "martkeeper", memory: str = "8g"
) -> SparkSession:
    """A session for tests and the bench."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return recommend(session)


def prepare(spark: SparkSession, folder: str) -> SparkSession:
    """:func:`recommend` for a session that is passed in, with the size of the folder it will read.

    Options that were set to something else than Spark's default are left alone.
    """
    for key, value in RECOMMENDED.items():
        if spark.conf.get(key) == DEFAULTS.get(key, value):
            spark.conf.set(key, value)
    key = "spark.sql.shuffle.partitions"
    if spark.conf.get(key) == DEFAULTS[key]:
        wanted = shuffle_partitions(folder_bytes(spark, folder))
        spark.conf.set(key, str(max(wanted, int(DEFAULTS[key]))))
    return spark


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Bytes of the files under a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(path).getLength()


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share."""
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if not folder:
        raise ValueError(f"{CHECKPOINT_KEY} is not set")
    return folder
