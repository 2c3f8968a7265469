"""Layers that are written once and shared by all that read them.

A store is a folder named by a fingerprint: of the input files (path, length, time of change), of the
parameters, and of this library's code. A layer is written to a folder of its own and counts from the
moment its marker exists, so a reader sees a whole layer or none; a job that dies leaves a folder
that nobody reads, and of two jobs that build the same layer at once the first one's is used by both. An
input that changes, or another parameter, is another fingerprint and so another store.

A large layer may be bucketed and sorted by a key, so that joins and roll-ups by this key read it without
a shuffle. A key with many rows would make one bucket large, and its task long; a layer where the largest
key has more than ``SKEW`` times the rows of an even bucket therefore stays as it is, and
its joins are those that adaptive execution splits. A bucketed layer is an external table of the session's
catalog, as Spark knows buckets of tables only; where the catalog has forgotten it, it is entered again.
"""

from __future__ import annotations

import atexit
import hashlib
import json
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkeeper.session import CHECKPOINT_KEY, shared_folder
from martkeeper.sources import markers

OPTIONAL = "llm"
# A session option: layers of another generation are built anew.
GENERATION_KEY = "spark.martkeeper.generation"
# Smaller layers are cheap to shuffle.
BUCKET_ROWS = 5_000_000
MOST_BUCKETS = 50_000
SKEW = 1.0


@cache
def _local_root() -> str:
    folder = tempfile.mkdtemp(prefix="martkeeper-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def work_root(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local session may do without the setting."""
    if not spark.conf.get(CHECKPOINT_KEY, None) and spark.sparkContext.master.startswith("local["):
        return _local_root()
    return shared_folder(spark).rstrip("/")


def staged(df: DataFrame, name: str = "staged") -> DataFrame:
    """The rows written to the shared folder and read back: computed once, whatever uses them."""
    spark = df.sparkSession
    folder = f"{work_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def input_fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """Of the files under these paths. Spark lists them; two numbers reach the driver."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(list(paths))
        .select(F.xxhash64("path", F.unix_micros("modificationTime"), "length").alias("h"))
    )
    row = files.agg(F.count("*").alias("n"), F.bit_xor("h").alias("x"), F.sum(F.col("h") % 2**31).alias("s"))
    return str(tuple(row.first()))


@cache
def code_fingerprint() -> str:
    """Of the package's sources, without the optional part."""
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    total = hashlib.sha256()
    for folder, inner, names in sorted(os.walk(package)):
        inner[:] = sorted(d for d in inner if d != OPTIONAL)
        for name in sorted(n for n in names if n.endswith(".py")):
            with open(os.path.join(folder, name), "rb") as f:
                total.update(name.encode() + f.read())
    return total.hexdigest()


class LayerStore:
    """Layers under ``root``, one store per fingerprint."""

    def __init__(
        self,
        spark: SparkSession,
        fingerprint: str,
        root: str | None = None,
        partition_by: Mapping[str, Sequence[str]] | None = None,
        bucket_by: Mapping[str, str] | None = None,
    ) -> None:
        self.spark = spark
        generation = spark.conf.get(GENERATION_KEY, "")
        digest = hashlib.sha256(repr((generation, fingerprint)).encode()).hexdigest()[:32]
        self.folder = f"{root or work_root(spark) + '/layers'}/{digest}"
        self.partition_by, self.bucket_by = partition_by or {}, bucket_by or {}
        self._read: dict[str, DataFrame] = {}
        self._bucketed: set[str] = set()

    def _marker(self, name: str) -> str:
        return f"{self.folder}/{name}.layer"

    def has(self, name: str) -> bool:
        return markers.read(self.spark, self._marker(name)) is not None

    def layer(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stored layer. It is built and written if there is none yet."""
        if name not in self._read:
            text = markers.read(self.spark, self._marker(name))
            if text is None:
                text = self._write(name, build())
            entry = json.loads(text)
            self._read[name] = self._open(entry)
            if "table" in entry:
                self._bucketed.add(name)
        return self._read[name]

    def bucketed(self, name: str) -> bool:
        """Whether a layer that was asked for lies in buckets."""
        return name in self._bucketed

    def _write(self, name: str, df: DataFrame) -> str:
        folder = f"{name}-{uuid.uuid4().hex}"
        by = list(self.partition_by.get(name, ()))
        out = df.hint("rebalance", *by) if by else df
        writer = out.write.partitionBy(*by) if by else out.write
        writer.parquet(f"{self.folder}/{folder}")
        entry = {"folder": folder, "schema": df.schema.json()}
        if name in self.bucket_by:
            entry = self._in_buckets(entry, name) or entry
        entry = json.dumps(entry)
        if markers.publish(self.spark, self._marker(name), entry):
            return entry
        return markers.read(self.spark, self._marker(name))

    def _in_buckets(self, entry: dict, name: str) -> dict | None:
        """Write a layer that is written already once more, in buckets; None if that doesn't pay."""
        rows, key = self._open(entry), self.bucket_by[name]
        counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        total, largest = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
        n = min(int(self.spark.conf.get("spark.sql.shuffle.partitions")), MOST_BUCKETS)
        if total < BUCKET_ROWS or largest * n > SKEW * total:
            return None
        folder = f"{name}-{uuid.uuid4().hex}"
        table = f"layer_{folder.replace('-', '_')}"
        writer = rows.repartition(n, key).write.bucketBy(n, key).sortBy(key)
        writer.format("parquet").option("path", f"{self.folder}/{folder}").saveAsTable(table)
        return {**entry, "folder": folder, "table": table, "buckets": n, "key": key}

    def _open(self, entry: dict) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(entry["schema"]))
        path = f"{self.folder}/{entry['folder']}"
        if "table" not in entry:
            return self.spark.read.schema(schema).parquet(path).select(*schema.names)
        if not self.spark.catalog.tableExists(entry["table"]):  # written by another application
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            key = f"`{entry['key']}`"
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {entry['table']} ({columns}) USING parquet "
                f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {entry['buckets']} BUCKETS "
                f"LOCATION '{path}'"
            )
        return self.spark.table(entry["table"]).select(*schema.names)
