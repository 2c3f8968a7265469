"""Token counts kept by deltas: additive totals by source, language and tokenizer version.

A batch of changes becomes signed entries, one or two per changed document, and the batch's sums of
them; both are Parquet folders named after the batch. A marker, written last, commits the batch:
readers take committed batches only, a repeated commit does nothing, and a commit that failed before
its marker is written anew, replacing its own files. Totals add up the batches' small sums and never
read documents again.

Changes have (doc_id, version, op, source, lang, n_tokens). ``insert`` and ``revise`` set a
document's count for a version: the entry takes the old count off and adds the new one, under
another source or language if they changed. ``delete`` takes the count off; of a document that isn't
there, it does nothing. Rows of a batch that repeat (doc_id, version) are one change, the smallest by
(op, n_tokens, source, lang). A row without an id can't be found again: it is inserted as often as it
comes, and other changes of it do nothing. NULL sources and languages are groups of their own.
"""

from __future__ import annotations

import urllib.parse
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkeeper.llm import textbytes as tb
from martkeeper.llm.common import BROADCAST_ROWS, written

INSERT, REVISE, DELETE = "insert", "revise", "delete"
GROUP = ["source", "lang", "version"]
ENTRY = "doc_id bigint, version string, source string, lang string, docs bigint, tokens bigint"
TOTAL = "source string, lang string, version string, docs bigint, tokens bigint"


class TokenLedger:
    """The entries, sums and markers under a folder that the cluster shares."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def _path(self, kind: str, batch: str) -> str:
        return f"{self.folder}/{kind}/{urllib.parse.quote(batch, safe='')}"

    def committed(self) -> list[str]:
        """The folder names of the committed batches."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/commits")
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(root):
            return []
        done = [s.getPath() for s in files.listStatus(root)]
        marker = self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted(p.getName() for p in done if files.exists(marker(p, "_SUCCESS")))

    def _read(self, kind: str, schema: str) -> DataFrame:
        paths = [f"{self.folder}/{kind}/{name}" for name in self.committed()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def counts(self) -> DataFrame:
        """The present count of each document and version, with its source and language."""
        return self._present(self._read("entries", ENTRY))

    @staticmethod
    def _present(entries: DataFrame) -> DataFrame:
        sums = entries.groupBy("doc_id", "version", "source", "lang")
        return sums.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs <> 0")

    def totals(self) -> DataFrame:
        """Documents and tokens by source, language and tokenizer version."""
        sums = self._read("totals", TOTAL).groupBy(*GROUP)
        return sums.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter(
            "docs <> 0 OR tokens <> 0"
        )

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch once. False if it was committed before.

        The changes are written first: they are read several times, and may be costly to derive.
        """
        if urllib.parse.quote(batch, safe="") in self.committed():
            return False
        rows = changes.select(
            F.col("doc_id").cast("bigint").alias("doc_id"), "version", "op", "source", "lang",
            F.col("n_tokens").cast("bigint").alias("n_tokens"),
        )
        given, entries = self._path("changes", batch), self._path("entries", batch)
        rows.write.mode("overwrite").parquet(given)
        self._entries(self.spark.read.schema(rows.schema).parquet(given)).write.mode("overwrite").parquet(entries)
        sums = self.spark.read.schema(ENTRY).parquet(entries).groupBy(*GROUP)
        sums = sums.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        sums.write.mode("overwrite").parquet(self._path("totals", batch))
        self.spark.range(1).write.mode("overwrite").parquet(self._path("commits", batch))
        return True

    def _entries(self, rows: DataFrame) -> DataFrame:
        known = rows.filter("doc_id IS NOT NULL").groupBy("doc_id", "version").agg(
            F.min(F.struct("op", "n_tokens", "source", "lang")).alias("change")
        )
        known = known.select("doc_id", "version", "change.*")
        new = rows.filter(f"doc_id IS NULL AND op = '{INSERT}'").unionByName(known.filter(F.col("op") != DELETE))
        one = F.lit(1).cast("bigint")
        plus = new.select("doc_id", "version", "source", "lang", one.alias("docs"), F.col("n_tokens").alias("tokens"))
        if not self.committed():
            return plus
        # Only the entries of the batch's documents are added up, not all there are.
        key = ["doc_id", "version"]
        old = self._read("entries", ENTRY).join(known.select(*key), key, "left_semi")
        minus = self._present(old).select(
            "doc_id", "version", "source", "lang", (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens")
        )
        # A count that is only revised becomes one entry with the difference.
        return plus.union(minus).groupBy("doc_id", "version", "source", "lang").agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")
        ).filter("docs <> 0 OR tokens <> 0")


@cache
def _encoding(path: str, pattern: str):
    import base64

    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts_of(
    documents: DataFrame, ids: DataFrame, path: str, pattern: str, rows: int = BROADCAST_ROWS
) -> DataFrame:
    """:func:`token_counts` of the documents whose doc_id is in ``ids``.

    Up to ``rows`` ids go to all workers, which then skip other texts. Beyond that every text is
    counted and the counts are joined, so texts are never shuffled.
    """
    wanted = written(ids.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct(), "ids")
    if wanted.limit(rows + 1).count() > rows:
        return token_counts(documents, path, pattern).join(wanted, "doc_id", "left_semi")
    few = documents.join(F.broadcast(wanted), "doc_id", "left_semi")
    return token_counts(few, path, pattern)


def token_counts(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, source, lang and n_tokens of each row's whole text; a NULL text has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(path, pattern)
        for batch in tb.sliced(batches):
            n = [len(encoding.encode_ordinary(t or "")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(n, pa.int64())], ["doc_id", "source", "lang", "n_tokens"]
            )

    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        *[F.col(c).cast("string").alias(c) for c in ("source", "lang", "text")],
    )
    return rows.mapInArrow(run, "doc_id bigint, source string, lang string, n_tokens bigint")
