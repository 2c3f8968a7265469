"""URL filters: allow and block rules on hosts and paths, the longest one that fits decides.

A rule is (host, path, verdict). It fits its host and every subdomain if the url's path starts with
the rule's path. The rule with the most host labels decides, among these the one with the longest
path; if the same rule allows and blocks, it blocks. Without a rule the verdict is ``allow``.

The host is what stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower
case; the path goes on from there up to ``?``, ``#`` or the end. A NULL url, or one without ``://``,
has an empty host and path. Every row is returned, repeated ones too.
"""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkeeper.llm.common import work_folder

ALLOW, BLOCK = "allow", "block"
# Up to so many rules go to the workers as a trie; more are joined.
TRIE_RULES = 500_000

Rule = tuple[str, str, str]


class Trie:
    """Reversed host labels, and under a host the segments of paths.

    A path's segments are those that a slash closes; what follows the last slash is the tail, which
    the next segment has to start with.
    """

    def __init__(self, rules: Sequence[Rule]) -> None:
        self.root: dict = {"labels": {}, "path": None}
        for host, path, verdict in sorted(rules):  # block comes after allow and replaces it
            node = self.root
            for label in _labels(host):
                node = node["labels"].setdefault(label, {"labels": {}, "path": None})
            *closed, tail = path.split("/")
            if node["path"] is None:
                node["path"] = {"next": {}, "tails": {}}
            step = node["path"]
            for segment in closed:
                step = step["next"].setdefault(segment, {"next": {}, "tails": {}})
            step["tails"][tail] = (f"{host}{path}", verdict)

    def find(self, host: str, path: str) -> tuple[str | None, str]:
        """(rule, verdict) for a url, with no rule as its default."""
        node, found = self.root, (None, ALLOW)
        nodes = [node]
        for label in _labels(host):
            node = node["labels"].get(label)
            if node is None:
                break
            nodes.append(node)
        for node in reversed(nodes):
            hit = _longest(node["path"], path)
            if hit:
                return hit
        return found


def _labels(host: str) -> list[str]:
    return host.split(".")[::-1] if host else []


def _longest(step: dict | None, path: str) -> tuple[str, str] | None:
    hit = None
    segments = path.split("/")
    for depth, segment in enumerate(segments):
        if step is None:
            break
        # A tail may go on past the segment's end only if no slash comes: it has none itself.
        fits = [t for t in step["tails"] if segment.startswith(t)]
        if fits:
            hit = step["tails"][max(fits, key=len)]
        if depth + 1 < len(segments):
            step = step["next"].get(segment)
    return hit


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def judge_urls(pages: DataFrame, rules: Sequence[Rule], keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """The ``keep`` columns with host, path, rule and verdict; ``pages`` has a column url."""
    host, path = parts(F.col("url").cast("string"))
    rows = pages.select(*keep, host.alias("host"), path.alias("path"))
    if len(set(rules)) > TRIE_RULES:
        return _joined(rows, rules, keep)
    shared = pages.sparkSession.sparkContext.broadcast(Trie(rules))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = shared.value
        for batch in batches:
            hosts, paths = (batch.column(c).to_pylist() for c in ("host", "path"))
            found = [trie.find(h, p) for h, p in zip(hosts, paths, strict=True)]
            rule, verdict = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, rule, verdict], [*batch.schema.names, "rule", "verdict"]
            )

    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    schema = schema.add("rule", "string").add("verdict", "string")
    return rows.mapInArrow(match, schema)


def _joined(rows: DataFrame, rules: Sequence[Rule], keep: Sequence[str]) -> DataFrame:
    """The same for any number of rules: each url asks for its host suffixes and closed paths."""
    spark: SparkSession = rows.sparkSession
    table = (
        spark.createDataFrame(list(rules), "rule_host string, rule_path string, verdict string")
        .groupBy("rule_host", "rule_path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("closed", F.regexp_extract("rule_path", "^.*/", 0))
    )
    folder = work_folder(spark, "rules")
    table.write.parquet(folder)
    table = spark.read.parquet(folder)
    labels, segments = F.split("host", "\\."), F.split("path", "/")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    hosts = F.array_distinct(F.concat(suffixes, F.array(F.lit(""))))
    closed = F.transform(
        F.sequence(F.lit(0), F.size(segments) - 1),
        lambda i: F.when(i == 0, "").otherwise(F.concat(F.array_join(F.slice(segments, F.lit(1), i), "/"), F.lit("/"))),
    )
    urls = rows.select("host", "path").distinct()
    asked = urls.withColumn("rule_host", F.explode(hosts)).withColumn("closed", F.explode(closed))
    hits = (
        asked.join(table, ["rule_host", "closed"])
        .filter(F.startswith("path", F.col("rule_path")))
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    F.when(F.col("rule_host") == "", 0).otherwise(F.size(F.split("rule_host", "\\."))).alias("l"),
                    F.length("rule_path").alias("n"),
                    F.concat("rule_host", "rule_path").alias("rule"),
                    "verdict",
                )
            ).alias("hit")
        )
    )
    return rows.join(hits, ["host", "path"], "left").select(
        *keep, "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", F.lit(ALLOW)).alias("verdict"),
    )
