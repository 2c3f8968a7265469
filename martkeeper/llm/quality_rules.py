"""Quality rules: lines that many documents of a host share, and simple counts of a text.

A host's line is boilerplate if more than ``MIN_DOCS`` and more than ``MAX_SHARE`` per cent of the
host's distinct texts have it; exact copies of a document are one text, so copies alone make no
line frequent. With a ``max_share`` of 0 the number of texts is enough, whatever the host's size. Boilerplate lines are taken out, and a document that has fewer than ``MIN_WORDS``
words or ``MIN_LEFT`` per cent of its words left is rejected, as is one that fails the counts.

Lines are compared as word sequences with A-Z lower-cased; lines without a word never count. A NULL
text has no words and fails; a NULL source is a host of its own; an unknown id stays NULL; repeated
rows are judged alike and each returned. Counts cover all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkeeper.llm import textbytes as tb
from martkeeper.llm.common import quoted, small, unused, written

MIN_WORDS = 10
MIN_DOCS = 20
MAX_SHARE = 5
MIN_LEFT = 30
REPEATED = 20
WINDOW = 5
SYMBOLS = b"[#*$%&|<>]"[1:-1]

PROFILE = (
    "doc_id bigint, content bigint, host string, n_words bigint, word_chars bigint, "
    "n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "lines array<struct<line:bigint,number:int,words:int>>"
)


def profile(documents: DataFrame) -> DataFrame:
    """The counts of each document and its lines as (hash, number, words)."""
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "text",
        _content().alias("content"),
        _host().alias("host"),
    )
    return rows.mapInArrow(_profile, PROFILE)


def _content() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _host() -> Column:
    """The source, marked so that no source looks like a missing one."""
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in tb.sliced(batches):
        data, offsets = tb.buffers(batch.column("text"))
        starts, ends, rows = tb.spans(data, offsets)
        n_words = np.bincount(rows, minlength=batch.num_rows)
        inside = np.zeros(len(data) + 1, np.int8)
        inside[starts] = 1
        np.subtract.at(inside, ends, 1)
        letters = (np.cumsum(inside[:-1]) > 0) & ((data & 0xC0) != 0x80)
        symbol = np.zeros(256, bool)
        symbol[list(SYMBOLS)] = True
        line, line_rows, numbers, words, repeats = _lines(data, offsets, starts, ends)
        counted = np.bincount(line_rows, minlength=batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("content"),
                batch.column("host"),
                pa.array(n_words.astype(np.int64)),
                pa.array(tb.per_row(letters, offsets)),
                pa.array(tb.per_row(symbol[data], offsets)),
                pa.array(np.bincount(line_rows[repeats], minlength=batch.num_rows)),
                pa.array(_repeated(data, starts, ends, rows, batch.num_rows)),
                tb.lists(
                    np.concatenate([[0], np.cumsum(counted)]),
                    line=line.view(np.int64),
                    number=numbers,
                    words=words.astype(np.int32),
                ),
            ],
            [f.split()[0] for f in PROFILE.split(", ")],
        )


def _later(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose hash occurs earlier in the row, and places of all hashes that recur."""
    order = np.lexsort((hashes, rows))
    same = (rows[order][1:] == rows[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    later = order[1:][same]
    return later, np.union1d(later, order[:-1][same])


def _lines(data, offsets, word_starts, word_ends):
    starts, ends, rows, numbers = tb.lines(data, offsets)
    first = np.searchsorted(word_starts, starts)
    last = np.searchsorted(word_starts, ends)
    full = last > first
    starts, ends, rows, numbers, first, last = (
        x[full] for x in (starts, ends, rows, numbers, first, last)
    )
    loose = tb.sequence_hashes(tb.span_hashes(data, word_starts, word_ends, True), first, last)
    later, _ = _later(rows, tb.span_hashes(data, starts, ends, False))
    return loose, rows, numbers, last - first, later


def _repeated(data, starts, ends, rows, n: int) -> np.ndarray:
    """Words that stand in a window of ``WINDOW`` words which the text has twice or more."""
    hashes, first = tb.window_hashes(tb.span_hashes(data, starts, ends, False), rows, WINDOW)
    _, again = _later(rows[first], hashes)
    cover = np.zeros(len(rows) + WINDOW + 1, np.int64)
    cover[first[again]] += 1
    cover[first[again] + WINDOW] -= 1
    return np.bincount(rows[np.cumsum(cover)[: len(rows)] > 0], minlength=n)


def boilerplate(profiles: DataFrame, min_docs: int = MIN_DOCS, max_share: int = MAX_SHARE) -> DataFrame:
    """(host, line) above the limits. A profile table is read twice, so it should be written."""
    texts = profiles.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("all"))
    seen = (
        profiles.select("host", "content", F.explode("lines.line").alias("line"))
        .distinct()
        .groupBy("host", "line")
        .agg(F.count("*").alias("docs"))
        .filter(F.col("docs") > min_docs)
    )
    above = F.col("docs") * 100 > F.col("all") * max_share
    return seen.join(texts, "host").filter(above).select("host", "line")


def judge(documents: DataFrame, min_left: int = MIN_LEFT, max_share: int = MAX_SHARE) -> DataFrame:
    """One row per document: its counts, the lines taken out of it, and the verdicts.

    ``removed_lines`` has the numbers of the lines (from 0) that are boilerplate.
    """
    profiles = written(profile(documents), "quality")
    frequent = small(written(boilerplate(profiles, max_share=max_share), "boilerplate"))
    key = ["doc_id", "content", "host"]
    found = (
        profiles.select(*key, F.explode(F.array_distinct("lines.line")).alias("line"))
        .join(frequent, ["host", "line"])
        .groupBy(*[F.col(k).alias(f"_{k}") for k in key])
        .agg(F.collect_set("line").alias("found"))
    )
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    out = F.filter("lines", lambda x: F.array_contains("found", x["line"]))
    gone = F.aggregate(out, F.lit(0).cast("bigint"), lambda n, x: n + x["words"])
    left = F.col("n_words") - F.coalesce(gone, F.lit(0))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEATED * F.col("n_words")
    )
    depleted = (left < MIN_WORDS) | (100 * left < min_left * F.col("n_words"))
    return profiles.join(written(found, "found"), same[0] & same[1] & same[2], "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
        left.alias("words_left"),
        F.coalesce(F.transform(out, lambda x: x["number"]), F.array().cast("array<int>")).alias(
            "removed_lines"
        ),
        "content",
        "host",
    )


def clean(documents: DataFrame, **options) -> DataFrame:
    """The documents that are kept, without their boilerplate lines; ``n_chars`` follows the text."""
    key, content, host, gone = (unused(documents, c) for c in ("_id", "_content", "_host", "_gone"))
    kept = (
        judge(documents, **options)
        .filter("kept")
        .select(
            F.col("doc_id").alias(key),
            F.col("content").alias(content),
            F.col("host").alias(host),
            F.col("removed_lines").alias(gone),
        )
        .distinct()
    )
    same = (
        F.col("doc_id").cast("bigint").eqNullSafe(F.col(key))
        & (_content() == F.col(content))
        & (_host() == F.col(host))
    )
    lines = F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains(gone, i))
    text = F.when(F.size(gone) > 0, F.array_join(lines, "\n")).otherwise(F.col("text"))
    return (
        documents.join(written(kept, "kept"), same)
        .withColumn("text", text)
        .withColumn("n_chars", F.length("text").cast("bigint"))
        .select(*quoted(documents.columns))
    )
