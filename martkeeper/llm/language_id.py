"""Language identification by compression.

For each language whole sample texts make a raw-content dictionary for zstandard; a text belongs to
the language whose dictionary compresses it to the fewest bytes. Of a text, sampled or predicted, the
words of letters count, in lower case and a space apart: signs and digits are no language's own. The score is the share of the
second smallest size that the smallest saves, and a prediction is rejected (``accepted`` is false)
if that margin is narrow. Ties go to the first language in alphabetical order.

Learned from at most ``SAMPLE_TEXTS`` texts of at most ``SAMPLE_CHARS`` characters per language: those
with the smallest hashes of their ids, so the sample is the same in every run. A language with longer
texts only is learned from the beginning of one. Rows without a
language or text teach nothing. A text that is NULL or has no letter is ``und`` with score 0. Every
row is predicted from its whole text; a row without an id may be learned from and isn't held out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_TEXTS = 128
SAMPLE_CHARS = 4_000
LEVEL = 3
MARGIN = 0.01
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")


def held_out(fold: int = 2, folds: int = 4) -> Column:
    """Whether a document's id falls in the fold that is kept from learning."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))


def learn(documents: DataFrame) -> dict[str, bytes]:
    """The dictionary of each language; ``documents`` has doc_id, text and lang.

    The rows are limited per language before the shuffle; the driver gets the sample only.
    """
    usable = documents.filter(F.col("lang").isNotNull() & (F.length("text") > 0)).select(
        F.col("lang").cast("string").alias("lang"),
        F.substring("text", 1, SAMPLE_CHARS).alias("text"),
        F.xxhash64("doc_id").alias("place"),
        (F.length("text") > SAMPLE_CHARS).alias("long"),
    )
    order = Window.partitionBy("lang").orderBy("long", "place", "text")
    sample = usable.withColumn("n", F.row_number().over(order)).filter(
        (F.col("n") <= SAMPLE_TEXTS) & (~F.col("long") | (F.col("n") == 1))
    )
    texts: dict[str, list[str]] = {}
    for row in sample.orderBy("lang", "n").collect():
        texts.setdefault(row["lang"], []).append(row["text"])
    return {lang: b"".join(map(words, t)) for lang, t in texts.items()}


def predict(documents: DataFrame, dictionaries: dict[str, bytes], margin: float = MARGIN) -> DataFrame:
    """``documents`` (doc_id, held_out, text) with lang_pred, score and accepted in place of text."""
    shared = documents.sparkSession.sparkContext.broadcast(dictionaries)
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "held_out", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, sizers = _compressors(tuple(sorted(shared.value.items())))
        for batch in batches:
            results = [_predict(t, languages, sizers) for t in batch.column("text").to_pylist()]
            score = np.array([r[1] for r in results])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array([r[0] for r in results], pa.string()),
                    pa.array(score),
                    pa.array(score >= margin),
                ],
                ["doc_id", "held_out", "lang_pred", "score", "accepted"],
            )

    return rows.mapInArrow(
        run, "doc_id bigint, held_out boolean, lang_pred string, score double, accepted boolean"
    )


@cache
def _compressors(dictionaries: tuple[tuple[str, bytes], ...]):
    sizers = []
    for _, raw in dictionaries:
        content = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(level=LEVEL)
        sizers.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=content).compress)
    return [lang for lang, _ in dictionaries], sizers


def words(text: str) -> bytes:
    """The words of letters in lower case, each between spaces; empty without a letter."""
    found = _LETTERS.findall(text.lower())
    return f" {' '.join(found)} ".encode() if any(any(map(str.isalpha, w)) for w in found) else b""


def _predict(text: str | None, languages: list[str], sizers: list) -> tuple[str, float]:
    raw = words(text or "") if languages else b""
    if not raw:
        return UNKNOWN, 0.0
    sizes = [len(compress(raw)) for compress in sizers]
    best = min(range(len(sizes)), key=sizes.__getitem__)
    others = sizes[:best] + sizes[best + 1 :]
    return languages[best], 1 - sizes[best] / min(others) if others else 1.0


def identify(documents: DataFrame) -> DataFrame:
    """Learn from the documents that aren't held out and predict all of them."""
    marked = documents.select("doc_id", "text", "lang", held_out().alias("held_out"))
    return predict(marked, learn(marked.filter(~F.col("held_out"))))
