"""Phrase collocations: frequent phrases by Toivonen's sampling, ranked by their weakest cut.

A phrase is a run of up to ``LONGEST`` words of a piece, and can only be frequent if the phrases
without its last and without its first word are. A sample of the documents is mined level by level
with a lowered limit and proposes a set of phrases. Two passes over all documents then count the
proposed phrases and their negative border exactly: the border are the phrases whose two parts are
proposed, though they aren't themselves, and a word always. Most of them are rare, so the first pass
adds up words and phrases by 32 bits of their hash (Park, Chen and Yu, 1995), which shuffles five bytes for
each, and the second counts those whose sum reaches the limit. If a border phrase turns out frequent,
the proposals were too few; a further pass counts the phrases whose parts are frequent and that no
pass has counted, until no such phrase is frequent. The result is exact, whatever the sample; the
sample decides the number of passes, three more at most.

The proposals reach the tasks as a bitmap of hashes. It has ``BITS_EACH`` bits for each phrase up to
``MAX_BITS`` in all, so the broadcast is bounded; a full bitmap, or two phrases on one bit, let more
phrases be counted and lose none. Counts are pre-aggregated in the tasks, by slice and then by
Spark, before they are shuffled.

Words stand as 64-bit hashes of word and language, and a phrase as a tuple of these; words
are counted by their text as well, and texts are joined to the ranked phrases only.

A NULL text is empty, a NULL language is ``und``; repeated rows count each; without a frequent
phrase the result is empty. Equal scores and counts are ranked by the phrase's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkeeper.llm import textbytes as tb
from martkeeper.llm.common import written

# What ends a piece, and what separates words within one.
ENDS = b".,;:!?\n\x0b\x0c\r"
BLANKS = b" \t"

LONGEST = 4
LEAST = 30
COVERED = 80
TOP = 2000
UNKNOWN = "und"

SAMPLE_ONE_IN = 8
SAMPLE_LEAST = 2

HELD = 1 << 22

BITS_EACH = 16
MIN_BITS = 1 << 16
MAX_BITS = 1 << 28

KEYS = ["w1", "w2", "w3", "w4"]
COUNTED = "w1 bigint, w2 bigint, w3 bigint, w4 bigint, lang string, text string, n bigint"
FOLD = np.uint64(0xD6E8FEB86659FD93)


def _texts(documents: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))
    return documents.select(lang.alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def fold(words: list[np.ndarray]) -> np.ndarray:
    """A 64-bit hash of each phrase, from the hashes of its words; absent words aren't given."""
    total = np.ones(len(words[0]), np.uint64)
    for w in words:
        total = tb.mix(total * FOLD + w)
    return total


@dataclass(frozen=True)
class Proposed:
    """A set of phrases as a bitmap; phrases that aren't in the set may seem to be."""

    bits: int
    bitmap: Broadcast

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64(self.bits - 1)
        return self.bitmap.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1


def proposed(phrases: DataFrame) -> Proposed:
    """The bitmap of a table of phrases."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [c.to_numpy().view(np.uint64) for c in batch.columns]
            size = sum((w != 0).astype(int) for w in words)
            at = np.empty(batch.num_rows, np.uint64)
            for k in range(1, LONGEST + 1):
                of = size == k
                at[of] = fold([w[of] for w in words[:k]]) & np.uint64(MAX_BITS - 1)
            yield pa.RecordBatch.from_arrays([pa.array(at.view(np.int64))], ["at"])

    return bitmap_of(phrases.select(*KEYS).mapInArrow(places, "at bigint"), phrases.count())


def bitmap_of(hashes: DataFrame, n: int) -> Proposed:
    """The bitmap of ``n`` hashes (at); it passes through the driver and is bounded."""
    wanted = max(MIN_BITS, BITS_EACH * n)
    bits = min(MAX_BITS, 1 << (wanted - 1).bit_length())
    at = hashes.select(F.col("at").bitwiseAND(F.lit(bits - 1)).alias("at"))
    # Spark numbers the bits of a bucket from 1 on.
    chunks = at.groupBy(F.bitmap_bucket_number(F.col("at") + 1).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col("at") + 1)).alias("chunk")
    )
    bitmap = np.zeros(bits // 8, np.uint8)
    for row in chunks.collect():
        start = (row.bucket - 1) * 4096
        bitmap[start : start + 4096] |= np.frombuffer(row.chunk, np.uint8)[: len(bitmap) - start]
    return Proposed(bits, hashes.sparkSession.sparkContext.broadcast(bitmap))


def _word_keys(batch: pa.RecordBatch):
    """(data, starts, ends, keys, joined, lang of each word) of a slice.

    ``joined`` tells whether a word and the next one stand in one piece.
    """
    data, offsets = tb.buffers(batch.column("text"))
    starts, ends, rows = tb.spans(data, offsets, ENDS + BLANKS)
    is_end = np.zeros(256, bool)
    is_end[list(ENDS)] = True
    piece = np.cumsum(is_end[data])[starts] if len(starts) else np.empty(0, np.int64)
    joined = np.zeros(len(starts), bool)
    joined[:-1] = (rows[1:] == rows[:-1]) & (piece[1:] == piece[:-1])
    lang = batch.column("lang").dictionary_encode()
    names = lang.dictionary.to_pylist()
    name_bytes, name_offsets = tb.buffers(lang.dictionary.cast(pa.string()))
    salt = tb.span_hashes(name_bytes, name_offsets[:-1], name_offsets[1:], False) * FOLD
    code = lang.indices.to_numpy()[rows]
    keys = tb.mix(tb.span_hashes(data, starts, ends, True) + salt[code])
    keys[keys == 0] = 1  # 0 stands for no word
    return data, starts, ends, keys, joined, code, names


def _counted(words: list[np.ndarray], n: np.ndarray, lang=None, text=None) -> pa.RecordBatch:
    none = np.zeros(len(n), np.int64)
    columns = [pa.array(w.view(np.int64)) for w in words]
    columns += [pa.array(none)] * (LONGEST - len(words))
    empty = pa.nulls(len(n), pa.string())
    columns += [empty if lang is None else lang, empty if text is None else text, pa.array(n.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, [*KEYS, "lang", "text", "n"])


def _lowered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    take = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    return pa.Array.from_buffers(
        pa.large_string(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(lower[data[take]])]
    ).cast(pa.string())


def _longer(keys, joined, longest, known, before=(), among=None):
    """(size, starts, hashes, new): where a slice's phrases of two words or more start whose two parts are known.

    ``new`` are those that no pass with a proposal of ``before`` has counted. ``among`` has all frequent ones;
    others, and what is longer than these, are left out.
    """
    # reached: whether the pass with that proposal counts the phrase of the size that starts there.
    starts, hashes = np.arange(len(keys)), fold([keys])
    reached = [np.ones(len(keys), bool) for _ in (known, *before)]
    for size in range(2, longest + 1):
        parts = []
        for p, r in zip((known, *before), reached, strict=True):
            inside = np.zeros(len(keys) + 1, bool)
            inside[starts] = r & p.has(hashes)
            parts.append(inside)
        both = parts[0][starts] & parts[0][starts + 1] & joined[starts + size - 2]
        starts = starts[both]
        hashes = tb.mix(hashes[both] * FOLD + keys[starts + size - 1])
        reached = [p[starts] & p[starts + 1] for p in parts]
        if among is not None:
            reached[0] &= among.has(hashes)
        yield size, starts, hashes, reached[0] & ~np.logical_or.reduce([np.zeros(len(starts), bool), *reached[1:]])


def _distinct(keys: np.ndarray, size: int, starts: np.ndarray, hashes: np.ndarray):
    """(words, n) of the phrases of a size that start there: each one's words and number."""
    order = np.argsort(hashes)
    words = [keys[starts[order] + k] for k in range(size)]
    other = np.zeros(max(len(starts) - 1, 0), bool)
    for w in words:
        other |= w[1:] != w[:-1]
    first = np.flatnonzero(np.append(True, other)) if len(starts) else order
    return [w[first] for w in words], np.diff(np.append(first, len(starts)))


def screened(texts: DataFrame, known: Proposed, least: int = LEAST) -> Proposed:
    """All frequent words, and all frequent phrases whose two parts are known, and a few others.

    Tasks send the number of phrases of each 32-bit hash, up to ``least``; phrases with a hash of fewer are rare.
    """
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind, step = np.min_scalar_type(least), -(-(1 << 32) // parts)

    def packed(held: list) -> pa.RecordBatch:
        at = np.concatenate(held)
        at.sort()
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.empty(0, int)
        n = np.minimum(np.diff(np.append(first, len(at))), least).astype(kind)
        at = at[first]
        part, first = np.unique(at // np.uint32(step) if parts > 1 else np.zeros_like(at), return_index=True)
        bounds = np.append(first, len(at))
        columns = [
            pa.array([x[i:j].tobytes() for i, j in zip(bounds, bounds[1:], strict=False)], pa.binary()) for x in (at, n)
        ]
        return pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), *columns], ["part", "hashes", "counts"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in tb.sliced(batches):
            _, _, _, keys, joined, _, _ = _word_keys(batch)
            held.append(fold([keys]).astype(np.uint32))
            held += [hashes.astype(np.uint32) for _, _, hashes, _ in _longer(keys, joined, LONGEST, known)]
            if sum(map(len, held)) > HELD:
                yield packed(held)
                held = []
        if held:
            yield packed(held)

    def reach(table: pa.Table) -> pa.Table:
        at, n = (
            np.frombuffer(b"".join(table.column(c).to_pylist()), k) for c, k in (("hashes", np.uint32), ("counts", kind))
        )
        order = np.argsort(at)
        at, n = at[order], n[order].astype(np.int64)
        first = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else order
        often = np.add.reduceat(n, first) >= least if len(at) else order
        return pa.table({"at": at[first[often]].astype(np.int64)})

    sent = texts.mapInArrow(send, "part int, hashes binary, counts binary")
    found = written(sent.groupBy("part").applyInArrow(reach, "at bigint"), "open")
    return bitmap_of(found, found.count())


def count_phrases(
    texts: DataFrame,
    sizes: range,
    known: Proposed | None = None,
    counted: list[Proposed] | None = None,
    least: int = LEAST,
    among: Proposed | None = None,
) -> DataFrame:
    """Exact counts, of at least ``least``, of the phrases of these sizes whose two parts are known.

    Phrases that a pass with one of the proposals ``counted`` has counted are left out, and those that aren't
    in ``among``, which has all frequent ones, words too. Words need no parts and come with their language and
    text. A row without a word has the number of all words of a language.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.sliced(batches):
            data, starts, ends, keys, joined, code, names = _word_keys(batch)
            if not len(starts):
                continue
            if 1 in sizes:
                at = np.arange(len(keys)) if among is None else np.flatnonzero(among.has(fold([keys])))
                unique, first, n = np.unique(keys[at], return_index=True, return_counts=True)
                first = at[first]
                lang = pa.DictionaryArray.from_arrays(pa.array(code[first]), names).cast(pa.string())
                yield _counted([unique], n, lang, _lowered(data, starts[first], ends[first]))
                per_lang = np.bincount(code, minlength=len(names))
                yield _counted([np.zeros(len(names), np.uint64)], per_lang, pa.array(names, pa.string()))
            if sizes[-1] == 1:
                continue
            for size, at, hashes, new in _longer(keys, joined, sizes[-1], known, counted or [], among):
                if size in sizes:
                    yield _counted(*_distinct(keys, size, at[new], hashes[new]))

    rows = texts.mapInArrow(count, COUNTED)
    totals = rows.groupBy(*KEYS, "lang", "text").agg(F.sum("n").alias("n"))
    return totals.filter((F.col("n") >= least) | (F.col("w1") == 0))


def size_of() -> Column:
    return sum((F.col(w) != 0).cast("int") for w in KEYS)


def _phrases(rows: DataFrame) -> DataFrame:
    return rows.filter("w1 <> 0")


def sampled(texts: DataFrame, one_in: int, least: int) -> DataFrame:
    """The proposals: what is frequent in the sample, level by level."""
    share = F.pmod(F.xxhash64("text"), F.lit(one_in)) == 0
    sample = written(texts.filter(share), "phrase-sample")
    found = written(_phrases(count_phrases(sample, range(1, 2), least=least)).select(*KEYS), "proposed")
    for size in range(2, LONGEST + 1):
        last = found.filter(size_of() == size - 1)
        level = count_phrases(sample, range(size, size + 1), proposed(found), least=least)
        found = written(found.union(_phrases(level).select(*KEYS)), "proposed")
        if last.isEmpty():
            break
    return found


def frequent_phrases(
    documents: DataFrame,
    least: int = LEAST,
    one_in: int = SAMPLE_ONE_IN,
    sample_least: int = SAMPLE_LEAST,
) -> DataFrame:
    """Every phrase that occurs ``least`` times or more, with its exact count.

    The rows are those of :func:`count_phrases`, with the number of words per language.
    """
    texts = _texts(documents)
    guess = sampled(texts, one_in, sample_least)
    known = proposed(guess)
    often = screened(texts, known, least)
    found = written(count_phrases(texts, range(1, LONGEST + 1), known, least=least, among=often), "phrases")
    fresh = _phrases(found).join(guess, KEYS, "left_anti")
    passes = [known]
    while not fresh.filter(size_of() < LONGEST).isEmpty():
        known = proposed(_phrases(found))
        more = written(count_phrases(texts, range(2, LONGEST + 1), known, passes, least), "phrases")
        passes = [*passes, known]
        fresh, found = more, found.union(more)
    return found


def _part(first: int, last: int) -> Column:
    """Words ``first`` to ``last`` as the key of a phrase."""
    words = [F.col(w) for w in KEYS[first:last]]
    return F.struct(*words, *[F.lit(0).cast("bigint")] * (LONGEST - len(words)))


def scored(found: DataFrame) -> DataFrame:
    """Phrases of two words or more with their lowest cut, without those that a longer one covers."""
    counts = _phrases(found).select(F.struct(*KEYS).alias("key"), F.col("n").alias("a"))
    phrases = _phrases(found).select(*KEYS, F.col("n").alias("a"), size_of().alias("size"))
    cuts = phrases.filter("size > 1").select(
        *KEYS, "a", F.explode(F.filter(
            F.array(*[
                F.struct(F.lit(k).alias("k"), F.lit(s).alias("of"), _named(_part(0, k)).alias("left"),
                         _named(_part(k, s)).alias("right"))
                for s in range(2, LONGEST + 1) for k in range(1, s)
            ]), lambda c: c["of"] == F.col("size"))).alias("cut"))
    cuts = cuts.select(*KEYS, "a", "cut.k", "cut.left", "cut.right")
    left = counts.select(F.col("key").alias("left"), F.col("a").alias("l"))
    right = counts.select(F.col("key").alias("right"), F.col("a").alias("r"))
    score = F.expr(
        "CAST(a AS DECIMAL(20,0)) * 2000000 div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))"
    )
    joined = cuts.join(left, "left").join(right, "right").withColumn("score", score)
    best = joined.groupBy(*KEYS, "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return _uncovered(best.select(*KEYS, "a", "best.score", "best.l", "best.r"), phrases)


def _named(key: Column) -> Column:
    return key.cast("struct<w1:bigint,w2:bigint,w3:bigint,w4:bigint>")


def _uncovered(best: DataFrame, phrases: DataFrame) -> DataFrame:
    inside = F.array(*[
        F.struct(F.lit(s).alias("of"), _named(_part(i, i + k)).alias("key"))
        for s in range(3, LONGEST + 1) for k in range(2, s) for i in range(s - k + 1)
    ])
    longer = phrases.filter("size > 2").select(
        "a", F.explode(F.filter(inside, lambda p: p["of"] == F.col("size"))).alias("p"))
    most = longer.select("a", "p.key.*").groupBy(*KEYS).agg(F.max("a").alias("longer"))
    covered = F.col("longer").cast("decimal(20,0)") * 100 >= F.col("a").cast("decimal(20,0)") * COVERED
    joined = best.join(most, KEYS, "left")
    return joined.filter(~F.coalesce(covered, F.lit(False))).drop("longer")


def collocations(
    documents: DataFrame,
    top: int = TOP,
    least: int = LEAST,
    one_in: int = SAMPLE_ONE_IN,
    sample_least: int = SAMPLE_LEAST,
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    found = frequent_phrases(documents, least, one_in, sample_least)
    words = found.filter("text IS NOT NULL").select("w1", "lang", "text")
    rows = scored(found).join(words.select("w1", "lang"), "w1")
    order = [F.desc("score"), F.desc("a")]
    near = rows.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order)))
    near = written(near.filter(F.col("place") <= top), "ranked")
    for w in KEYS:
        text = words.select(F.col("w1").alias(w), F.col("text").alias(f"{w}_text"))
        near = near.join(text, w, "left")
    phrase = F.concat_ws(" ", *[f"{w}_text" for w in KEYS])
    near = near.withColumn("phrase", phrase)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))
    totals = found.filter("w1 = 0").groupBy("lang").agg(F.sum("n").alias("n"))
    ranked = near.withColumn("rank", rank.cast("bigint")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score")
    )
