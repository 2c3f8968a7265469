"""Benchmark decontamination: windows of a document that are near-copies of a benchmark item.

Texts are word sequences, lower-cased, without punctuation. An item of n words is compared with the
document's windows of n words: the similarity is the weighted Jaccard index of their 5-word shingles,
each weighted by how often it occurs, and a match has 0.8 or more. A document with fewer words than the
item is one window, with its own shingles in the union. An item of fewer than five words is
one shingle, its whole sequence, and matches windows that equal it; an item without words never
matches.

1. Windows. A similar window and the item share ``SHARE`` of the shingles of both, so a document
   needs as many places with a shingle of that item, and only windows that contain enough of these
   places are laid, all of them. This loses no match.
2. SimHash. Each window and item gets a 64-bit SimHash of its weighted shingles. Fingerprints are cut
   into ``BLOCKS`` blocks; within ``RADIUS`` bits, one block differs in at most ``NEAR`` bits, and the
   index holds every item under all block values that near. So the join on blocks finds all
   fingerprints within the radius. At a similarity of 0.8 two fingerprints differ in 10 bits on
   average, with a deviation of 3; the radius is 19.
3. The exact similarity of the candidates decides.

DataFrame functions only. The shingles of the benchmark are broadcast if they are few, else joined by
shuffle. Rows of ``documents`` that repeat a doc_id are returned once per text; a NULL text has no
words; a row without an id is matched like any other. Items that repeat an id are one item for each
text.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkeeper.llm.common import quoted, small, written

WIDTH = 5
SIMILARITY = 80
# 100 * common >= 80 * (n + m - common) gives 80 / 180 of the shingles of item and window.
SHARE = 80 / 180
BLOCKS = (13, 13, 13, 13, 12)
NEAR = 3
RADIUS = len(BLOCKS) * (NEAR + 1) - 1
ITEM_SHINGLES = 4_000_000


def words(text: Column) -> Column:
    """Lower-cased words without punctuation; empty for NULL."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\s]+", "")
    return F.filter(F.split(F.trim(plain), r"\s+"), lambda w: w != "")


def _shingle(sequence: Column, at: Column, n: int = WIDTH) -> Column:
    return F.xxhash64(*[F.get(sequence, at + k) for k in range(n)])


def shingles(df: DataFrame, *keep: str) -> DataFrame:
    """``keep``, at and shingle for each 5-word window of ``words``; a short text is one shingle."""
    n = F.size("words")
    places = F.when(n >= WIDTH, F.sequence(F.lit(0), n - WIDTH)).otherwise(F.array(F.lit(0)))
    rows = df.filter(n > 0).select(*keep, "words", F.explode(places).alias("at"))
    return rows.select(*keep, "at", _shingle(F.col("words"), F.col("at")).alias("shingle"))


def items_of(benchmark: DataFrame) -> DataFrame:
    """item_id, item (a key of id and text), words and size for each item with words."""
    rows = benchmark.select(
        F.col("item_id").cast("bigint").alias("item_id"),
        F.xxhash64("item_id", "text").alias("item"),
        words(F.col("text").cast("string")).alias("words"),
    )
    return rows.withColumn("size", F.size("words")).filter("size > 0").dropDuplicates(["item"])


def _short_places(df: DataFrame, sizes: list[int], *keep: str) -> DataFrame:
    """Shingles of each of the ``sizes`` below five, as windows of whole short items."""
    out = None
    for size in sizes:
        rows = df.filter(F.size("words") >= size).select(
            *keep, "words", F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("at")
        )
        rows = rows.select(*keep, "at", _shingle(F.col("words"), F.col("at"), size).alias("shingle"))
        out = rows if out is None else out.union(rows)
    return out


def windows(documents: DataFrame, items: DataFrame, pieces: DataFrame) -> DataFrame:
    """(doc, doc_id, start, size, words) of the windows that may match an item of ``size`` words.

    ``documents`` has doc, doc_id and words; ``pieces`` (item, shingle, size) is written.
    """
    wanted = small(pieces.select("item", "shingle", "size").distinct(), ITEM_SHINGLES)
    counted = documents.withColumn("n", F.size("words"))
    hits = shingles(counted, "doc", "n").join(wanted, "shingle")
    places = (
        hits.groupBy("doc", "n", "item", "size")
        .agg(F.sort_array(F.collect_set("at")).alias("at"))
        .withColumn("need", F.ceil((F.col("size") + F.least("n", "size") - 2 * (WIDTH - 1)) * F.lit(SHARE) - 1e-9).cast("int"))
        .filter("size(at) >= need")
    )
    # The k-th place is a window's first: the window starts after the place before, no later than
    # the place itself, and late enough to reach the place that makes up the number.
    reach = F.col("size") - WIDTH
    firsts = F.sequence(F.lit(0), F.size("at") - F.col("need"))
    starts = F.flatten(
        F.transform(
            firsts,
            lambda k: F.when(
                F.greatest(F.coalesce(F.get("at", k - 1) + 1, F.lit(0)), F.get("at", k + F.col("need") - 1) - reach)
                <= F.get("at", k),
                F.sequence(
                    F.greatest(
                        F.coalesce(F.get("at", k - 1) + 1, F.lit(0)),
                        F.get("at", k + F.col("need") - 1) - reach,
                        F.lit(0),
                    ),
                    F.get("at", k),
                ),
            ).otherwise(F.array().cast("array<int>")),
        )
    )
    starts = F.when(F.col("n") < F.col("size"), F.array(F.lit(0))).otherwise(starts)
    laid = written(places.select("doc", "size", F.explode(starts).alias("start")).distinct(), "windows")
    docs = laid.select("doc").distinct()
    texts = documents.join(small(written(docs, "hit-docs")), "doc", "left_semi").dropDuplicates(["doc"])
    return (
        laid.join(written(texts, "hit-texts"), "doc")
        .filter((F.col("start") == 0) | (F.col("start") + F.col("size") <= F.size("words")))
        .select("doc", "doc_id", "start", "size", F.slice("words", F.col("start") + 1, F.col("size")).alias("words"))
    )


def fingerprint(weights: DataFrame, *key: str) -> DataFrame:
    """``key`` and the SimHash of (key, shingle, weight) rows.

    Four bits are summed at once, each in 16 bits of a long, which hold weights of up to 65,535.
    """
    lanes = 0x0001000100010001
    sums = [
        F.sum(F.shiftrightunsigned("shingle", k).bitwiseAND(F.lit(lanes)) * F.col("weight")).alias(f"s{k}")
        for k in range(16)
    ]
    summed = weights.groupBy(*key).agg(F.sum("weight").alias("all"), *sums)
    bits = F.lit(0).cast("bigint")
    for k in range(16):
        for j in range(4):
            ones = F.shiftrightunsigned(F.col(f"s{k}"), 16 * j).bitwiseAND(F.lit(0xFFFF))
            bit = F.when(ones * 2 > F.col("all"), F.lit(1)).otherwise(F.lit(0)).cast("bigint")
            bits = bits.bitwiseOR(F.shiftleft(bit, 16 * j + k))
    return summed.select(*key, bits.alias("hash"))


def block_values(hash: Column) -> Column:
    """The blocks of a fingerprint as (block << 16 | value)."""
    out, at = [], 0
    for n, width in enumerate(BLOCKS):
        value = F.shiftrightunsigned(hash, at).bitwiseAND(F.lit(2**width - 1))
        out.append(F.lit(n << 16).cast("bigint").bitwiseOR(value))
        at += width
    return F.array(*out)


def nearby(items: DataFrame) -> DataFrame:
    """Every item (item, size, hash) under all values of a block within ``NEAR`` bits: block, item.

    ``sum(comb(13, k))`` values for a block, 378 at most, whatever the number of items.
    """
    assert sum(comb(max(BLOCKS), k) for k in range(NEAR + 1)) < 400
    flips = F.filter(F.sequence(F.lit(0), F.lit(2 ** max(BLOCKS) - 1)), lambda x: F.bit_count(x) <= NEAR)
    rows = items.select("item", "size", F.col("hash").alias("item_hash"), F.explode(block_values(F.col("hash"))).alias("block"))
    widths = F.array(*[F.lit(2**w) for w in BLOCKS])
    own = F.get(widths, F.shiftright("block", 16).cast("int"))
    return rows.select(
        "item", "size", "item_hash", F.explode(F.filter(flips, lambda x: x < own)).alias("flip"), "block"
    ).select("item", "size", "item_hash", F.col("block").bitwiseXOR(F.col("flip")).alias("block"))


def matches(documents: DataFrame, benchmark: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """doc_id, item_id, start, n_words, similarity: the best window of each document and item.

    ``start`` counts words from 0; the first of equally good windows is given.
    """
    items = written(items_of(benchmark), "items")
    long_items = items.filter(F.col("size") >= WIDTH)
    pieces = written(
        shingles(long_items, "item", "size").groupBy("item", "size", "shingle").agg(F.count("*").alias("weight")),
        "pieces",
    )
    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64("doc_id", "text").alias("doc"),
        words(F.col("text").cast("string")).alias("words"),
    )
    laid = windows(rows, items, pieces).select("doc", "doc_id", "start", "size", "words")
    parts = written(
        shingles(laid.withColumn("n_words", F.size("words")), "doc", "doc_id", "start", "size", "n_words")
        .groupBy("doc", "doc_id", "start", "size", "n_words", "shingle")
        .agg(F.count("*").alias("weight")),
        "window-shingles",
    )
    window_hashes = fingerprint(parts, "doc", "start", "size")
    index = nearby(fingerprint(pieces, "item", "size"))
    near = F.bit_count(F.col("hash").bitwiseXOR(F.col("item_hash"))) <= RADIUS
    pairs = written(
        window_hashes.withColumn("block", F.explode(block_values(F.col("hash"))))
        .join(written(index, "index"), ["block", "size"])
        .filter(near)
        .select("doc", "start", "size", "item")
        .distinct(),
        "pairs",
    )
    item_weights = pieces.select("item", "shingle", F.col("weight").alias("item_weight"))
    totals = pieces.groupBy("item").agg(F.sum("weight").alias("item_all"))
    all_shingles = F.col("n_words") - (WIDTH - 1)
    common = (
        pairs.join(parts, ["doc", "start", "size"])
        .join(item_weights, ["item", "shingle"])
        .groupBy("doc", "doc_id", "start", "size", "n_words", "item")
        .agg(F.sum(F.least("weight", "item_weight")).alias("common"))
        .join(totals, "item")
    )
    union = all_shingles + F.col("item_all") - F.col("common")
    scored = common.filter(F.col("common") * 100 >= union * similarity).select(
        "doc", "doc_id", "item", "start", F.col("n_words").alias("size"), (F.col("common") / union).alias("similarity")
    )
    scored = scored.union(_short_matches(rows, items))
    best = scored.groupBy("doc", "doc_id", "item").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("before"), "size")).alias("best")
    )
    return best.join(items.select("item", "item_id"), "item").select(
        "doc_id",
        "item_id",
        (-F.col("best.before")).alias("start"),
        F.col("best.size").alias("n_words"),
        F.col("best.similarity").alias("similarity"),
    )


def _short_matches(rows: DataFrame, items: DataFrame) -> DataFrame:
    """Windows that equal an item of fewer than five words: its only shingle is the whole."""
    sizes = [r["size"] for r in items.filter(F.col("size") < WIDTH).select("size").distinct().collect()]
    empty = "doc bigint, doc_id bigint, item bigint, start int, size int, similarity double"
    if not sizes:
        return rows.sparkSession.createDataFrame([], empty)
    wanted = items.filter(F.col("size") < WIDTH).select(
        "item", "size", F.xxhash64(*[F.get("words", F.lit(k)) for k in range(WIDTH - 1)]).alias("shingle")
    )
    return _short_places(rows, sizes, "doc", "doc_id").join(small(written(wanted, "short")), "shingle").select(
        "doc", "doc_id", "item", F.col("at").alias("start"), "size", F.lit(1.0).alias("similarity")
    )


def clean(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without those that match an item; a row without an id can't be named and stays."""
    bad = written(matches(documents, benchmark, **options).select("doc_id").distinct(), "contaminated")
    known = bad.filter("doc_id IS NOT NULL")
    kept = documents.join(small(known), "doc_id", "left_anti")
    return kept.select(*quoted(documents.columns))
