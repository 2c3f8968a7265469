"""Columns of the caller that bear the names of internal ones, and languages by brute force."""

import random
import re
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from martkeeper.llm import language_id, registry

NAMES = [
    "_id", "_content", "_host", "_gone", "_removed", "removed_lines", "_n", "_whole", "ids", "n_tokens",
    "content", "host", "kept", "component", "node", "line", "key", "part", "place", "signature", "count",
    "words", "hash", "number", "item", "window",
]


def frame(spark):
    rng = random.Random(4)
    text = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(60))
    rows = [(i, text(), "en", "s") for i in range(8)]
    rows += [(8, rows[0][1] + " more", "en", "s"), (2, text(), "en", None), (2, rows[2][1], "en", "s")]
    rows += [(None, text(), None, "s"), (20, None, "en", "s"), (21, "", None, None)]
    rows = [(*r, len(r[1] or "")) for r in rows]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


@pytest.fixture(scope="module")
def benchmark_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(1, " ".join(f"word{k}" for k in range(40)))], "item_id bigint, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    return folder


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_a_stage_hands_on_columns_with_any_name(spark, benchmark_dir, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    plain = frame(spark)
    clashing = plain.withColumns({n: F.concat(F.lit(n), F.col("doc_id")) for n in NAMES}).withColumn(
        "extra_map", F.create_map(F.lit("k"), F.col("doc_id")))
    clashing = clashing.withColumn("Extra dotted.name", F.lit(1))
    want = stage(spark, plain, benchmark_dir)
    got = stage(spark, clashing, benchmark_dir)
    assert got.columns[: len(clashing.columns)] == clashing.columns
    added = got.columns[len(clashing.columns) :]
    assert added == (["ids_", "n_tokens_"] if name == "sentence_pieces" else [])
    own = [c for c in want.columns if c in plain.columns]
    assert sorted(map(str, got.select(*own).collect())) == sorted(map(str, want.select(*own).collect()))
    for r in got.collect():
        assert all(r[n] == (None if r.doc_id is None else f"{n}{r.doc_id}") for n in NAMES)
        assert r.extra_map == {"k": r.doc_id}


def test_the_pipeline_of_nothing(spark, benchmark_dir, tmp_path):
    frame(spark).limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{benchmark_dir}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def brute_languages(rows):
    """The contract by plain loops: the same sample rule, one compression per text and language."""
    def words(text):
        found = [w for w in re.findall(r"[^\W\d_]+", text.lower()) if any(c.isalpha() for c in w)]
        return f" {' '.join(found)} ".encode() if found else b""

    sample = {}
    for doc_id, text, lang, place in rows:
        held = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2
        if lang is not None and text and not held:
            sample.setdefault(lang, []).append((len(text) > 4_000, place, text[:4_000]))
    learned = {}
    for lang, texts in sample.items():
        texts = sorted(texts, key=lambda t: (t[0], t[1], t[2].encode()))[:128]
        learned[lang] = b"".join(words(t) for k, (long, _, t) in enumerate(texts) if not long or k == 0)
    out = []
    for doc_id, text, _, _ in rows:
        raw, sizes = words(text or ""), []
        held = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2
        if not raw:
            out.append((doc_id, held, "und", 0.0))
            continue
        for lang in sorted(learned):
            shared = zstandard.ZstdCompressionDict(learned[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            shared.precompute_compress(level=3)
            sizes.append((len(zstandard.ZstdCompressor(level=3, dict_data=shared).compress(raw)), lang))
        best = min(sizes)
        rest = min(s for s, lang in sizes if lang != best[1])
        out.append((doc_id, held, best[1], 1 - best[0] / rest))
    return sorted(out, key=str)


def test_languages_are_those_of_plain_loops(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    extra = spark.createDataFrame(
        [(None, "ein Satz ohne Nummer", "de"), (10**9, None, "en"), (10**9 + 1, "", None), (10**9 + 2, "12 _ 3", "en"),
         (10**9 + 3, "Ünïcödé wörds", None), (10**9 + 3, "Ünïcödé wörds", None)],
        "doc_id bigint, text string, lang string")
    rows = table.union(extra)
    placed = rows.withColumn("place", F.xxhash64("doc_id")).collect()
    got = language_id.identify(rows).select("doc_id", "held_out", "lang_pred", "score").collect()
    assert sorted(map(tuple, got), key=str) == brute_languages(placed)
    assert registry.queries()["op10_language_id"](spark, folder).count() == table.count()
