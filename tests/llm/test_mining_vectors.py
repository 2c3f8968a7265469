"""Phrases, whitening and the grid join against plain Python, with their edge cases."""

import collections
import math
import random
import re
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from martkeeper.llm import grid_join, phrases, registry, whitening

DOCS = "doc_id bigint, text string, lang string"
VECTORS = "vec_id bigint, embedding array<float>, label int"


# Phrases -------------------------------------------------------------------------------------


def brute_phrases(rows, least, top):
    counts, totals = collections.Counter(), collections.Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    often = {k: a for k, a in counts.items() if a >= least and len(k[1]) > 1}
    covered = set()
    for (lang, words), a in often.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                part = (lang, words[i : i + k])
                if 100 * a >= 80 * counts[part]:
                    covered.add(part)
    found = collections.defaultdict(list)
    for (lang, words), a in often.items():
        if (lang, words) in covered:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        found[lang].append((-score, -a, " ".join(words).encode(), left, right))
    out = []
    for lang, rows_ in found.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows_)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def corpus(seed, n=300):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["New", "york", "über", "是的", "x" * 400]
    rows = []
    for i in range(n):
        text = ""
        for _ in range(rng.randrange(0, 60)):
            text += rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r", "\x0b"])
        rows.append((i, text, rng.choice(["en", "de", None, "und", ""])))
    rows += [(None, "new york city hall", "en")] * 9 + [(5, None, "en"), (6, "", None), (7, " . ;", "en")]
    rows += [(8, "go go go go go " * 20, "de"), (9, "A b c " * 3000, "en")]
    return rows


@pytest.mark.parametrize("one_in, sample_least", [(1, 1), (3, 2), (10**9, 5), (4, 10**6)])
def test_phrases_are_exact_whatever_the_sample(spark, one_in, sample_least):
    rows = corpus(one_in)
    df = spark.createDataFrame(rows, DOCS).repartition(5)
    got = phrases.collocations(df, 40, 8, one_in, sample_least)
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, 8, 40)


def test_a_full_bitmap_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "MAX_BITS", 1 << 10)
    monkeypatch.setattr(phrases, "MIN_BITS", 1 << 10)
    rows = corpus(3, 800)
    got = phrases.collocations(spark.createDataFrame(rows, DOCS), 100, 4, 3, 2)
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, 4, 100)


def test_border_failures_are_counted_in_further_passes(spark, monkeypatch):
    passes = []
    count = phrases.count_phrases

    def spied(texts, sizes, *rest, **named):
        passes.append(sizes)
        return count(texts, sizes, *rest, **named)

    monkeypatch.setattr(phrases, "count_phrases", spied)
    rows = [(i, "a b c d", "en") for i in range(40)]
    df = spark.createDataFrame(rows, DOCS)
    got = phrases.collocations(df, one_in=10**9)
    assert [r.phrase for r in got.collect()] == ["a b c d"]
    full = [s for s in passes if len(s) > 1]
    assert full == [range(1, 5)] + [range(2, 5)] * 3


@pytest.mark.parametrize("held", [1, 1 << 22])
def test_rare_phrases_are_not_sent_as_rows(spark, monkeypatch, held):
    monkeypatch.setattr(phrases, "HELD", held)
    sent = []
    counted = phrases._counted

    def spied(words, n, *rest):
        sent.append((len(words), len(n)))
        return counted(words, n, *rest)

    rng = random.Random(41)
    rows = [(i, " ".join(f"w{rng.randrange(60)}" for _ in range(50)) + " . new york city", "en") for i in range(60)]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    got = sorted(map(tuple, phrases.collocations(df, 40, 20, 1, 1).collect()))
    assert got == brute_phrases(rows, 20, 40) and any(r[2] == "new york city" for r in got)
    monkeypatch.setattr(phrases, "_counted", spied)
    texts = phrases._texts(spark.createDataFrame(rows, DOCS)).collect()
    batch = pa.RecordBatch.from_pylist([r.asDict() for r in texts])
    known = phrases.proposed(phrases.sampled(phrases._texts(df), 1, 1))
    often = phrases.screened(phrases._texts(df), known, 20)

    class Frame:  # runs the counting here
        def mapInArrow(self, run, _):
            list(run(iter([batch])))
            return phrases.count_phrases(phrases._texts(df), range(1, 2))

    phrases.count_phrases(Frame(), range(1, 5), known, least=20, among=often)
    assert 0 < sum(n for size, n in sent if size > 1) < 20


def test_rare_words_are_not_sent_as_rows(spark):
    rows = [(i, f"new york w{i} x{i} y{i}", "en") for i in range(60)]
    df = spark.createDataFrame(rows, DOCS)
    texts = phrases._texts(df)
    often = phrases.screened(texts, phrases.proposed(phrases.sampled(texts, 1, 1)), 20)
    sent = []
    batch = pa.RecordBatch.from_pylist([r.asDict() for r in texts.collect()])

    class Frame:  # runs the counting here
        def mapInArrow(self, run, _):
            sent.extend(r for b in run(iter([batch])) for r in b.to_pylist())
            return phrases.count_phrases(texts, range(1, 2))

    phrases.count_phrases(Frame(), range(1, 2), least=20, among=often)
    assert {r["text"]: r["n"] for r in sent if r["text"]} == {"new": 60, "york": 60}
    assert [r["n"] for r in sent if not r["w1"]] == [300]


def test_phrases_ignore_other_columns_and_empty_tables(spark):
    df = spark.createDataFrame([], DOCS)
    assert phrases.collocations(df).count() == 0
    clash = ["w1", "n", "key", "cut", "rank", "score", "a", "best", "place"]
    rows = spark.range(35).selectExpr("'see you' AS text", "CAST(NULL AS STRING) AS lang", *[f"id AS {c}" for c in clash])
    assert [tuple(r) for r in phrases.collocations(rows).collect()] == [
        ("und", 1, "see you", 35, 35, 35, 70, 1_000_000)]


def test_scores_beyond_64_bits(spark):
    keys = [(1, 0, 0, 0, "en", "a"), (2, 0, 0, 0, "en", "b"), (1, 2, 0, 0, None, None)]
    counts = [6 * 10**18, 5 * 10**18, 4 * 10**18]
    rows = [(*k, n) for k, n in zip(keys, counts)]
    best = phrases.scored(spark.createDataFrame(rows, phrases.COUNTED)).collect()
    assert [(r.a, r.l, r.r, r.score) for r in best] == [(counts[2], counts[0], counts[1], 2_000_000 * 4 // 11)]


# Whitening -----------------------------------------------------------------------------------


def vectors(rng, n, d, scale=0.3):
    return [(i, [float(np.float32(rng.gauss(0, scale * (1 + k)))) for k in range(d)], 0) for i in range(n)]


def odd_vectors(d):
    return [
        (900, None, 1),
        (901, [None] + [0.0] * (d - 1), 1),
        (902, [float("nan")] + [0.0] * (d - 1), 1),
        (903, [float("inf")] + [0.0] * (d - 1), 1),
        (904, [1.0] * (d + 1), 1),
        (905, [], 1),
    ]


def exact_covariance(x):
    n, d = len(x), len(x[0])
    mean = [Fraction(sum(c), n) for c in zip(*x)]
    return [[sum((r[i] - mean[i]) * (r[j] - mean[j]) for r in x) / n for j in range(d)] for i in range(d)]


@pytest.mark.parametrize("scale, pairs", [(0.3, 256), (0.3, 3), (3e9, 4)])
def test_whitening_matches_exact_arithmetic(spark, monkeypatch, scale, pairs):
    monkeypatch.setattr(whitening, "PAIRS", pairs)
    rng = random.Random(5)
    d = 5
    good = vectors(rng, 120, d, scale)
    good += good[:7] + [(None, good[3][1], 2)]
    df = spark.createDataFrame(good + odd_vectors(d), VECTORS).repartition(4)
    got = whitening.whiten(df).collect()
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v, _ in good]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    cov = np.array([[float(c) for c in row] for row in exact_covariance(x)])
    fitted = whitening.fit(whitening.finite_vectors(df), d)
    assert fitted.n == n and fitted.sums == sums
    assert (fitted.covariance() == cov).all()
    assert len(got) == n * 5 and {r.n for r in got} == {n}
    deviations = collections.Counter(sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x)
    assert collections.Counter(int(r.deviation) for r in got if r.component == 1) == deviations
    values = np.linalg.eigvalsh(cov)[::-1]
    for k in range(5):
        white = np.array([r.whitened for r in got if r.component == k + 1])
        assert abs(white.mean()) < 1e-9 and abs(white.var() - 1) < 1e-9
        assert {round(r.explained / (values[k] / values.sum()), 9) for r in got if r.component == k + 1} == {1.0}
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-9


def test_whitening_without_rows_or_variance(spark):
    df = spark.createDataFrame(odd_vectors(3)[:4], VECTORS)
    assert whitening.whiten(df).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [], 0)], VECTORS)).count() == 0
    same = spark.createDataFrame([(i, [0.5, 1.0], 0) for i in range(3)], VECTORS)
    got = whitening.whiten(same).collect()
    assert len(got) == 6 and all(r.whitened is None and r.deviation == 0 for r in got)
    line = spark.createDataFrame([(i, [float(i), 1.0, 0.0], 0) for i in range(4)], VECTORS)
    got = {(r.vec_id, r.component): r for r in whitening.whiten(line).collect()}
    assert got[0, 2].whitened is None and got[0, 1].explained == 1.0
    assert got[0, 1].identity_error < 1e-12
    assert abs(abs(got[0, 1].whitened) - 1.5 / math.sqrt(1.25)) < 1e-12


# Grid join -----------------------------------------------------------------------------------


def brute_links(rows, cosine, d):
    fit = [
        v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v) and any(v)
        for _, v, _ in rows
    ]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if fit[i] and fit[j]:
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= cosine:
                    links[i] += 1
                    links[j] += 1
                    group[root(i)] = root(j)
    ids = collections.defaultdict(list)
    for i, (vec_id, _, _) in enumerate(rows):
        if vec_id is not None:
            ids[root(i)].append(vec_id)
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        least = min(ids[root(i)]) if ids[root(i)] else None
        out.append((vec_id, links[i], least, None if vec_id is None else vec_id == least))
    return out


def families(seed, d=6):
    rng = random.Random(seed)
    rows = []
    for spread in (0.0, 0.01, 0.05, 0.3):
        centre = [rng.gauss(0, 1) for _ in range(d)]
        for _ in range(45):
            rows.append([c + rng.gauss(0, spread) for c in centre])
    start = [rng.gauss(0, 1) for _ in range(d)]
    for k in range(30):  # a chain: each is near the next one only
        angle = k * 0.2
        rows.append([math.cos(angle), math.sin(angle), *start[2:4], 0.0, 0.0][:d])
    rows += [[rng.gauss(0, 1) for _ in range(d)] for _ in range(60)]
    rows += [[c * 7 for c in rows[3]], [c * 1e-30 for c in rows[50]], [0.0] * d, [-0.0] * d]
    rng.shuffle(rows)
    out = [(i, [float(np.float32(c)) for c in v], 0) for i, v in enumerate(rows)]
    return out + [(3, out[8][1], 1), (None, out[9][1], 1), (None, [9.0, -9.0, 9.0, 9.0, -9.0, 9.0][:d], 1)]


@pytest.mark.parametrize("block, leaf, fan", [(4096, 256, 8), (32, 4, 2), (8, 3, 3)])
def test_grid_join_matches_all_pairs(spark, monkeypatch, block, leaf, fan):
    monkeypatch.setattr(grid_join, "LEAF", leaf)
    monkeypatch.setattr(grid_join, "FAN", fan)
    monkeypatch.setattr(grid_join, "BLOCK_BYTES", block * 8 * 6)
    rows = families(block) + odd_vectors(6)
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    got = sorted(map(tuple, grid_join.near_vectors(df).collect()), key=str)
    assert got == sorted(brute_links(rows, 0.9, 6), key=str)


def test_distant_and_whole_blocks_are_not_compared(spark, monkeypatch):
    monkeypatch.setattr(grid_join, "LEAF", 16)
    monkeypatch.setattr(grid_join, "FAN", 2)
    monkeypatch.setattr(grid_join, "BLOCK_BYTES", 16 * 8 * 4)
    rng = random.Random(2)
    rows = [(i, [float((i // 128) == k) + rng.gauss(0, 0.002) for k in range(4)], 0) for i in range(512)]
    df = spark.createDataFrame(rows, VECTORS)
    found, d = grid_join.classes(df)
    eps = math.sqrt(0.2)
    axes = grid_join.principal_axes(found, d)
    nodes = grid_join.written(grid_join.grid_order(found, d, axes, eps), "nodes")
    blocks = grid_join.written(grid_join.pack(nodes, d, 16, axes), "blocks")
    pairs, whole = grid_join.interval_join(grid_join.interval_levels(blocks), eps)
    assert pairs.count() == 0
    assert sum(w.count() for w in whole) == 4  # each family is one interval of 128 classes
    got = grid_join.near_vectors(df).collect()
    assert {r.n_links for r in got} == {127} and {r.component_id for r in got} == {0, 128, 256, 384}


def test_grid_join_of_copies_nothing_and_other_columns(spark):
    assert grid_join.near_vectors(spark.createDataFrame([], VECTORS)).count() == 0
    copies = spark.range(1000).selectExpr(
        "id AS vec_id", "array(float(1), float(id % 2)) AS embedding", "id AS node", "id AS vector",
        "1 AS weight", "2 AS component", "3 AS i")
    got = grid_join.near_vectors(copies).collect()
    assert {(r.component_id, r.n_links) for r in got} == {(0, 499), (1, 499)}
    assert {r.vec_id for r in got if r.kept} == {0, 1}
    lonely = spark.createDataFrame(odd_vectors(3)[:4], VECTORS)
    assert {tuple(r) for r in grid_join.near_vectors(lonely).collect()} == {
        (i, 0, i, True) for i in range(900, 904)}


def test_vector_queries_have_the_contracts_columns(spark, folder):
    white = registry.queries()["op12_whitening"](spark, folder)
    assert dict(white.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
        "whitened": "double", "explained": "double", "identity_error": "double"}
    assert white.count() == 8 * 500
    assert white.agg({"identity_error": "max"}).first()[0] < 1e-4
