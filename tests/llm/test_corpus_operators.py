"""Near-duplicates, decontamination, token counts, scores and the pipeline against plain Python."""

import collections
import math
import random
import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from martkeeper.llm import decontam, lm_scoring, near_dups, registry, token_counts
from martkeeper.llm.common import connected

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORD = re.compile("[^\x20\x09-\x0d]+")


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 8))) for _ in range(n))


def shingle_set(text, width):
    words = [w.lower() for w in WORD.findall(text or "")]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def components(rows, width):
    """Smallest id of each row's group by comparing all pairs."""
    sets = [shingle_set(t, width) for _, t in rows]
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None:
                continue
            common = len(sets[i] & sets[j])
            if rows[i][0] == rows[j][0] and sets[i] and sets[j] or common and 100 * common >= 80 * len(sets[i] | sets[j]):
                group[root(i)] = root(j)
    smallest = collections.defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[root(i)].append(doc_id)
    return [None if rows[i][0] is None else min(smallest[root(i)]) for i in range(len(rows))], sets


def family(rng, n, edits, words=60):
    base = sentence(rng, words).split()
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(len(copy))] = sentence(rng, 1)
        out.append(" ".join(copy))
    return out


def test_near_copies_are_linked_as_by_all_pairs(spark):
    rng = random.Random(7)
    passage = sentence(rng, 25)
    texts = family(rng, 60, 1) + family(rng, 60, 3, 90) + [f"{passage} {sentence(rng, 40)}" for _ in range(40)]
    texts += [f"{passage} {sentence(rng, 4)}" for _ in range(12)] + [sentence(rng, 30).upper() for _ in range(5)] * 2
    texts += ["a b", "A  b", "a b c", "one", "", None, " \n", "w " * 3000]
    chain = sentence(rng, 100).split()  # each is near the next one only
    for k in range(12):
        texts.append(" ".join(chain[k * 6 : k * 6 + 80]))
    rng.shuffle(texts)
    rows = list(enumerate(texts, 100)) + [(None, texts[0]), (100, texts[0]), (101, sentence(rng, 20))]
    expected, sets = components(rows, 4)
    frame = docs(spark, rows).repartition(3)
    got = near_dups.groups(frame, width=4).collect()
    assert len(got) == len(rows)
    want = collections.Counter(
        (i, len(s), c, i is None or c == i) for (i, _), s, c in zip(rows, sets, expected, strict=True)
    )
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == want
    kept = near_dups.one_of_each(frame, width=4)
    assert kept.columns == frame.columns
    ids = [r.doc_id for r in kept.collect()]
    assert collections.Counter(ids) == collections.Counter([*{c for c in expected if c is not None}, None])
    assert near_dups.groups(docs(spark, []), width=4).count() == 0


def test_long_paths_become_one_component(spark):
    edges = [(i, i + 1) for i in range(1, 300)] + [(1000, 1001), (2000, 1000), (5, 5)]
    got = dict(connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect())
    assert got == {**{i: 1 for i in range(1, 301)}, 1000: 1000, 1001: 1000, 2000: 1000}
    assert connected(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_items_are_found_as_by_all_windows(spark):
    rng = random.Random(8)
    items = [sentence(rng, n) for n in (5, 8, 14, 30, 55)] + ["two words", "...", "", None, "a a a a a a a a"]
    items.append(items[3])
    def plain(text):
        return [w for w in re.sub(r"[^\w\s]|_", "", (text or "").lower()).split() if w]
    rows = []
    for i in range(80):
        text = sentence(rng, rng.randrange(0, 60)).split()
        item = plain(items[rng.randrange(len(items))])
        for _ in range(rng.randrange(3)):
            if item:
                item[rng.randrange(len(item))] = sentence(rng, 1)
        if rng.random() < 0.3 and len(item) > 12:
            item = item[len(item) // 2 :] + item[: len(item) // 2]
        at = rng.randrange(len(text) + 1)
        rows.append((i, " ".join(text[:at]) + " " + ", ".join(item).title() + ". " + " ".join(text[at:])))
    rows += [(200, items[4]), (200, items[4]), (None, items[3]), (201, None), (202, ""), (203, "two words more"), (204, "b a a a a a a a a a")]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r for r in decontam.matches(docs(spark, rows), bench).collect()}
    want = {}
    for doc_id, text in rows:
        words = plain(text)
        for item_id, item in enumerate(items):
            own = plain(item)
            n = len(own)
            for start in range(len(words) - n + 1 if n else 0):
                width = min(5, n)
                a, b = (collections.Counter(tuple(x[i : i + width]) for i in range(len(x) - width + 1)) for x in (own, words[start : start + n]))
                share = sum((a & b).values()) / sum((a | b).values())
                if share >= 0.8 and share > want.get((doc_id, item_id), (0,))[0]:
                    want[doc_id, item_id] = share, start, n
    assert {k: (round(r.similarity, 9), r.start, r.n_words) for k, r in got.items()} == {
        k: (round(s, 9), a, n) for k, (s, a, n) in want.items()
    }
    assert len(want) > 20
    left = {r.doc_id for r in decontam.clean(docs(spark, rows), bench).collect()}
    assert left == {i for i, _ in rows} - {d for d, _ in want if d is not None}
    assert decontam.matches(docs(spark, []), bench).count() == 0
    assert decontam.matches(docs(spark, rows), bench.filter("item_id < 0")).count() == 0


def test_the_index_finds_all_fingerprints_in_the_radius(spark):
    rng = np.random.default_rng(9)
    hashes = rng.integers(-(2**63), 2**63, 40)
    flips = [sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 26), replace=False)) for _ in hashes]
    queries = [int(np.int64(np.uint64(int(h) % 2**64) ^ np.uint64(f))) for h, f in zip(hashes, flips, strict=True)]
    items = spark.createDataFrame([(i, 9, int(h)) for i, h in enumerate(hashes)], "item bigint, size int, hash bigint")
    asked = spark.createDataFrame(list(enumerate(queries)), "q bigint, hash bigint")
    from pyspark.sql import functions as F

    blocks = asked.withColumn("block", F.explode(decontam.block_values(F.col("hash"))))
    found = {(r.q, r.item) for r in blocks.join(decontam.nearby(items), "block").select("q", "item").distinct().collect()}
    inside = {(q, i) for q, h in enumerate(queries) for i, g in enumerate(hashes.tolist()) if ((h ^ g) % 2**64).bit_count() <= decontam.RADIUS}
    assert len(inside) > 20 and inside <= found


def test_ledger_follows_inserts_deletes_and_revisions(spark, tmp_path):
    ledger = token_counts.TokenLedger(spark, str(tmp_path))
    schema = "doc_id bigint, version string, op string, source string, lang string, n_tokens bigint, N int"

    def batch(*rows):
        return spark.createDataFrame([(*r, 1) for r in rows], schema)

    def totals():
        return {(r.source, r.lang, r.version): (r.docs, r.tokens) for r in ledger.totals().collect()}

    assert totals() == {}
    first = batch(
        (1, "v1", "insert", "a", "en", 10), (2, "v1", "insert", "a", None, 5), (2, "v2", "insert", "a", None, 7),
        (1, "v1", "insert", "a", "en", 10), (None, "v1", "insert", None, None, 3), (None, "v1", "insert", None, None, 3),
        (None, "v1", "delete", None, None, 3), (9, "v1", "delete", "a", "en", 1),
    )
    assert ledger.commit("one", first) and not ledger.commit("one", first)
    assert totals() == {("a", "en", "v1"): (1, 10), ("a", None, "v1"): (1, 5), ("a", None, "v2"): (1, 7), (None, None, "v1"): (2, 6)}
    # A commit that stopped before its marker is written anew.
    first.limit(0).write.parquet(ledger._path("entries", "two/ *"))
    ledger.commit("two/ *", batch((1, "v1", "revise", "a", "en", 12), (2, "v1", "revise", "b", "de", 6), (2, "v2", "delete", None, None, None)))
    assert totals() == {("a", "en", "v1"): (1, 12), ("b", "de", "v1"): (1, 6), (None, None, "v1"): (2, 6)}
    ledger.commit("three", batch((1, "v1", "delete", None, None, None), (1, "v1", "delete", None, None, None), (77, "v1", "delete", None, None, None)))
    ledger.commit("four", batch((1, "v1", "insert", "c", "en", 4)))
    assert totals() == {("c", "en", "v1"): (1, 4), ("b", "de", "v1"): (1, 6), (None, None, "v1"): (2, 6)}
    assert {(r.doc_id, r.version, r.tokens) for r in ledger.counts().filter("doc_id IS NOT NULL").collect()} == {(1, "v1", 4), (2, "v1", 6)}
    ledger.commit("empty", batch().limit(0) if False else spark.createDataFrame([], schema))
    assert len(ledger.committed()) == 5


def test_token_totals_of_the_query(spark, folder):
    import base64

    import tiktoken

    def encoding(name):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path(name), "rb"))}
        return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    labels = {r.doc_id: r for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    want = collections.Counter()
    for name, foreign in (("byte_bpe_50k.tiktoken", False), ("byte_bpe_multi_50k.tiktoken", True)):
        coder = encoding(name)
        for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
            label = labels.get(r.doc_id)
            if label and label.toxic == 1 or foreign and r.lang == "en":
                continue
            text = r.text
            if label and label.quality == 0 and not foreign:
                text = re.sub(r"\s+", " ", text.strip(" "), flags=re.ASCII)
            key = (r.source, r.lang, name)
            want[(*key, "docs")] += 1
            want[(*key, "tokens")] += len(coder.encode_ordinary(text))
    got = collections.Counter()
    for r in registry.op3_token_counts(spark, folder).collect():
        got[r.source, r.lang, r.version, "docs"], got[r.source, r.lang, r.version, "tokens"] = r.n_docs, r.n_tokens
    assert got == want


@pytest.mark.parametrize("order, frequent", [(2, 1 << 20), (2, 20), (3, 1 << 20), (3, 30), (4, 10)])
def test_scores_follow_the_counts_of_the_others(spark, order, frequent):
    rng = random.Random(11)
    words = [sentence(rng, 1) for _ in range(12)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 40)))) for i in range(50)]
    rows += [(100, None), (101, "solo"), (102, "unseen zzz"), (103, rows[3][1]), (104, rows[5][1] + " " + rows[6][1])]
    path = public_tokenizers.path("word_bpe_49k.json")
    coder = Tokenizer.from_file(path)
    ids = {i: coder.encode(t or "", add_special_tokens=False).ids for i, t in rows}

    def grams(x):
        count, starts = collections.Counter(), collections.Counter()
        for k in range(1, order + 1):
            for i in range(len(x) - k + 1):
                count[tuple(x[i : i + k])] += 1
                starts[tuple(x[i : i + k - 1])] += 1
        return count, starts

    count, starts = collections.Counter(), collections.Counter()
    for x in ids.values():
        for total, part in zip((count, starts), grams(x), strict=True):
            total.update(part)
    tokens = sum(map(len, ids.values()))
    got = {r.doc_id: r for r in lm_scoring.score(docs(spark, rows), path, frequent, order).collect()}
    assert len(got) == len(rows)
    for i, x in ids.items():
        own, own_starts = grams(x)
        score, off = 0, 0
        for at in range(len(x)):
            size, steps = min(order, at + 1), 0
            while True:
                gram = tuple(x[at - size + 1 : at + 1])
                if size == 1:
                    ratio = max(count[gram] - own[gram], 0.5) / max(tokens - len(x), 1)
                    break
                if count[gram] > own[gram]:
                    ratio = (count[gram] - own[gram]) / (starts[gram[:-1]] - own_starts[gram[:-1]])
                    break
                size, steps = size - 1, steps + 1
            score += math.log(0.4**steps * ratio)
            off += steps
        assert (got[i].n_tokens, got[i].backed_off) == (len(x), off)
        assert got[i].log_score is None if not x else abs(got[i].log_score - score) < 1e-4
    assert lm_scoring.score(docs(spark, []), path).count() == 0


def test_scores_of_rows_without_an_id(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = [(None, "one two three"), (None, "two three four"), (1, "one two three"), (1, "five"), (2, "")]
    got = {r.doc_id: r for r in lm_scoring.score(docs(spark, rows), path).collect()}
    assert set(got) == {None, 1, 2} and got[None].n_tokens == 6 and got[1].n_tokens == 4
    assert got[2].log_score is None
    with pytest.raises(ValueError):
        lm_scoring.score(docs(spark, rows), path, order=5)


def test_the_score_query_takes_three_tokens(spark, tmp_path):
    rows = [(1, "one two three"), (2, "four two three"), (3, "one two")]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in registry.op6_lm_scores(spark, str(tmp_path)).collect()}
    # "three" after "one two" is in no other document, but it is after "two".
    assert (got[1].n_tokens, got[1].backed_off) == (3, 1)
    marks = [round(1e6 * math.log(x)) for x in (1 / 5, 1 / 1, 0.4 * 1 / 1)]
    assert got[1].log_score == pytest.approx(sum(marks) / 1e6)


def test_the_pipeline_keeps_clean_documents(spark, tmp_path):
    rng = random.Random(12)
    clean = [(i, sentence(rng, 60) + "\n" + sentence(rng, 40)) for i in range(30)]
    item = sentence(rng, 30)
    odd = [
        (100, "too short"),
        (101, None),
        (102, (sentence(rng, 6) + " ") * 12),
        (103, clean[0][1]),
        (104, clean[1][1].replace(clean[1][1].split()[5], "zz", 1)),
        (105, f"{sentence(rng, 40)} {item} {sentence(rng, 40)}"),
    ]
    frame = docs(spark, clean + odd).withColumnRenamed("n_chars", "n_chars")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == list(range(30))
    assert {r.doc_id: r.text for r in got} == dict(clean)
    from martkeeper.llm.sentence_pieces import Pieces

    own = Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    for r in got:
        ids, _ = own.encode([r.text])
        assert r.ids == ids.tolist() and r.n_tokens == len(ids) and r.n_chars == len(r.text)
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, frame.filter("doc_id < 0"), str(tmp_path))
        assert empty.count() == 0, name


@pytest.mark.parametrize("n", [300, 3000])
def test_variants_of_one_original_are_one_component(spark, n):
    rng = random.Random(18)
    base = sentence(rng, 90).split()
    texts = [" ".join(base)]
    for _ in range(n):
        words = list(base)
        for k in (rng.randrange(90), rng.randrange(90)):
            words[k] = sentence(rng, 1)
        texts.append(" ".join(words))
    rng.shuffle(texts)
    sets = [shingle_set(t, 4) for t in texts]
    hub = shingle_set(" ".join(base), 4)
    true = {i for i, s in enumerate(sets) if 100 * len(s & hub) >= 80 * len(s | hub)}
    assert len(true) > 0.9 * n
    got = near_dups.groups(docs(spark, list(enumerate(texts))).repartition(3), width=4).collect()
    component = {r.doc_id: r.component_id for r in got}
    assert len({component[i] for i in true}) == 1


def test_documents_shorter_than_an_item_are_one_window(spark):
    rng = random.Random(20)
    item = sentence(rng, 40).split()
    texts = [item[1:], item[:36], item[3:36], item[4:], item[2:-6], item[:33], item[:32], item[:20], item[:4], item, [*item[:38], "zz"]]
    want = {}
    own = {tuple(item[i : i + 5]) for i in range(36)}
    for i, words in enumerate(texts):
        rest = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        share = len(own & rest) / len(own | rest)
        if share >= 0.8:
            want[i] = round(share, 9), 0, len(words)
    assert {0, 1, 3, 9} <= set(want) and not {6, 7, 8} & set(want)
    rows = docs(spark, [(i, " ".join(t)) for i, t in enumerate(texts)])
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    got = {r.doc_id: (round(r.similarity, 9), r.start, r.n_words) for r in decontam.matches(rows, bench).collect()}
    assert got == want
    assert {r.doc_id for r in decontam.clean(rows, bench).collect()} == set(range(len(texts))) - set(want)


@pytest.mark.parametrize("partitions", [5, 90])
def test_a_region_in_many_tasks_has_one_set_of_central_nodes(spark, partitions):
    """Two originals with variants, each variant linked with its original only, and unrelated rows."""
    rng = random.Random(23)
    rows = []
    for _ in range(2):
        base = sentence(rng, 90).split()
        rows.append(" ".join(base))
        for _ in range(200):
            copy = list(base)
            for at in rng.sample(range(90), 2):
                copy[at] = sentence(rng, 1)
            rows.append(" ".join(copy))
    rows += [sentence(rng, 30) for _ in range(50)]
    order = list(range(len(rows)))
    rng.shuffle(order)
    texts = [(i, rows[k]) for i, k in enumerate(order)]
    want, _ = components(texts, 4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r.doc_id: r.component_id for r in near_dups.groups(docs(spark, texts), width=4).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [got[i] for i, _ in texts] == want


def test_rounds_of_central_nodes_find_every_family(spark):
    """Families and unrelated rows of one region: each family meets its centre."""
    rng = np.random.default_rng(3)
    rows = []
    for family in range(4):
        centre = rng.integers(0, 2**32, near_dups.VALUES)
        for k in range(40):
            own = centre.copy()
            changed = rng.choice(near_dups.VALUES, 12 if k else 0, replace=False)
            own[changed] = rng.integers(0, 2**32, len(changed))
            rows.append((0, b"abcd", own.astype(">u4").tobytes(), family * 100 + k))
    rows += [(0, b"abcd", rng.integers(0, 2**32, near_dups.VALUES).astype(">u4").tobytes(), 1000 + k) for k in range(5)]
    table = spark.createDataFrame(rows, "tree int, top binary, signature binary, node bigint")
    pairs = [(r.a, r.b) for p in near_dups._central_rounds(table) for r in p.collect()]
    assert all(a // 100 == b // 100 and a < 1000 for a, b in pairs)
    linked = {n for pair in pairs for n in pair}
    assert {family * 100 + k for family in range(4) for k in range(40)} <= linked
    assert len(pairs) <= len(rows)


def test_a_node_is_one_row_of_the_rounds_whatever_its_regions(spark, monkeypatch):
    rng = random.Random(37)
    base = sentence(rng, 90).split()
    texts = []
    for i in range(120):
        copy = list(base)
        copy[i % 90] = sentence(rng, 1)
        texts.append((i, " ".join(copy)))
    sizes = {"cut-rows": [], "met": []}
    write = near_dups.written

    def spied(df, name):
        table = write(df, name)
        if name in sizes:
            sizes[name].append(table.filter("node IS NOT NULL").count())
        return table

    monkeypatch.setattr(near_dups, "written", spied)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 60)
    try:
        got = {r.component_id for r in near_dups.groups(docs(spark, texts), width=4).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {0}
    assert sizes["cut-rows"] and sizes["met"] and max(sizes["cut-rows"] + sizes["met"]) <= len(texts)
