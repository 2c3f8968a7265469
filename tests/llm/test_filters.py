"""URL rules, quality rules, line dedup and language identification on small tables."""

import pathlib
import random
import re

import pyarrow as pa
import pytest

from martkeeper.llm import language_id, line_dedup, quality_rules, url_rules

RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es", "block"), ("net", "/es/x/", "allow"), ("org", "", "block"), ("org", "", "allow"), ("", "/bad/", "block"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, LINES string"


def docs(spark, rows):
    full = [(i, t, "en", s, len(t or ""), "x") for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def plain_verdict(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest).group()
    path = re.match("[^?#]*", rest[len(host):]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        r for r in RULES
        if (r[0] == "" or host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])
    ]
    if not fits:
        return host, path, None, "allow"
    best = max(fits, key=lambda r: (len(r[0].split(".")) if r[0] else 0, len(r[1]), r[2]))
    return host, path, best[0] + best[1], best[2]


@pytest.mark.parametrize("limit", [100, 0])
def test_the_longest_rule_decides(spark, monkeypatch, limit):
    monkeypatch.setattr(url_rules, "TRIE_RULES", limit)
    rng = random.Random(2)
    urls = [None, "", "no-scheme", "http://", "http://COM", "x://a.com?q", "x://a.net#/es", "x://É.com/", "a://b://c.com/"]
    for _ in range(300):
        host = ".".join(rng.choice(["www", "example", "com", "net", "org", "a", ""]) for _ in range(rng.randrange(1, 4)))
        path = "".join(rng.choice(["/", "en", "es", "x", "/", "bad", "english"]) for _ in range(rng.randrange(0, 6)))
        urls.append(f"http://{host}{path}" + rng.choice(["", "?q=/en/", "#t"]))
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(0, None, "h")], "page_id bigint, url string, Host string")
    got = url_rules.judge_urls(pages.drop("Host"), RULES).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == plain_verdict(urls[r.page_id])


def test_boilerplate_and_depleted_documents(spark):
    rng = random.Random(3)
    common = "This Line Stands on every page of the host"
    rows = []
    for i in range(60):
        body = " ".join(str(rng.random()) for _ in range(14))
        rows.append((i, f"{common}\n{body}", "a" if i < 40 else None))
    rows += [(90, f"{common}\nfew", "a"), (91, None, "a"), (92, "", "a"), (None, common.upper() + "\n" + "w " * 4, "a")]
    rows += [(93, f"{common} once\n" + " ".join(map(str, range(12))), "b")] * 30
    judged = {(r.doc_id): r for r in quality_rules.judge(docs(spark, rows)).collect()}
    assert len(quality_rules.judge(docs(spark, rows)).collect()) == len(rows)
    assert judged[0].removed_lines == [0] and judged[0].kept and judged[0].words_left == 14
    assert judged[50].removed_lines == []  # twenty documents are not above the limit
    assert not judged[90].base_failed and not judged[90].kept
    assert judged[91].n_words == 0 and judged[91].base_failed and not judged[92].kept
    assert judged[93].kept and judged[93].removed_lines == []  # copies are one text
    assert not judged[None].kept
    cleaned = quality_rules.clean(docs(spark, rows))
    assert cleaned.columns == docs(spark, rows).columns
    texts = {r.doc_id: r for r in cleaned.collect()}
    assert common not in texts[0].text and texts[0].n_chars == len(texts[0].text)
    assert cleaned.filter("doc_id = 93").count() == 30 and 90 not in texts
    assert quality_rules.clean(docs(spark, [])).count() == 0


def _near(a, b, percent=10):
    limit = max(len(a), len(b)) * percent // 100
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y)))
    return row[-1] <= limit


def test_alike_lines_stay_once(spark):
    rng = random.Random(4)
    def words(n):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    base = words(40)
    variants = [base] + [base[: 5 * k] + "z" + base[5 * k + 1 :] for k in range(1, 30)]
    rows = [(i, f"{words(12)}\nshort line\n{v}", "s") for i, v in enumerate(variants)]
    rows += [(100, f"{base.upper()}\n{base}", "s"), (101, base, "s"), (101, base, "s"), (None, base, "s"), (102, None, "s"), (103, "", "s")]
    frame = docs(spark, rows)
    left = line_dedup.deduped(frame).collect()
    assert len(left) == len(rows)
    by_id = {r.doc_id: r for r in left}
    assert by_id[0].removed_lines == [] and by_id[100].removed_lines == [0, 1] and by_id[100].text == ""
    # A letter changes up to five windows, which flips a few bits of the hash.
    gone = [i for i in range(1, 30) if by_id[i].removed_lines == [2]]
    assert len(gone) >= 24 and all(by_id[i].text.endswith("short line") for i in gone)
    assert by_id[None].text == base and by_id[102].text is None and by_id[103].text == ""
    assert by_id[101].removed_lines == [0]
    ids = {r.doc_id for r in line_dedup.clean(frame).collect()}
    assert 101 not in ids and 100 not in ids and {0, 102, 103, None} <= ids
    assert line_dedup.clean(docs(spark, [])).count() == 0


def test_every_alike_pair_within_the_radius_is_found(spark):
    rng = random.Random(5)
    lines = ["".join(rng.choice("abcde fgh") for _ in range(70)).strip() + "xy" for _ in range(40)]
    for line in lines[:25]:
        for _ in range(3):
            k = rng.randrange(10, 60)
            lines.append(line[:k] + rng.choice("klm") + line[k + 1:])
    rows = [(i, t, "s") for i, t in enumerate(lines)]
    data, offsets, _, _ = line_dedup.normalized(pa.array(lines))
    hashes = line_dedup.simhash(data, offsets).tolist()
    norm = [data.tobytes()[a:b].decode() for a, b in zip(offsets, offsets[1:], strict=False)]
    group = list(range(len(lines)))
    for i in range(len(lines)):
        for j in range(i):
            if (hashes[i] ^ hashes[j]).bit_count() <= line_dedup.RADIUS and _near(norm[i], norm[j]):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    must = {i for i, g in enumerate(group) if g != i}
    gone = {r.doc_id for r in line_dedup.deduped(docs(spark, rows)).collect() if r.removed_lines}
    assert must and must <= gone
    for i in gone:  # what goes is alike to a line that precedes it in its group
        assert any(_near(norm[i], norm[j], 20) for j in range(len(lines)) if j != i)


def test_edit_distance_within_a_limit():
    rng = random.Random(6)
    for _ in range(1500):
        x = "".join(rng.choice("abé日") for _ in range(rng.randrange(0, 14)))
        y = list(x)
        for _ in range(rng.randrange(0, 6)):
            k = rng.randrange(len(y) + 1)
            y[k : k + rng.randrange(0, 3)] = rng.choice(["", "a", "bb", "é"])
        y = "".join(y)
        row = list(range(len(y) + 1))
        for i, a in enumerate(x, 1):
            row, old = [i], row
            for j, b in enumerate(y, 1):
                row.append(min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (a != b)))
        for limit in (0, 1, 2, 3, 5, 20):
            assert line_dedup.within(x, y, limit) == (row[-1] <= limit), (x, y, limit)


def test_simhash_counts_bits_of_windows():
    from martkeeper.llm import textbytes

    lines = ["abcdefgh" * 4, "x" * 31, "the quick brown fox jumps over it", "y" * 70_000 + "abc" * 9]
    data, offsets, _, _ = line_dedup.normalized(pa.array(lines))
    for value, line in zip(line_dedup.simhash(data, offsets).tolist(), lines, strict=True):
        raw = line.encode()
        grams = [int.from_bytes(raw[i : i + 5], "little") for i in range(len(raw) - 4)]
        hashes = textbytes.mix(__import__("numpy").array(grams, "u8")).tolist()
        assert value == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_languages_of_held_out_texts(spark, folder):
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    extra = spark.createDataFrame([(10**9, None, None), (None, "12 34", "xx"), (10**9 + 1, "²", "en")], "doc_id bigint, text string, lang string")
    rows = frame.select("doc_id", "text", "lang").union(extra)
    got = language_id.identify(rows).collect()
    assert len(got) == rows.count()
    assert {r.lang_pred for r in got if r.doc_id is None or r.doc_id >= 10**9} == {"und"}
    truth = {r.doc_id: r.lang for r in frame.collect()}
    tested = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.lang_pred == truth[r.doc_id] for r in tested) >= 0.9 * len(tested)
    assert all(0 <= r.score <= 1 for r in got)
    none = language_id.identify(rows.filter("doc_id < 0")).collect()
    assert none == []


def _edited(rng, line, edits):
    """The line with so many letters replaced, at random places."""
    out = list(line)
    for k in rng.sample(range(len(line)), edits):
        out[k] = rng.choice([c for c in "klmnopq" if c != out[k]])
    return "".join(out)


def _random_line(rng, n):
    return "".join(rng.choice("abcdefghij") for _ in range(n))


@pytest.mark.parametrize(("length", "edits", "recall"), [(30, 3, 0.98), (60, 1, 1), (60, 6, 0.98), (100, 10, 0.98), (130, 13, 0.98), (200, 20, 0.98), (300, 30, 0.98), (600, 60, 0.98)])
def test_alike_lines_share_a_key(length, edits, recall):
    rng = random.Random(length + edits)
    first = [_random_line(rng, length) for _ in range(1000)]
    keys = []
    for lines in (first, [_edited(rng, line, edits) for line in first]):
        data, offsets, _, _ = line_dedup.normalized(pa.array(lines))
        bounds, values = line_dedup.sketch(data, offsets)
        keys.append([set(values[a:b].tolist()) for a, b in zip(bounds, bounds[1:], strict=False)])
    met = sum(bool(a & b) for a, b in zip(*keys, strict=True)) / 1000
    assert met >= recall


def test_alike_pairs_beyond_the_radius_are_found(spark):
    rng = random.Random(16)
    first = [_random_line(rng, n) for n in (60, 100, 200) for _ in range(60)]
    second = [_edited(rng, line, len(line) // 10) for line in first]
    rows = [(i, t, "s") for i, t in enumerate(first + second)]
    alike = {  # by edit distance over all pairs
        (i, j) for i, x, _ in rows for j, y, _ in rows[:i] if line_dedup.within(x, y, max(len(x), len(y)) * 10 // 100)
    }
    assert alike == {(i + 180, i) for i in range(180)}
    gone = {r.doc_id for r in line_dedup.deduped(docs(spark, rows)).collect() if r.removed_lines}
    assert gone <= {i for i, _ in alike} and len(gone) >= 0.97 * len(alike)


def test_a_full_bucket_is_split_and_not_paired(spark, monkeypatch):
    rng = random.Random(15)
    def word(n):
        return "".join(rng.choice("abcdefghij") for _ in range(n))
    passage = word(80)
    lines = [f"{passage} {word(120)}" for _ in range(300)]
    copies = [_edited(rng, line, 2) for line in lines[:40]]
    rows = [(i, t, "s") for i, t in enumerate(lines + copies)]
    compared = []
    alike = line_dedup.similar
    monkeypatch.setattr(line_dedup, "similar", lambda pairs, *a: compared.append(pairs.count()) or alike(pairs, *a))
    gone = {r.doc_id for r in line_dedup.deduped(docs(spark, rows)).collect() if r.removed_lines}
    assert gone == set(range(300, 340))
    assert sum(compared) < 340 * 339 // 8


def test_short_lines_stay_once_in_query_and_pipeline(spark, tmp_path):
    import corpus_pipeline
    from martkeeper.llm import registry

    rng = random.Random(17)
    rows = [(i, f"Next  page\n\n日本 7\n{_random_line(rng, 80)}", "s") for i in range(3)] + [(3, "next page", "s"), (4, "next pages", "s")]
    frame = docs(spark, rows)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.removed_lines for r in registry.op5_line_dedup(spark, str(tmp_path)).collect()}
    assert got == {0: [], 1: [0, 2], 2: [0, 2], 3: [0], 4: []}
    assert {r.doc_id for r in corpus_pipeline.lines(spark, frame, "").collect()} == {0, 1, 2, 4}


def test_the_pipeline_removes_frequent_lines_of_a_large_host(spark):
    import corpus_pipeline

    rng = random.Random(19)
    text = lambda: " ".join(_random_line(rng, 6) for _ in range(20))
    rows = [(i, ("Share this page with us\n" if i < 22 else "Seen in a few\n" if i < 42 else "") + text(), "big") for i in range(600)]
    left = {r.doc_id: r.text for r in corpus_pipeline.quality(spark, docs(spark, rows), "").collect()}
    assert len(left) == 600 and not any("Share" in t for t in left.values())
    assert sum("Seen" in t for t in left.values()) == 20  # not above the limit


def test_a_language_with_long_texts_only_is_learned(spark):
    rows = [(1, "ab cd " * 1000, "x"), (2, "ef gh " * 900, "x"), (3, "ij kl", "y"), (4, "mn " * 2000, "y"), (5, "", "z")]
    learned = language_id.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert set(learned) == {"x", "y"} and learned["y"] == b" ij kl " and 3_900 < len(learned["x"]) <= 4_002


@pytest.mark.parametrize("tile", [4096, 16])
def test_alike_lines_that_share_only_a_full_bucket_meet(spark, monkeypatch, tile):
    monkeypatch.setattr(line_dedup, "TILE", tile, raising=False)
    rng = random.Random(23)
    passage = _random_line(rng, 60)
    lines = [f"{passage} {_random_line(rng, 139)}" for _ in range(100)]
    copies = []
    for line in lines[:30]:  # no window of 14 letters behind the passage stays whole
        out = list(line)
        for k in range(61, 200, 12):
            out[k] = rng.choice("klmnopq")
        copies.append("".join(out))
    data, offsets, _, _ = line_dedup.normalized(pa.array(lines + copies))
    bounds, keys = line_dedup.sketch(data, offsets)
    sets = [set(keys[a:b].tolist()) for a, b in zip(bounds, bounds[1:], strict=False)]
    common = {k for k in set().union(*sets) if sum(k in s for s in sets) > 16}
    shared = [sets[i] & sets[100 + i] for i in range(30)]
    assert all(shared) and all(s <= common for s in shared)
    rows = [(i, t, "s") for i, t in enumerate(lines + copies)]
    gone = {r.doc_id for r in line_dedup.deduped(docs(spark, rows)).collect() if r.removed_lines}
    assert gone == set(range(100, 130))


def test_counts_never_part_alike_lines():
    import numpy as np

    rng = random.Random(24)
    lines = ["".join(rng.choice("abcdeé日本語😀 ") for _ in range(n)).strip() for n in range(30, 330, 3)]
    copies = []
    for line in lines:
        out = list(line)
        for _ in range(len(line) // 10):
            k = rng.randrange(len(out))
            out[k : k + 1] = rng.choice([[], ["x"], [out[k], "ß"]])
        copies.append("".join(out))
    limits = [max(len(x), len(y)) // 10 for x, y in zip(lines, copies, strict=True)]
    full = []
    for texts in (lines, copies):
        data, offsets = line_dedup.tb.buffers(pa.array(texts))
        letters, chars = line_dedup.letter_counts(data, offsets)
        assert chars.tolist() == [len(t) for t in texts]
        full.append(np.concatenate([letters, line_dedup.pair_counts(data, offsets)], 1))
    both = np.concatenate(full)
    x = np.arange(len(lines))
    assert line_dedup.not_apart(both, x, x + len(lines), np.array(limits)).all()
    assert not line_dedup.not_apart(both, x[:-20], x[:-20] + 20, np.array(limits[:-20])).any()
    assert all(line_dedup.not_apart_in_runs(lines, copies, limits))
    assert not any(line_dedup.not_apart_in_runs(lines[:-20], lines[20:], limits[:-20]))


def test_a_written_table_leaves_no_shuffle_files(spark):
    import time

    from martkeeper.llm.common import RELEASE_KEY, written

    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(k).getName() for k in range(found.size()) if found.apply(k).getName().startswith("shuffle_")}

    before = files()
    rows = written(spark.range(20_000).repartition(4).groupBy("id").count(), "counts")
    until = time.time() + 20
    while files() - before and time.time() < until:  # they go in the background
        time.sleep(0.2)
    assert not files() - before and rows.count() == 20_000
    assert spark.conf.get(RELEASE_KEY) == "false"


def test_only_lines_with_pairs_left_meet_again(spark, monkeypatch):
    """Two alike lines have no pair left; of five in one bucket the outer ones have."""
    again = []
    pairs_of = line_dedup.bucket_pairs

    def spied(members, edit, every=False):
        if every:
            again.extend(r.line for r in members.select("line").distinct().collect())
        return pairs_of(members, edit, every)

    monkeypatch.setattr(line_dedup, "bucket_pairs", spied)
    rng = random.Random(29)
    twos = [_random_line(rng, 200) for _ in range(20)]
    rows = [(i, t, "s") for i, t in enumerate(twos + [_edited(rng, t, 3) for t in twos])]
    gone = {r.doc_id for r in line_dedup.deduped(docs(spark, rows)).collect() if r.removed_lines}
    assert gone == set(range(20, 40)) and not again
    five = [twos[0], *(_edited(rng, twos[0], 2) for _ in range(4))]
    gone = {r.doc_id for r in line_dedup.deduped(docs(spark, [(i, t, "s") for i, t in enumerate(five)])).collect() if r.removed_lines}
    assert gone == {1, 2, 3, 4} and len(set(again)) == 5


@pytest.mark.parametrize("rounds", [1, 5])
def test_rounds_give_the_buckets_of_all_keys(spark, rounds):
    rng = random.Random(31)
    first = [_random_line(rng, 90) for _ in range(30)]
    rows = docs(spark, [(i, t, "s") for i, t in enumerate(first + [_edited(rng, t, 4) for t in first])])
    lines = line_dedup.written(line_dedup.line_sketch(rows), "lines")
    want = {(r.key, r.line) for r in line_dedup.buckets(lines).collect()}
    got = [(r.key, r.line) for k in range(rounds) for r in line_dedup.buckets(lines, 10, k, rounds).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 60


def test_windows_at_other_places_are_no_common_key(spark):
    rng = random.Random(37)
    passage = _random_line(rng, 60)
    rows = [(i, t, "s") for i, t in enumerate([passage + _random_line(rng, 140), _random_line(rng, 140) + passage])]
    assert line_dedup.buckets(line_dedup.line_sketch(docs(spark, rows))).count() == 0


def test_lines_with_a_fitting_one_stay_in_their_bucket():
    import numpy as np

    rng = np.random.default_rng(41)
    keys, chars = rng.integers(0, 3, 900), rng.integers(30, 900, 900)
    places = np.where(rng.random(900) < 0.01, line_dedup.ANY, rng.integers(0, chars))
    size = np.sort(keys.astype(np.uint64) << np.uint64(32) | chars.astype(np.uint64))
    keys, chars = (size >> np.uint64(32)).astype(int), (size & np.uint64(2**32 - 1)).astype(int)
    for edit in (0, 10, 30):
        x, y = np.triu_indices(900, 1)
        limit = chars[y] * edit // 100
        fits = (keys[x] == keys[y]) & (chars[y] - chars[x] <= limit)
        fits &= line_dedup.at_places(places[x], places[y], chars[x], chars[y], limit)
        got = line_dedup._fitting(size, places, edit)
        assert got[x[fits]].all() and got[y[fits]].all()
        assert edit != 10 or not line_dedup._fitting(size[:300:9], places[:300:9], edit).all()


def test_a_pair_with_many_common_keys_is_looked_at_once(spark, monkeypatch):
    seen = []
    pairs_of = line_dedup.bucket_pairs

    def spied(*args, **more):
        pairs = pairs_of(*args, **more)
        seen.extend((r.a, r.b) for r in pairs.collect())
        return pairs

    monkeypatch.setattr(line_dedup, "bucket_pairs", spied)
    rng = random.Random(43)
    passage = _random_line(rng, 300)
    rows = [(i, passage + _random_line(rng, 55), "s") for i in range(24)]  # 11 to 15 % apart
    rows += [(24 + i, _edited(rng, t, 3), "s") for i, t, _ in rows[:6]]
    alike = {(j, i) for i, x, _ in rows for j, y, _ in rows[:i] if line_dedup.within(x, y, 35)}
    group = {i: i for i, *_ in rows}
    for _ in rows:
        for j, i in alike:
            group[i] = group[j] = min(group[i], group[j])
    gone = {r.doc_id for r in line_dedup.deduped(docs(spark, rows)).collect() if r.removed_lines}
    assert gone == {i for i in group if group[i] != i} and len(gone) >= 6
    assert len(seen) > 20 and len(seen) == len(set(seen))


def test_many_pairs_within_their_limits():
    rng = random.Random(47)
    x, y, limits = [], [], []
    for size in [30] * 900 + [400] * 60 + [5_000] * 2:
        line = [rng.choice("abé日 ") for _ in range(rng.randrange(size))]
        other = list(line)
        for _ in range(rng.randrange(0, 1 + size // 8)):
            k = rng.randrange(len(other) + 1)
            other[k : k + rng.randrange(0, 3)] = rng.choice(["", "a", "bb", "😀"])
        x.append("".join(line))
        y.append("".join(other))
        limits.append(rng.choice([0, 1, 2, 5, size // 10, size // 6]))
    want = [line_dedup.within(*pair) for pair in zip(x, y, limits, strict=True)]
    assert line_dedup.within_all(x, y, limits) == want and 100 < sum(want) < 860
    assert line_dedup.within_all([], [], []) == []


def test_lines_meet_the_middle_of_their_group_first(spark, monkeypatch):
    """Forty lines of equal length, alike to one line only, the nearest to most by SimHash: few pairs are left for later."""
    late = []
    pairs_of = line_dedup.bucket_pairs

    def spied(*args, **more):
        pairs = pairs_of(*args, **more)
        late.append(pairs.count())
        return pairs

    monkeypatch.setattr(line_dedup, "bucket_pairs", spied)
    rng = random.Random(53)
    middle = _random_line(rng, 300)
    lines = [_edited(rng, middle, 24) for _ in range(40)] + [middle]
    assert not any(line_dedup.within(x, y, 30) for x in lines[:40] for y in lines[:40] if x != y)
    gone = {r.doc_id for r in line_dedup.deduped(docs(spark, [(i, t, "s") for i, t in enumerate(lines)])).collect() if r.removed_lines}
    assert gone == set(range(1, 41)) and sum(late) < 820 // 2


def test_texts_are_sent_for_pairs_that_letters_leave(spark, monkeypatch):
    """Long lines that share a passage and are of other letters else are told apart without their texts; the table of
    keys goes when all keys have met."""
    rng = random.Random(59)
    passage, letters = _random_line(rng, 120), "abcdefghijklmnopqrst"
    lines = [passage + " " + "".join(rng.choice(letters[i : i + 2]) for _ in range(150)) for i in range(0, 20, 2)]
    rows = [(i, t, "s") for i, t in enumerate(lines + [_edited(rng, lines[3], 4)])]
    compared = []
    alike = line_dedup.similar
    monkeypatch.setattr(line_dedup, "similar", lambda pairs, *a: compared.append(pairs.count()) or alike(pairs, *a))
    root = pathlib.Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(root.iterdir()) if root.exists() else set()
    gone = {r.doc_id for r in line_dedup.deduped(docs(spark, rows)).collect() if r.removed_lines}
    new = {f.name.split("-")[0] for f in set(root.iterdir()) - before}
    assert gone == {10} and sum(compared) == 1
    assert "near" in new and "lines" not in new
