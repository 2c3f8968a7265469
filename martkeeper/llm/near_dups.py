"""Near-duplicate documents with an LSH forest over MinHash signatures.

A document is the set of its distinct shingles. Documents with one set are one node. Every node is
put into ``TREES`` orders, each sorted by another rotation of its signature; a node's candidates are
its neighbours there, as the neighbours share the longest prefix. The depth adapts: a region whose
first value no other node shares ends there and isn't sorted at all, a dense one is told apart by as
many values as it takes. A region with more nodes than the neighbours reach is also compared with its
most central node, then what doesn't agree with that one with the next, until one agrees with nobody:
so the variants of a common original meet it, however many there are. A candidate must agree in ``AGREE`` of its signature's values, which a pair
at the threshold misses with a probability below 1e-4; it is linked if the full sets confirm it.

Candidates from a few orders are confirmed first; of the others only those that would connect two
groups. So a group of many copies costs a few confirmations per copy, and no pair of all copies is
formed. Sorting deals equal prefixes over tasks by range. The rows at the ends of tasks are compared in
a second step, and a region that lies in several tasks gets central nodes for all of its rows: each round finds
one per region, by its agreement with a sample of the region, and takes off the rows that agree with it, until
the region has found nothing in ``PATIENCE`` rounds. So its result doesn't depend on the number of tasks.

A document without words is linked with nothing, as is a row without an id, whose component is NULL;
both are kept. Rows that repeat an id are one document if their words agree, and are linked else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkeeper.llm import textbytes as tb
from martkeeper.llm.common import connected, quoted, small, unused, written

VALUES = 64
TREES = 32
STEP = VALUES // TREES
REACH = 6
AGREE = 38
FIRST_TREES = 3
SAMPLE = 24
HELD = 1 << 17
PATIENCE = 2
SIMILARITY = 80

U64 = np.uint64


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text, A-Z in lower case."""
    data, offsets = tb.buffers(column)
    starts, ends, rows = tb.spans(data, offsets)
    words = tb.span_hashes(data, starts, ends, True)
    counts = np.bincount(rows, minlength=len(column))
    hashes, first = tb.window_hashes(words, rows, width)
    cuts = np.searchsorted(rows[first], np.arange(len(column) + 1))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    short = np.flatnonzero((counts > 0) & (counts < width))
    whole = tb.sequence_hashes(words, bounds[short], bounds[short + 1])
    sets = [np.unique(hashes[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
    for row, value in zip(short, whole, strict=True):
        sets[row] = np.array([value])
    return sets


def node_of(items: np.ndarray) -> int:
    """A 64-bit name of a set."""
    return int(tb.sequence_hashes(items, np.array([0]), np.array([len(items)])).view(np.int64)[0])


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The smallest value of each hash function over each set (none empty), as 32-bit words."""
    rng = np.random.default_rng(7)
    factors = rng.integers(0, 2**63, VALUES, dtype=U64) * U64(2) + U64(1)
    addends = rng.integers(0, 2**64, VALUES, dtype=U64)
    items = np.concatenate(sets)
    starts = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    out = np.empty((len(sets), VALUES), np.uint32)
    for k in range(VALUES):
        out[:, k] = np.minimum.reduceat(items * factors[k] + addends[k], starts) >> U64(32)
    return out


SKETCH = "doc_id bigint, n_shingles bigint, node bigint, signature binary"


def sketch(documents: DataFrame, width: int) -> DataFrame:
    """Size, name and signature of each document's set; the latter NULL for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.sliced(batches):
            sets = shingle_sets(batch.column("text"), width)
            full = [s for s in sets if len(s)]
            rows = iter(signatures(full).astype(">u4")) if full else iter(())
            named = [(node_of(s), next(rows).tobytes()) if len(s) else (None, None) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([n for n, _ in named], pa.int64()),
                    pa.array([s for _, s in named], pa.binary()),
                ],
                ["doc_id", "n_shingles", "node", "signature"],
            )

    return _rows(documents).mapInArrow(run, SKETCH)


def _rows(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


def _rotated(tree: Column) -> Column:
    """The signature from a tree's first value on, and round."""
    at = tree * (4 * STEP)
    return F.concat(
        F.substring("signature", at + 1, F.lit(4 * VALUES)), F.substring("signature", F.lit(1), at)
    )


PAIRS = "a bigint, b bigint, early boolean, tree int, signature binary, node bigint, task int"


def candidates(nodes: DataFrame) -> DataFrame:
    """Pairs of neighbours (a, b, early) over the written ``nodes`` (node, signature)."""
    trees = F.sequence(F.lit(0), F.lit(TREES - 1))
    places = nodes.select("node", "signature", F.explode(trees).alias("tree"))
    places = places.select("node", "tree", F.substring(_rotated(F.col("tree")), 1, 4).alias("top"))
    shared = written(
        places.groupBy("tree", "top").agg(F.count("*").alias("n")).filter("n > 1"), "regions"
    )
    dense = written(
        places.join(shared, REGION, "left_semi").groupBy("node").agg(F.collect_list("tree").alias("trees")),
        "dense",
    )
    rows = (
        nodes.join(dense, "node")
        .select("node", "signature", F.explode("trees").alias("tree"))
        .select("tree", _rotated(F.col("tree")).alias("signature"), "node")
    )
    partitions = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["tree", "signature", "node"]
    dealt = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    found = written(dealt.mapInArrow(_neighbours, PAIRS), "neighbours")
    # A few rows of each task: its first ones and its last ones.
    at_ends = found.filter("node IS NOT NULL")
    ends = at_ends.select("tree", "signature", "node").distinct()
    joints = ends.repartition(1).sortWithinPartitions(*order).mapInArrow(_neighbours, PAIRS)
    pairs = found.select("a", "b", "early").union(joints.select("a", "b", "early"))
    # A task begins and ends with one region each, so these are at most twice as many as tasks.
    top = F.substring("signature", 1, 4).alias("top")
    regions = at_ends.select("tree", top, "task").distinct().groupBy("tree", "top").agg(F.count("*").alias("n"))
    # Neighbours reach all rows of a small region, also over the ends of tasks.
    large = shared.filter(F.col("n") > REACH + 1)
    regions = regions.filter("n > 1").join(large, REGION, "left_semi").select(*REGION).collect()
    if regions:
        inside = _in_regions(nodes.join(dense, "node"), {(r.tree, bytes(r.top)) for r in regions})
        for more in _rounds(written(inside, "cut-rows")):
            pairs = pairs.union(more)
    return pairs.filter("a IS NOT NULL").groupBy("a", "b").agg(F.max("early").alias("early"))


REGION = ["tree", "top"]


def _values(column: pa.Array) -> np.ndarray:
    raw = column.cast(pa.binary(4 * VALUES))
    values = np.frombuffer(raw.buffers()[1], ">u4").reshape(-1, VALUES)
    return values[raw.offset : raw.offset + len(raw)]


AT = pa.list_(pa.struct([("tree", pa.int32()), ("top", pa.binary())]))
IN_REGIONS = "node bigint, signature binary, regions array<struct<tree: int, top: binary>>"


def _in_regions(nodes: DataFrame, cut: set[tuple[int, bytes]]) -> DataFrame:
    """(node, signature, regions): of the nodes with their ``trees`` those in some of the regions ``cut``."""
    cut = nodes.sparkSession.sparkContext.broadcast(cut)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("signature").to_pylist(), batch.column("trees").to_pylist(), strict=True)
            tops = [[(t, s[4 * STEP * t : 4 * STEP * t + 4]) for t in trees] for s, trees in rows]
            own = pa.array([[r for r in regions if r in cut.value] for regions in tops], AT)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("signature"), own], ["node", "signature", "regions"]
            ).filter(pa.array([len(r) > 0 for r in own]))

    return nodes.select("node", "signature", "trees").mapInArrow(run, IN_REGIONS)


def _regions(batch: pa.RecordBatch, open_: dict | None) -> Iterator[tuple[tuple[int, bytes], np.ndarray]]:
    """(region, rows) of a batch, of the regions in ``open_`` if given; a region is a tree and the first value there."""
    column = batch.column("regions")
    row = np.repeat(np.arange(batch.num_rows), np.diff(column.offsets.to_numpy()))
    flat = column.flatten()
    top = flat.field("top").dictionary_encode()
    tops = top.dictionary.to_pylist()
    codes = flat.field("tree").to_numpy().astype(np.int64) << 32 | top.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    codes, first = np.unique(codes[order], return_index=True)
    for code, at in zip(codes.tolist(), np.split(row[order], first[1:]), strict=False):
        region = code >> 32, tops[code & 2**32 - 1]
        if open_ is None or region in open_:
            yield region, at


def _central_rounds(rows: DataFrame) -> Iterator[DataFrame]:
    """Pairs (a, b, early) of the rows (tree, top, signature, node) with their regions' central nodes."""
    turned = F.lit(4 * VALUES) - F.col("tree") * (4 * STEP)
    signature = F.concat(
        F.substring("signature", turned + 1, F.lit(4 * VALUES)), F.substring("signature", F.lit(1), turned)
    )
    regions = F.collect_list(F.struct("tree", "top")).alias("regions")
    return _rounds(rows.groupBy("node").agg(F.first(signature).alias("signature"), regions))


def _rounds(nodes: DataFrame) -> Iterator[DataFrame]:
    """The same of nodes (node, signature, regions). What a region is compared with, and what its nodes have
    found, is put together in a task first, so a node is a row whatever the number of its regions."""

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of a batch that may be in a region's sample."""
        for batch in batches:
            node = batch.column("node").to_numpy()
            place = tb.mix(node.view(U64)).view(np.int64)
            rank = np.lexsort((node, place))
            rank[rank.copy()] = np.arange(len(rank))
            signature = batch.column("signature")
            for (tree, top), at in _regions(batch, open_.value):
                at = at[np.argsort(rank[at])][:SAMPLE]
                yield _of_region(tree, top, place=place[at], node=node[at], signature=signature.take(pa.array(at)))

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The row of a batch that has most values in common with its region's sample, by region."""
        for batch in batches:
            values, node = _values(batch.column("signature")), batch.column("node").to_numpy()
            for (tree, top), at in _regions(batch, samples.value):
                marks = [np.frombuffer(x, ">u4") for x in samples.value[tree, top]]
                total = sum((values[at] == mark).sum(1) for mark in marks)
                best = np.lexsort((node[at], total))[-1:]
                signature = batch.column("signature").take(pa.array(at[best]))
                yield _of_region(tree, top, score=total[best], node=node[at[best]], signature=signature)

    def agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The nodes with the central nodes that they agree with and the regions where they don't; behind them,
        with no ``node``, the regions where some did."""
        for batch in batches:
            values, node = _values(batch.column("signature")), batch.column("node").to_numpy()
            left, met, found = [[] for _ in node], [{} for _ in node], []
            for region, at in _regions(batch, marks.value):
                pivot, mark = marks.value[region]
                same = (values[at] == np.frombuffer(mark, ">u4")).sum(1) >= AGREE
                for k in at[~same].tolist():
                    left[k].append(region)
                others = at[same & (node[at] != pivot)].tolist()
                for k in others:
                    met[k][pivot] = met[k].get(pivot, False) or region[0] < FIRST_TREES
                found += [region] if others else []
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*node.tolist(), *([None] if found else [])], pa.int64()),
                    pa.array([*batch.column("signature").to_pylist(), *([None] if found else [])], pa.binary()),
                    pa.array([*left, *([found] if found else [])], AT),
                    pa.array([*(list(m.items()) for m in met), *([[]] if found else [])], MET),
                ],
                ["node", "signature", "regions", "met"],
            )

    context = nodes.sparkSession.sparkContext
    region = "tree int, top binary"
    misses: dict | None = None
    while True:
        open_ = context.broadcast(misses)
        few = nodes.mapInArrow(firsts, f"{region}, place bigint, node bigint, signature binary")
        place = F.row_number().over(Window.partitionBy(*REGION).orderBy("place", "node"))
        few = few.withColumn("at", place).filter(F.col("at") <= SAMPLE)
        sample = few.groupBy(*REGION).agg(F.collect_list("signature").alias("sample")).collect()
        if not sample:
            return
        # What a region is compared with is a few kilobytes, and regions are at most twice as many as tasks.
        samples = context.broadcast({(r.tree, bytes(r.top)): [bytes(x) for x in r.sample] for r in sample})
        scored = nodes.mapInArrow(scores, f"{region}, score bigint, node bigint, signature binary")
        best = F.max_by(F.struct("node", "signature"), F.struct("score", "node")).alias("best")
        pivots = scored.groupBy(*REGION).agg(best).collect()
        marks = context.broadcast({(r.tree, bytes(r.top)): (r.best.node, bytes(r.best.signature)) for r in pivots})
        met = written(nodes.mapInArrow(agreeing, f"{IN_REGIONS}, met array<struct<pivot: bigint, early: boolean>>"), "met")
        found = met.filter("node IS NULL").select(F.explode("regions").alias("r")).select("r.*").distinct().collect()
        found = {(r.tree, bytes(r.top)) for r in found}
        if found:
            each = met.filter("node IS NOT NULL").select("node", F.explode("met").alias("m"))
            yield each.select(
                F.least("node", "m.pivot").alias("a"), F.greatest("node", "m.pivot").alias("b"), "m.early"
            )
        before = misses or {}
        misses = {r: 0 if r in found else before.get(r, 0) + 1 for r in marks.value}
        misses = {r: n for r, n in misses.items() if n < PATIENCE}
        nodes = met.filter("node IS NOT NULL AND size(regions) > 0").drop("met")


MET = pa.list_(pa.struct([("pivot", pa.int64()), ("early", pa.bool_())]))


def _of_region(tree: int, top: bytes, **columns) -> pa.RecordBatch:
    n = len(columns["node"])
    region = [pa.array([tree] * n, pa.int32()), pa.array([top] * n, pa.binary())]
    return pa.RecordBatch.from_arrays(
        [*region, *(x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values())], [*REGION, *columns]
    )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs within ``REACH`` places of sorted rows and those with central nodes; then the first and
    last rows themselves."""
    last, head, any_task = None, None, TaskContext.get() is not None
    held, pivots = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        tree = batch.column("tree").to_numpy()
        node = batch.column("node").to_numpy()
        raw = batch.column("signature").cast(pa.binary(4 * VALUES))
        values = np.frombuffer(raw.buffers()[1], ">u4").reshape(-1, VALUES)
        values = values[raw.offset : raw.offset + len(raw)].astype(np.uint32)
        rows = tree, node, values
        if held is not None:
            rows = tuple(np.concatenate(x) for x in zip(held, rows, strict=True))
        tops = rows[0].astype(np.int64) << 32 | rows[2][:, 0]
        cuts = np.concatenate([[0], np.flatnonzero(tops[1:] != tops[:-1]) + 1, [len(tops)]])
        for at, to in zip(cuts[:-1], cuts[1:], strict=True):
            if to == len(tops) and to - at < HELD:
                break
            if to - at > REACH + 1 or pivots is not None:
                pairs, pivots = _central(*(x[at:to] for x in rows), pivots)
                yield pairs
            if to < len(tops):
                pivots = None
        held = tuple(x[at if to - at < HELD else to :] for x in rows)
        if last is not None:
            tree, node, values = (np.concatenate(x) for x in zip(last, (tree, node, values), strict=True))
        fresh = 0 if last is None else len(last[0])
        if head is None:
            head = tree[:REACH], node[:REACH], values[:REACH]
        for k in range(1, REACH + 1):
            if len(tree) <= k:
                break
            a, b = np.arange(len(tree) - k), np.arange(k, len(tree))
            new = (b >= fresh) & (tree[a] == tree[b]) & (values[a, 0] == values[b, 0])
            a, b = a[new], b[new]
            alike = (values[a] == values[b]).sum(1) >= AGREE
            a, b = a[alike], b[alike]
            low, high = np.minimum(node[a], node[b]), np.maximum(node[a], node[b])
            yield _pairs(low, high, (tree[a] < FIRST_TREES) & (k == 1))
        last = tree[-REACH:], node[-REACH:], values[-REACH:]
    if held is not None and len(held[0]) and (len(held[0]) > REACH + 1 or pivots is not None):
        yield _central(*held, pivots)[0]
    if any_task and head is not None:
        tree, node, values = (np.concatenate(x) for x in zip(head, last, strict=True))
        n, big = len(tree), values.astype(">u4")
        none, no = pa.nulls(n, pa.int64()), pa.nulls(n, pa.bool_())
        signature = pa.array([v.tobytes() for v in big], pa.binary())
        task = pa.array(np.full(n, TaskContext.get().partitionId(), np.int32))
        yield pa.RecordBatch.from_arrays(
            [none, none, no, pa.array(tree), signature, pa.array(node), task],
            [f.split()[0] for f in PAIRS.split(", ")],
        )


def _central(tree: np.ndarray, node: np.ndarray, values: np.ndarray, pivots: tuple | None):
    """(pairs, pivots) of the rows of one region with its central nodes.

    ``pivots`` (nodes, signatures) come from earlier rows of the region. The most central row is the one
    that agrees most with rows spread over the region.
    """
    left, low, high = np.arange(len(node)), [], []
    names, marks = ([], []) if pivots is None else (list(x) for x in pivots)
    for k in range(len(node) + len(names)):
        if k < len(names):
            name, mark = names[k], marks[k]
        else:
            if len(left) < 2:
                break
            rows = values[left]
            sample = rows[np.linspace(0, len(rows) - 1, min(SAMPLE, len(rows))).astype(int)]
            best = int(np.argmax(sum((rows == x).sum(1) for x in sample)))
            name, mark = node[left[best]], rows[best]
        hit = (values[left] == mark).sum(1) >= AGREE
        met = node[left[hit]]
        met = met[met != name]
        if k >= len(names):
            if not len(met):
                break
            names.append(name)
            marks.append(mark)
        low.append(np.minimum(met, name))
        high.append(np.maximum(met, name))
        left = left[~hit]
    a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (low, high))
    return _pairs(a, b, np.full(len(a), tree[0] < FIRST_TREES)), (names, marks)


def _pairs(a: np.ndarray, b: np.ndarray, early: np.ndarray) -> pa.RecordBatch:
    n = len(a)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(a), pa.array(b), pa.array(early),
            pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.int64()),
            pa.nulls(n, pa.int32()),
        ],
        [f.split()[0] for f in PAIRS.split(", ")],
    )


def full_sets(documents: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, items) of the nodes in ``wanted`` (node, first_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.sliced(batches):
            sets = [s.view(np.int64) for s in shingle_sets(batch.column("text"), width)]
            names = [node_of(s.view(U64)) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(names, pa.int64()), pa.array(sets, pa.list_(pa.int64()))],
                ["node", "own", "items"],
            )

    rows = _rows(documents).join(small(wanted), F.col("doc_id") == F.col("first_id"))
    sets = rows.select("node", "text").mapInArrow(run, "node bigint, own bigint, items array<bigint>")
    return sets.filter("node = own").drop("own").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - both
    return (
        pairs.select("a", "b").join(left, "a").join(right, "b")
        .filter(both * 100 >= union * similarity)
        .select("a", "b")
    )


def groups(documents: DataFrame, width: int = 5, similarity: int = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of ``documents`` (doc_id, text)."""
    sketches = written(sketch(documents, width), "sketch")
    nodes = written(
        sketches.filter("doc_id IS NOT NULL AND node IS NOT NULL")
        .groupBy("node")
        .agg(F.min("doc_id").alias("first_id"), F.min("signature").alias("signature")),
        "nodes",
    )
    pairs = written(candidates(nodes.select("node", "signature")), "candidates")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = written(nodes.select("node", "first_id").join(ids, "node"), "wanted")
    sets = written(full_sets(documents, wanted, width), "sets")
    links = written(confirmed(pairs.filter("early"), sets, similarity), "links")
    part = written(connected(links), "groups")
    rest = pairs.filter("NOT early")
    for end in "ab":
        own = part.select(F.col("node").alias(end), F.col("component").alias(f"_{end}"))
        rest = rest.join(own, end, "left")
    rest = written(rest.filter("_a IS NULL OR _b IS NULL OR _a <> _b").select("a", "b"), "open")
    more = written(confirmed(rest, sets, similarity), "links")
    same_id = nodes.groupBy("first_id").agg(F.min("node").alias("a"), F.max("node").alias("b"))
    joined = links.union(more).union(same_id.filter("a < b").select("a", "b"))
    component = F.coalesce("component", "node")
    member = written(
        nodes.select("node", "first_id").join(connected(joined), "node", "left")
        .select("node", "first_id", component.alias("component")),
        "members",
    )
    smallest = written(member.groupBy("component").agg(F.min("first_id").alias("component_id")), "smallest")
    named = written(member.join(smallest, "component").select("node", "component_id"), "named")
    component_id = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return sketches.join(named, "node", "left").select(
        "doc_id",
        "n_shingles",
        component_id.alias("component_id"),
        F.coalesce(F.col("doc_id") == component_id, F.lit(True)).alias("kept"),
    )


def _orderable(field: T.StructField) -> Column:
    """A column to sort by; types without an order (maps, and what holds them) are sorted as JSON."""
    kind = field.dataType.simpleString()
    if "map<" in kind or "variant" in kind:
        return F.to_json(F.struct(*quoted([field.name])))
    return quoted([field.name])[0]


def one_of_each(documents: DataFrame, width: int = 5, similarity: int = SIMILARITY) -> DataFrame:
    """The documents without all but one of each group; of rows that repeat an id, one stays."""
    judged = written(groups(documents, width, similarity).select("doc_id", "kept"), "judged")
    ids = written(judged.filter("kept AND doc_id IS NOT NULL").groupBy("doc_id").count(), "kept")
    kept = documents.join(ids.select("doc_id"), "doc_id", "left_semi")
    if not ids.filter("count > 1").isEmpty():
        first = Window.partitionBy("doc_id").orderBy(*[_orderable(f) for f in documents.schema])
        place = unused(documents, "_n")
        kept = kept.withColumn(place, F.row_number().over(first)).filter(F.col(place) == 1)
        kept = kept.select(*quoted(documents.columns))
    return kept.union(documents.filter("doc_id IS NULL")).select(*quoted(documents.columns))
