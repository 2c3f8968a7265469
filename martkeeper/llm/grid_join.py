"""Embedding near-dedup: an epsilon grid order join of unit vectors.

Two unit vectors have a cosine of at least c if and only if they are at most eps = sqrt(2 - 2c)
apart. Equal vectors are one class with a weight, so copies are never compared with each other.
The classes are sorted by the grid cells of width eps of their leading principal axes (fitted on all
of them), and within a cell by the finer place there. This sequence is cut into blocks of a few
thousand classes, and intervals of ``FAN`` blocks, of ``FAN`` such intervals and so on are described
by the box and the ball that hold them.

The join is recursive. It starts with the whole sequence against itself and replaces a pair of
intervals by the pairs of their parts. A pair whose boxes or balls are more than eps apart is
provably distant and goes; a pair whose balls together reach less than eps is linked as a whole,
without a look at its members; what remains at the last level are pairs of blocks. A task splits
these further by halves, with the same tests, down to ``LEAF`` classes, and compares the rest by
their cosines in double precision. It returns the weights that a class is linked with and a spanning
forest of the links, never the links one by one.

A block has at most ``BLOCK_BYTES`` of vectors, so no task holds a large group: a group of
near-copies is a run of blocks. The result doesn't depend on the axes, the blocks or the number of
partitions; these decide only what is skipped. Where vectors have no structure (all directions
alike) little can be skipped, and the comparisons grow with the square of the classes.

A vector that is NULL, zero or has NULL or non-finite entries has no links and is a component of
its own; so is one whose length isn't the most frequent one (of equally frequent ones, the
greatest). Repeated rows and ids are vectors of their own. Rows without an id are linked and counted
like others; a component's id is its smallest known one, NULL where there is none, and ``kept`` is
NULL for a row without an id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martkeeper.llm.common import connected, written

COSINE = 0.9
BLOCK_BYTES = 2 << 20
FAN = 8
LEAF = 256
AXES = 8
FINER = 8
# More than double precision may be off by; decides only which pairs are looked at.
SLACK = 1e-6

BOUNDS = (
    "i bigint, weight bigint, low array<double>, high array<double>, centre array<double>, radius double"
)
FOUND = "node bigint, other bigint, weight bigint"
DISTANT, OPEN, WHOLE = 0, 1, 2


def _usable(vector: str) -> Column:
    c = F.col(vector)
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return c.isNotNull() & ~bad & F.exists(c, lambda v: v != 0)


def classes(table: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int]:
    """(vector, weight, first_id) of the distinct usable vectors, and their length."""
    entries = F.col(vector).cast("array<double>").alias("vector")
    rows = table.select(F.col("vec_id").cast("bigint").alias("vec_id"), entries)
    counted = rows.filter(_usable("vector")).groupBy("vector").agg(
        F.count("*").alias("weight"), F.min("vec_id").alias("first_id")
    )
    counted = written(counted, "vectors")
    sizes = counted.groupBy(F.size("vector").alias("d")).agg(F.sum("weight").alias("n"))
    usual = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    d = usual["d"] if usual else 0
    return counted.filter(F.size("vector") == d), d


def units(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _list(values: np.ndarray) -> pa.Array:
    ends = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))


def principal_axes(vectors: DataFrame, d: int) -> np.ndarray:
    """All axes as columns, from the greatest variance to the smallest; fitted on all classes."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d + 2, d))
        for batch in batches:
            if batch.num_rows:
                u = units(_matrix(batch.column("vector"), d))
                total[0, 0] += len(u)
                total[1] += u.sum(axis=0)
                total[2:] += u.T @ u
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], ["k", "v"]
        )

    sums = vectors.select("vector").mapInArrow(partial, "k int, v double").groupBy("k")
    total = np.zeros((d + 2) * d)
    for row in sums.agg(F.sum("v").alias("v")).collect():
        total[row.k] = row.v
    total = total.reshape(d + 2, d)
    n = max(total[0, 0], 1)
    mean = total[1] / n
    return np.linalg.eigh(total[2:] / n - np.outer(mean, mean))[1][:, ::-1]


def grid_order(vectors: DataFrame, d: int, axes: np.ndarray, eps: float) -> DataFrame:
    """(node, vector, weight, first_id): the classes numbered along the epsilon grid order.

    A number is the rows before in the same sorted partition plus those of the partitions before;
    the window runs over one row per partition.
    """
    lead = min(AXES, d)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                p = units(_matrix(batch.column("vector"), d)) @ axes[:, :lead] / eps
                cells, finer = (np.floor(p * k).astype(np.int32) for k in (1, FINER))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, _list(cells), _list(finer)], [*batch.schema.names, "cell", "finer"]
                )

    schema = "vector array<double>, weight bigint, first_id bigint"
    order = ["cell", "finer", "vector"]
    rows = vectors.select("vector", "weight", "first_id").mapInArrow(
        placed, f"{schema}, cell array<int>, finer array<int>"
    )
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    dealt = dealt.select("vector", "weight", "first_id", F.spark_partition_id().alias("part"))

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            row = np.arange(before, before + batch.num_rows, dtype=np.int64)
            before += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(row)], [*batch.schema.names, "row"])

    table = written(dealt.mapInArrow(numbered, f"{schema}, part int, row bigint"), "grid-order")
    counts = table.groupBy("part").agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.orderBy("part")) - F.col("n")
    offsets = F.broadcast(counts.select("part", earlier.alias("first")))
    return table.join(offsets, "part").select(
        (F.col("first") + F.col("row")).alias("node"), "vector", "weight", "first_id"
    )


def _bounds(x: np.ndarray):
    centre = x.mean(axis=0)
    radius = float(np.sqrt(((x - centre) ** 2).sum(axis=1)).max())
    return x.min(axis=0), x.max(axis=0), centre, radius


def _verdict(a, b, eps: float) -> int:
    """Of two sets by their (low, high, centre, radius)."""
    gap = np.maximum(0, np.maximum(a[0] - b[1], b[0] - a[1]))
    between = float(np.sqrt(((a[2] - b[2]) ** 2).sum()))
    if between + a[3] + b[3] <= eps - SLACK:
        return WHOLE
    if (gap * gap).sum() > (eps + SLACK) ** 2 or between - a[3] - b[3] > eps + SLACK:
        return DISTANT
    return OPEN


def pack(nodes: DataFrame, d: int, size: int, axes: np.ndarray) -> DataFrame:
    """One row per block of ``size`` classes: their vectors and weights in order, and the bounds."""

    def packed(key, table):
        order = np.argsort(table.column("node").to_numpy())
        x = _matrix(table.column("vector").combine_chunks(), d)[order]
        w = table.column("weight").to_numpy()[order].astype(np.int64)
        low, high, centre, radius = _bounds(units(x) @ axes)
        arrays = [[key[0].as_py()], [int(w.sum())], _list(low[None]), _list(high[None]), _list(centre[None]),
                  [radius], [x.tobytes()], [w.tobytes()]]
        return pa.table(arrays, names=["i", "weight", "low", "high", "centre", "radius", "vectors", "weights"])

    rows = nodes.select(F.floor(F.col("node") / size).alias("i"), "node", "vector", "weight")
    return rows.groupBy("i").applyInArrow(packed, f"{BOUNDS}, vectors binary, weights binary")


def _merged(key, table):
    """The bounds of the parts (at most ``FAN``) of an interval."""
    low, high, centres = (
        np.array(table.column(c).to_pylist()) for c in ("low", "high", "centre")
    )
    weight = table.column("weight").to_numpy()
    centre = (centres * weight[:, None]).sum(axis=0) / weight.sum()
    reach = np.sqrt(((centres - centre) ** 2).sum(axis=1)) + table.column("radius").to_numpy()
    arrays = [[key[0].as_py()], [int(weight.sum())], _list(low.min(axis=0)[None]),
              _list(high.max(axis=0)[None]), _list(centre[None]), [float(reach.max())]]
    return pa.table(arrays, names=["i", "weight", "low", "high", "centre", "radius"])


def interval_levels(blocks: DataFrame) -> list[DataFrame]:
    """The bounds of the blocks, then of ``FAN`` times as many at each level, up to one interval."""
    levels = [written(blocks.select("i", "weight", "low", "high", "centre", "radius"), "bounds")]
    while levels[-1].limit(2).count() == 2:
        up = levels[-1].withColumn("up", F.floor(F.col("i") / FAN)).groupBy("up")
        levels.append(written(up.applyInArrow(_merged, BOUNDS), "bounds"))
    return levels


def _judged(pairs: DataFrame, eps: float) -> DataFrame:
    """(i, j, i_weight, j_weight, verdict) of pairs with the bounds of both."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for side in "ij":
                parts = [np.array(batch.column(f"{side}_{c}").to_pylist()) for c in ("low", "high", "centre")]
                sides.append([*parts, batch.column(f"{side}_radius").to_numpy()])
            verdict = [
                _verdict([p[k] for p in sides[0]], [p[k] for p in sides[1]], eps)
                for k in range(batch.num_rows)
            ]
            names = ["i", "j", "i_weight", "j_weight"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(verdict, pa.int32())], [*names, "verdict"]
            )

    return pairs.mapInArrow(judged, "i bigint, j bigint, i_weight bigint, j_weight bigint, verdict int")


def _side(level: DataFrame, side: str) -> DataFrame:
    parts = level.withColumn("up", F.floor(F.col("i") / FAN))
    return parts.select(*[F.col(c).alias(side if c == "i" else f"{side}_{c}") for c in parts.columns])


def interval_join(levels: list[DataFrame], eps: float) -> tuple[DataFrame, list[DataFrame]]:
    """(pairs of blocks that are left to compare, per level the pairs that are linked as a whole)."""
    whole: list[DataFrame] = [None] * len(levels)
    pairs = None
    for k in reversed(range(len(levels))):
        left, right = _side(levels[k], "i"), _side(levels[k], "j")
        if pairs is None:
            both = left.join(right, F.col("i") == F.col("j"))
        else:
            up = pairs.select(F.col("i").alias("i_up"), F.col("j").alias("j_up"))
            both = up.join(left, "i_up").join(right, "j_up").filter("i <= j")
        found = written(_judged(both, eps).filter(F.col("verdict") != DISTANT), "intervals")
        whole[k] = found.filter(F.col("verdict") == WHOLE)
        pairs = found.filter(F.col("verdict") == OPEN)
    return pairs.select("i", "j"), whole


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) that connect what the links (a, b) connect."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for side in (x, y):
            np.minimum.at(new, side, low)
            np.minimum.at(new, label[side], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


class _Block:
    """A block's units, their places on the axes, and the bounds of its parts."""

    def __init__(self, first: int, vectors: bytes, weights: bytes, d: int, axes: np.ndarray) -> None:
        self.first = first
        self.units = units(np.frombuffer(vectors, float).reshape(-1, d))
        self.weights = np.frombuffer(weights, np.int64)
        self.places = self.units @ axes
        self._bounds: dict[tuple[int, int], tuple] = {}

    def bounds(self, lo: int, hi: int):
        if (lo, hi) not in self._bounds:
            self._bounds[lo, hi] = _bounds(self.places[lo:hi])
        return self._bounds[lo, hi]


def _halves(lo: int, hi: int) -> list[tuple[int, int]]:
    middle = (lo + hi) // 2
    return [(lo, middle), (middle, hi)] if hi - lo > LEAF else [(lo, hi)]


def compare_blocks(a: _Block, b: _Block, cosine: float, eps: float):
    """(weights linked to a's classes, to b's, edges from, edges to); a class is linked to itself."""
    same = a is b
    sums = np.zeros(len(a.weights), np.int64), np.zeros(len(b.weights), np.int64)
    edges: list[tuple[np.ndarray, np.ndarray]] = []
    todo = [(0, len(a.weights), 0, len(b.weights))]
    while todo:
        al, ah, bl, bh = todo.pop()
        verdict = _verdict(a.bounds(al, ah), b.bounds(bl, bh), eps)
        if verdict == DISTANT:
            continue
        itself = same and al == bl
        if verdict == WHOLE:
            sums[0][al:ah] += b.weights[bl:bh].sum()
            if not itself:
                sums[1][bl:bh] += a.weights[al:ah].sum()
            star = np.concatenate([np.arange(al, ah) + a.first, np.arange(bl, bh) + b.first])
            edges.append((star, np.full(len(star), a.first + al)))
        elif max(ah - al, bh - bl) > LEAF:
            todo += [
                (*p, *q)
                for p in _halves(al, ah)
                for q in _halves(bl, bh)
                if not itself or p[0] <= q[0]
            ]
        else:
            near = a.units[al:ah] @ b.units[bl:bh].T >= cosine
            if itself:
                np.fill_diagonal(near, True)
            sums[0][al:ah] += near @ b.weights[bl:bh]
            if not itself:
                sums[1][bl:bh] += a.weights[al:ah] @ near
            x, y = np.nonzero(np.triu(near, 1) if itself else near)
            if len(x):
                edges.append(forest(x + al + a.first, y + bl + b.first))
    x, y = (np.concatenate(e) for e in zip(*edges, strict=True)) if edges else (np.empty(0, np.int64),) * 2
    return *sums, *forest(x, y)


def compare(pairs: DataFrame, blocks: DataFrame, d: int, size: int, axes: np.ndarray, cosine: float) -> DataFrame:
    """(node, NULL, weight) for the weight that a class is linked with, (node, other, NULL) for edges."""
    eps = float(np.sqrt(2 - 2 * cosine))
    rows = blocks.select("i", "vectors", "weights")
    left = rows.select("i", *[F.col(c).alias(f"i_{c}") for c in ("vectors", "weights")])
    right = rows.select(F.col("i").alias("j"), *[F.col(c).alias(f"j_{c}") for c in ("vectors", "weights")])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                i, j, iv, iw, jv, jw = (batch.column(c)[k].as_py() for c in (
                    "i", "j", "i_vectors", "i_weights", "j_vectors", "j_weights"))
                a = _Block(i * size, iv, iw, d, axes)
                b = a if i == j else _Block(j * size, jv, jw, d, axes)
                to_a, to_b, x, y = compare_blocks(a, b, cosine, eps)
                nodes, weights = [], []
                for block, w in ((a, to_a), (b, to_b)):
                    hit = np.flatnonzero(w)
                    nodes.append(hit + block.first)
                    weights.append(w[hit])
                none = pa.nulls(len(x), pa.int64())
                node, weight = np.concatenate(nodes), np.concatenate(weights)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([pa.array(node), pa.array(x)]),
                        pa.concat_arrays([pa.nulls(len(node), pa.int64()), pa.array(y)]),
                        pa.concat_arrays([pa.array(weight), none]),
                    ],
                    ["node", "other", "weight"],
                )

    return pairs.join(left, "i").join(right, "j").mapInArrow(compared, FOUND)


def _whole_links(nodes: DataFrame, whole: list[DataFrame], size: int) -> DataFrame:
    """What :func:`compare` returns, for the pairs of intervals that are linked as a whole."""
    out = None
    for k, pairs in enumerate(whole):
        length = size * FAN**k
        other = pairs.filter("i <> j").select(
            F.col("j").alias("i"), F.col("i_weight").alias("w"), F.col("i").alias("j")
        )
        sides = pairs.select("i", F.col("j_weight").alias("w"), "j").union(other)
        per = sides.groupBy("i").agg(F.sum("w").alias("w"), F.min("j").alias("j"))
        inside = nodes.select("node", F.floor(F.col("node") / length).alias("i")).join(per, "i")
        none = F.lit(None).cast("bigint")
        rows = inside.select("node", none.alias("other"), F.col("w").alias("weight"))
        rows = rows.union(inside.filter(F.col("node") != F.col("j") * length).select(
            "node", (F.col("j") * length).alias("other"), none.alias("weight")))
        rows = rows.union(pairs.select(
            (F.col("i") * length).alias("node"), (F.col("j") * length).alias("other"), none.alias("weight")))
        out = rows if out is None else out.union(rows)
    return out


def near_vectors(table: DataFrame, vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    given = table.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    )
    own = given.select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"),
        (F.col("vec_id") == F.col("vec_id")).alias("kept"),
    )
    found, d = classes(table, vector)
    if not d:
        return own
    eps = float(np.sqrt(2 - 2 * cosine))
    size = max(LEAF, BLOCK_BYTES // (8 * d))
    axes = principal_axes(found, d)
    nodes = written(grid_order(found, d, axes, eps), "nodes")
    blocks = written(pack(nodes, d, size, axes), "blocks")
    pairs, whole = interval_join(interval_levels(blocks), eps)
    links = written(
        compare(pairs, blocks, d, size, axes, cosine).union(_whole_links(nodes, whole, size)), "links"
    )
    weights = links.filter("weight IS NOT NULL").groupBy("node").agg(F.sum("weight").alias("linked"))
    edges = links.filter("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b"))
    component = F.coalesce("component", "node").alias("component")
    grouped = written(
        nodes.join(connected(edges), "node", "left").join(weights, "node").select(
            "vector", "first_id", component, (F.col("linked") - 1).alias("n_links")
        ),
        "components",
    )
    ids = grouped.groupBy("component").agg(F.min("first_id").alias("component_id"))
    judged = written(grouped.join(ids, "component").select("vector", "n_links", "component_id"), "judged")
    usable = _usable("vector") & (F.size("vector") == d)
    ours = given.filter(usable).join(judged, "vector").select(
        "vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept")
    )
    rest = given.filter(~F.coalesce(usable, F.lit(False)))
    return ours.union(rest.select(
        "vec_id", F.lit(0).cast("bigint"), F.col("vec_id"), F.col("vec_id") == F.col("vec_id")))
