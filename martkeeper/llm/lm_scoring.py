"""Language-model scores: stupid backoff over n-grams of token ids, by look-ups of whole chunks of documents.

Counted over all documents: n-grams up to ``order`` (2 to 4) tokens. A document is scored by the others:
its own occurrences are taken off every count. A token w after a context v of ``order`` - 1 tokens has
c(vw) / c(v), where c(v) counts v with a token behind it, if the other documents have vw; else
``BACKOFF`` times the score of w after the context without its first token, and so on down to c(w) / N; a
token that no other document has counts as half an occurrence there. The first tokens of a document
have as much context as there is.

Documents are dealt over chunks of some ``TOKENS`` tokens. A chunk names each of its n-grams once, with its own
counts, in a few blobs dealt by the n-gram's hash; where these meet they are added up, and the chunk is
sent what the other chunks have, in the order in which it asked, so n-grams travel one way only. Then it scores
its documents. A frequent n-gram is one entry a chunk, so none makes a task longer than others; no n-gram
is a row. Logarithms are added as whole millionths, so the sums don't depend on the order.

Rows that repeat an id are scored one by one and added up; rows without an id make one row. An empty
or NULL text has no tokens and no score. Token ids must be below 65,536.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkeeper.llm import textbytes as tb
from martkeeper.llm.common import written
from martkeeper.llm.word_codes import word_codes

BACKOFF = 0.4
ORDER = 3
TOKENS = 1 << 20
VOCABULARY = 1 << 16
MILLION = 1_000_000

U64 = np.uint64

CHUNKS = "chunk bigint, tokens bigint, doc_ids array<bigint>, lengths array<bigint>, ids binary"
ASKED = "part int, chunk bigint, size int, keys binary, n binary, followed binary"
ANSWERS = "chunk bigint, size int, part int, n binary, followed binary"
SUMS = "doc_id bigint, n_tokens bigint, millionths bigint, backed_off bigint"


def chunks(documents: DataFrame, tokenizer: str, tokens: int = TOKENS) -> DataFrame:
    """The ids and lengths of the texts, some ``tokens`` a row or one document, written: texts are encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, squeeze = word_codes(tokenizer), zstandard.ZstdCompressor().compress
        held, size, number = [], 0, TaskContext.get().partitionId() << 32

        def row() -> pa.RecordBatch:
            doc_ids, lengths, ids = (list(x) for x in zip(*held, strict=True))
            one = [0, sum(map(len, lengths))]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number]),
                    pa.array([size]),
                    pa.ListArray.from_arrays(one, pa.concat_arrays(doc_ids)),
                    pa.ListArray.from_arrays(one, pa.array(np.concatenate(lengths).astype(np.int64))),
                    pa.array([squeeze(np.concatenate(ids).astype("<u2").tobytes())], pa.binary()),
                ],
                _names(CHUNKS),
            )

        for batch in tb.sliced(batches):
            ids, lengths = coder.ids(*tb.buffers(batch.column("text")))
            if len(ids) and ids.max() >= VOCABULARY:
                raise ValueError(f"token ids must be below {VOCABULARY}")
            ends = np.cumsum(lengths)
            cuts = np.flatnonzero(np.diff(ends // tokens, prepend=-1))
            for first, last in zip(cuts, [*cuts[1:], len(lengths)], strict=True):
                piece = ids[ends[first] - lengths[first] : ends[last - 1]]
                if held and size + len(piece) > tokens:
                    yield row()
                    held, size, number = [], 0, number + 1
                held.append((batch.column("doc_id").slice(first, last - first), lengths[first:last], piece))
                size += len(piece)
        if held:
            yield row()

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(rows.mapInArrow(run, CHUNKS), "chunks")


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


class Grams(NamedTuple):
    """The n-grams of a size in a chunk: sorted ``keys`` of 16 bits a token, how often each occurs (``n``) and
    occurs with a token behind it (``followed``); for the place of each last token the number of its n-gram, or
    -1, and the same two counts in its document only."""

    size: int
    keys: np.ndarray
    n: np.ndarray
    followed: np.ndarray
    number: np.ndarray
    own: np.ndarray
    own_followed: np.ndarray


def _by_code(codes: np.ndarray) -> np.ndarray:
    """The places by their codes, equal ones in their order."""
    bits = max(len(codes) - 1, 1).bit_length()
    if len(codes) and int(codes.max()).bit_length() + bits <= 64:  # sorting numbers is faster than sorting places
        codes = codes << U64(bits)
        codes |= np.arange(len(codes), dtype=U64)
        codes.sort()
        return (codes & U64(2**bits - 1)).view(np.int64)
    return np.argsort(codes, kind="stable")


def grams(ids: np.ndarray, lengths: np.ndarray, order: int) -> Iterator[Grams]:
    """The n-grams of texts, of each size from 1 on. One is sorted as the number of its beginning and a token."""
    kind = np.int32 if len(ids) < 2**31 else np.int64
    rows = np.repeat(np.arange(len(lengths), dtype=kind), lengths)
    ends = np.cumsum(lengths) - 1  # the last token of each text
    total, keys, number = len(ids), np.empty(0, U64), np.empty(0, kind)
    for size in range(1, order + 1):
        at = (np.flatnonzero(rows[size - 1 :] == rows[: max(total - size + 1, 0)]) + size - 1).astype(kind)
        codes = ids[at].astype(U64)
        if size > 1:
            codes |= number[at - 1].astype(U64) << U64(16)
        by = _by_code(codes)
        at, codes = at[by], codes[by]
        del by
        new = np.ones(len(at), bool)
        new[1:] = codes[1:] != codes[:-1]
        fresh = new.copy()
        fresh[1:] |= rows[at[1:]] != rows[at[:-1]]
        del codes
        first, last = at[new], ends[rows[at[fresh]]]
        n = np.diff(np.append(np.flatnonzero(new), len(at)))
        start = keys[number[first - 1]] << U64(16) if size > 1 else U64(0)
        keys = start | ids[first].astype(U64)
        number, own, own_followed = np.full(total, -1, kind), np.zeros(total, kind), np.zeros(total, kind)
        number[at] = np.cumsum(new, dtype=kind) - 1
        times = np.diff(np.append(np.flatnonzero(fresh), len(at))).astype(kind)
        ending = number[last] == number[at[fresh]]
        own[at] = np.repeat(times, times)
        own_followed[at] = np.repeat(times - ending, times)
        followed = n - np.bincount(number[last[ending]], minlength=len(n))
        yield Grams(size, keys, n, followed, number, own, own_followed)


def _dealt(found: Grams, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, bounds) of the n-grams by their part."""
    part = (tb.mix(found.keys + U64(found.size)) % U64(parts)).astype(np.int64)
    return np.argsort(part, kind="stable"), np.searchsorted(np.sort(part), np.arange(parts + 1))


def _narrow(numbers: np.ndarray) -> np.ndarray:
    """The numbers in as few bytes as the largest takes; a reader knows how many there are."""
    most = int(numbers.max()) if len(numbers) else 0
    return numbers.astype(next(t for t in ("<u1", "<u2", "<u4", "<u8") if most <= np.iinfo(t).max))


def _squeezed(blobs: Iterable[np.ndarray]) -> pa.Array:
    """The numbers of each blob, first the low bytes of all of them and so on."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    planes = (np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T for x in blobs)
    return pa.array([squeeze(x.tobytes()) for x in planes], pa.binary())


def _whole(raw: bytes, count: int | None = None) -> np.ndarray:
    """The ``count`` numbers of a squeezed blob, of two bytes each by default."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    width = len(planes) // count if count else 2
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(f"<u{width}").ravel()


def _wide(column: pa.ChunkedArray, counts: Iterable[int]) -> np.ndarray:
    """The numbers of all blobs, so many in each."""
    return np.concatenate([_whole(x, n).astype(np.int64) for x, n in zip(column.to_pylist(), counts, strict=True)])


def _keys(raw: bytes, size: int) -> np.ndarray:
    """The keys of a blob, which has their first tokens, then their second ones and so on."""
    keys = U64(0)
    for tokens in _whole(raw).reshape(size, -1):
        keys = keys << U64(16) | tokens.astype(U64)
    return keys


def _texts(chunk: pa.Table | pa.RecordBatch, at: int = 0) -> tuple[np.ndarray, np.ndarray]:
    ids = zstandard.ZstdDecompressor().decompress(chunk.column("ids")[at].as_py())
    return np.frombuffer(ids, "<u2"), chunk.column("lengths")[at].values.to_numpy()


def asked(rows: DataFrame, order: int, parts: int) -> DataFrame:
    """The n-grams of each chunk with its counts, a blob for each size and part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                chunk = batch.column("chunk")[at].as_py()
                for found in grams(*_texts(batch, at), order):
                    by, bounds = _dealt(found, parts)
                    tokens = np.stack([(found.keys >> U64(16 * k)).astype("<u2") for k in reversed(range(found.size))])
                    tokens = tokens[:, by]
                    some = np.flatnonzero(np.diff(bounds))
                    slices = [slice(bounds[k], bounds[k + 1]) for k in some]
                    n, followed = (_narrow(x)[by] for x in (found.n, found.followed))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(some.astype(np.int32)),
                            pa.array(np.full(len(some), chunk)),
                            pa.array(np.full(len(some), found.size, np.int32)),
                            _squeezed(tokens[:, s] for s in slices),
                            _squeezed(n[s] for s in slices),
                            _squeezed(followed[s] for s in slices),
                        ],
                        _names(ASKED),
                    )

    return rows.select("chunk", "lengths", "ids").mapInArrow(run, ASKED)


def answers(asked: DataFrame) -> DataFrame:
    """What the other chunks have of the n-grams of each blob, in its order."""

    def run(table: pa.Table) -> pa.Table:
        out = []
        sizes = table.column("size").to_numpy()
        for size in np.unique(sizes):
            rows = table.take(pa.array(np.flatnonzero(sizes == size)))
            keys = [_keys(raw, size) for raw in rows.column("keys").to_pylist()]
            counts = [len(k) for k in keys]
            bounds = np.concatenate([[0], np.cumsum(counts)])
            _, number = np.unique(np.concatenate(keys), return_inverse=True)
            columns = {c: rows.column(c) for c in ("chunk", "size", "part")}
            for c in ("n", "followed"):
                mine = _wide(rows.column(c), counts)
                others = np.bincount(number, mine).astype(np.int64)[number] - mine
                columns[c] = _squeezed(_narrow(others[a:b]) for a, b in zip(bounds, bounds[1:], strict=False))
            out.append(pa.table(columns))
        return pa.concat_tables(out)

    return asked.groupBy("part").applyInArrow(run, ANSWERS)


def _log(ratio: np.ndarray) -> np.ndarray:
    return np.rint(np.log(ratio) * MILLION).astype(np.int64)


def score(documents: DataFrame, tokenizer: str, tokens: int = TOKENS, order: int = ORDER) -> DataFrame:
    """doc_id, n_tokens, backed_off, log_score and mean_log_score of each document.

    ``backed_off`` is the number of steps to a shorter context, over all tokens.
    """
    if not 2 <= order <= 4:
        raise ValueError("the order is 2, 3 or 4")
    rows = chunks(documents, tokenizer, tokens)
    total = rows.agg(F.sum("tokens")).first()[0] or 0
    parts = 2 * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    told = written(answers(asked(rows, order, parts)), "answers")

    def run(chunk: pa.Table, told: pa.Table) -> pa.Table:
        ids, lengths = _texts(chunk)
        told = told.sort_by("part")
        sizes = told.column("size").to_numpy()
        counts, own, numbers = {}, {}, {}
        for found in grams(ids, lengths, order):
            by, bounds = _dealt(found, parts)
            some = np.diff(bounds)[np.diff(bounds) > 0]
            mine = told.take(pa.array(np.flatnonzero(sizes == found.size)))
            if len(some):
                found.n[by] += _wide(mine.column("n"), some)
                found.followed[by] += _wide(mine.column("followed"), some)
            counts[found.size], numbers[found.size] = (found.n, found.followed), found.number
            own[found.size] = found.own, found.own_followed
        marks, steps, open_ = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64), np.ones(len(ids), bool)
        length = np.repeat(lengths, lengths)
        for size in range(order, 0, -1):
            at = np.flatnonzero(open_ & (numbers[size] >= 0))
            left = counts[size][0][numbers[size][at]] - own[size][0][at]
            if size > 1:
                known = left > 0
                steps[at[~known]] += 1
                at, left = at[known], left[known]
                of = counts[size - 1][1][numbers[size - 1][at - 1]] - own[size - 1][1][at - 1]
            else:
                left, of = np.maximum(left, 0.5), total - length[at]
            marks[at] = _log(BACKOFF ** steps[at] * (left / np.maximum(of, 1)))
            open_[at] = False
        row = np.repeat(np.arange(len(lengths)), lengths)
        sums = [np.zeros(len(lengths), np.int64) for _ in range(2)]
        for into, values in zip(sums, (marks, steps), strict=True):
            np.add.at(into, row, values)
        return pa.table([chunk.column("doc_ids")[0].values, pa.array(lengths), *map(pa.array, sums)], _names(SUMS))

    scored = rows.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(run, SUMS)
    sums = scored.groupBy("doc_id").agg(*[F.sum(c).alias(c) for c in _names(SUMS)[1:]])
    total_score = F.col("millionths") / MILLION
    return sums.select(
        "doc_id",
        "n_tokens",
        "backed_off",
        F.when(F.col("n_tokens") > 0, total_score).alias("log_score"),
        F.when(F.col("n_tokens") > 0, F.round(total_score / F.col("n_tokens"), 6)).alias("mean_log_score"),
    )
