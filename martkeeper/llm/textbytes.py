"""Vectorised work on the bytes of a batch of texts: words, their hashes, short n-grams.

A batch is cut into slices of a few megabytes so that the arrays, eight bytes for each byte of
text, stay small; a single longer text makes a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
CHUNK = 1 << 20

# The white space that separates words.
SPACES = b" \t\n\x0b\x0c\r"

U64 = np.uint64


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a column of strings or bytes; NULL is empty."""
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        column = column.fill_null(b"").cast(pa.large_binary())
    else:
        column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def sliced(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``SLICE_BYTES`` of text, or of one row."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = np.diff(buffers(batch.column(column))[1])
        group = np.cumsum(lengths) // SLICE_BYTES
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(start, end - start)


@cache
def _table(name: str) -> np.ndarray:
    """256 random words; lower-casing makes A-Z share the words of a-z."""
    table = np.random.default_rng(20240501).integers(0, 2**64, 256, dtype=U64)
    if name == "lower":
        table[65:91] = table[97:123]
    return table


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 2**64)
    up, down = np.full(CHUNK, base, U64), np.full(CHUNK, inverse, U64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def spans(data: np.ndarray, offsets: np.ndarray, breaks: bytes = SPACES):
    """(starts, ends, rows) of the runs of bytes that are not in ``breaks``, within a text."""
    inside = np.ones(256, bool)
    inside[list(breaks)] = False
    inside = inside[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _run_hashes(values, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the runs ``values(start, end)``, chunk by chunk."""
    out = np.empty(len(starts), U64)
    up, down = _powers()
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK, "right")))
        first, last = int(starts[at]), int(ends[to - 1])
        if last - first <= CHUNK:
            sums = np.zeros(last - first + 1, U64)
            np.cumsum(values(first, last) * up[: last - first], out=sums[1:])
            s, e = starts[at:to] - first, ends[at:to] - first
            out[at:to] = (sums[e] - sums[s]) * down[np.minimum(s, CHUNK - 1)]
        else:  # one run longer than a chunk
            total, factor, step = 0, 1, pow(int(up[1]), CHUNK, 2**64)
            for a in range(first, last, CHUNK):
                part = values(a, min(a + CHUNK, last))
                total += factor * int((part * up[: len(part)]).sum(dtype=U64))
                factor = factor * step % 2**64
            out[at] = total % 2**64
        at = to
    return mix(out + (ends - starts).astype(U64))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """A 64-bit hash of the bytes of each span: a polynomial over random words for them, mixed."""
    table = _table("lower" if lower else "exact")
    return _run_hashes(lambda a, b: table[data[a:b]], starts, ends)


def sequence_hashes(items: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of hashes, such as the words of a line."""
    return _run_hashes(lambda a, b: items[a:b], starts, ends)


def window_hashes(hashes: np.ndarray, rows: np.ndarray, width: int):
    """(hashes, first words) of all windows of ``width`` consecutive words of a text.

    ``rows`` has the text of each word.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, U64), np.empty(0, np.int64)
    total = np.zeros(n, U64)
    for k in range(width):
        total = mix(total * U64(0xD6E8FEB86659FD93) + hashes[k : k + n])
    first = np.flatnonzero(rows[:n] == rows[width - 1 :])
    return total[first], first


def per_row(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum of ``marks`` between each offset and the next."""
    sums = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def lines(data: np.ndarray, offsets: np.ndarray):
    """(starts, ends, rows, numbers) of the lines with a byte; a text's first line has number 0."""
    starts, ends, rows = spans(data, offsets, b"\n")
    breaks = np.zeros(len(data) + 1, np.int64)
    np.cumsum(data == 10, out=breaks[1:])
    return starts, ends, rows, (breaks[starts] - breaks[offsets[rows]]).astype(np.int32)


def lists(offsets: np.ndarray, **fields: np.ndarray) -> pa.Array:
    """A column of lists of structs."""
    items = pa.StructArray.from_arrays([pa.array(v) for v in fields.values()], list(fields))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), items)
