"""SentencePiece encoding and decoding with a batched Viterbi search in numpy.

The vocabulary and the scores come from a public model file; the segmentation is computed here. The
model's own segmentation joins the best-scored neighbouring pair again and again. The search finds
the same result: a sequence of pieces is the model's segmentation if and only if each neighbouring
two are what the model makes of the two together, since the first join across a border would also be
made there. So the weight of a step from piece a to piece b is 0 if the model keeps "ab" apart at
that place and minus infinity otherwise, and a step from the start asks the same of the piece alone.

Words of equal length advance together. At each place the hashes of the substrings that end there
probe the sorted hashes of the pieces, and the maximum over the pieces that fit stores how far the
last piece reaches back. Words are runs that start with the blanks before them (no piece goes from a
letter to a blank) and end before a character that no piece has, which is coded as its UTF-8 bytes.

Text is coded as the model does: blanks become U+2581 and one is put in front. Decoding gives the text
back, but for U+2581 itself, which becomes a blank. A NULL or empty text has no pieces; NULL ids
decode to an empty text. Each row is coded whole, repeated ones too.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkeeper.llm import textbytes as tb
from martkeeper.llm.common import quoted

BLANK = 0x2581
REMEMBERED = 400_000
PAIR_BITS = 21
TOGETHER = 40_000

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, BASE, U64), np.full(size, pow(BASE, -1, 2**64), U64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _value(chars: np.ndarray) -> np.ndarray:
    return tb.mix(chars.astype(U64) + U64(1))


class Pieces:
    """A vocabulary and the search over it."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.texts = [model.id_to_piece(i) for i in range(n)]
        self.scores = [model.get_score(i) for i in range(n)]
        self.byte = [i for i in range(n) if model.is_byte(i)]
        special = {i for i in range(n) if model.is_byte(i) or model.is_control(i) or model.is_unknown(i)}
        self.plain = [i for i in range(n) if i not in special]
        self.ids = {self.texts[i]: i for i in self.plain}
        self.longest = max(len(self.texts[i]) for i in self.plain)
        self.known = np.zeros(0x110000, bool)
        for text, i in self.ids.items():
            if len(text) == 1:
                self.known[ord(text)] = True
        for text in self.ids:
            if chr(BLANK) in text[1:] and text.strip(chr(BLANK)) or not all(self.known[ord(c)] for c in text):
                raise ValueError(f"the vocabulary doesn't split at words: {text!r}")
        keys = np.array([self._key(self.texts[i]) for i in self.plain], U64)
        order = np.argsort(keys)
        self.keys, self.key_ids = keys[order], np.array(self.plain)[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(keys >> U64(44)).astype(np.int64)] = True
        self.start = n
        self.pair_key = np.full(1 << PAIR_BITS, -1, np.int64)
        self.pair_fits = np.zeros(1 << PAIR_BITS, bool)
        # What decoding writes for each id.
        self.raw = [t.replace(chr(BLANK), " ").encode() for t in self.texts]
        for i in special:
            self.raw[i] = b""
        for value, i in enumerate(self.byte):
            self.raw[i] = bytes([value])
        self.raw[model.unk_id()] = " ⁇ ".encode()
        self.raw_sizes = np.array([len(r) for r in self.raw])
        self.raw_starts = np.cumsum(self.raw_sizes) - self.raw_sizes
        self.raw_bytes = np.frombuffer(b"".join(self.raw), np.uint8)
        self.forget()

    def forget(self) -> None:
        self.words = np.empty(0, U64)
        self.slots = np.empty(0, np.int64)
        self.flat = np.empty(0, np.int32)
        self.begins = np.zeros(1, np.int64)

    @staticmethod
    def _key(text: str) -> int:
        chars = np.array([ord(c) for c in text])
        return int((_value(chars) * _powers(64)[0][: len(chars)]).sum(dtype=U64))

    def joined(self, text: str) -> list[int]:
        """The pieces of a short known text: the best-scored pair is joined, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.scores[i] > best):
                    best, at = self.scores[i], k
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ids[p] for p in parts]

    def _fit(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Whether the model keeps each two pieces as they are, one after the other."""
        key = (before.astype(np.int64) << 20) | after
        place = ((key.astype(U64) * U64(BASE)) >> U64(64 - PAIR_BITS)).astype(np.int64)
        fits, missing = self.pair_fits[place], self.pair_key[place] != key
        if missing.any():
            new, inverse = np.unique(key[missing], return_inverse=True)
            found = np.empty(len(new), bool)
            for k, pair in enumerate(new.tolist()):
                a, b = pair >> 20, pair & 0xFFFFF
                two = [b] if a == self.start else [a, b]
                found[k] = self.joined("".join(self.texts[i] for i in two)) == two
            fits[missing] = found[inverse]
            self.pair_key[place[missing]], self.pair_fits[place[missing]] = key[missing], fits[missing]
        return fits

    def _lookup(self, hashes: np.ndarray) -> np.ndarray:
        """The piece with each hash, or -1."""
        out = np.full(len(hashes), -1, np.int64)
        likely = np.flatnonzero(self.maybe[(hashes >> U64(44)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.keys, hashes[likely]), len(self.keys) - 1)
        hit = self.keys[at] == hashes[likely]
        out[likely[hit]] = self.key_ids[at[hit]]
        return out

    def viterbi(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts) of words of one length, a row each, whose characters are all known."""
        n, length = chars.shape
        up, down = _powers(max(64, 1 << (length - 1).bit_length()))
        sums = np.zeros((length + 1, n), U64)
        np.cumsum((_value(chars) * up[:length]).T, axis=0, out=sums[1:])
        last = np.full((length + 1, n), -1, np.int64)
        back = np.zeros((length + 1, n), np.int8)
        last[0] = self.start
        for end in range(1, length + 1):
            for size in range(1, min(end, self.longest) + 1):
                begin = end - size
                piece = self._lookup((sums[end] - sums[begin]) * down[begin])
                open_ = np.flatnonzero((piece >= 0) & (last[begin] >= 0))
                if len(open_):
                    open_ = open_[self._fit(last[begin][open_], piece[open_])]
                    better = open_[back[end][open_] < size]
                    last[end][better], back[end][better] = piece[better], size
        out = np.full((n, length), -1, np.int32)
        row, at, place = np.arange(n), np.full(n, length), length - 1
        while len(row):
            out[row, place] = last[at, row]
            at = at - back[at, row]
            row, at, place = row[at > 0], at[at > 0], place - 1
        full = out >= 0
        return out[full], full.sum(1)

    def _units(self, chars: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where the words of the texts start; an unknown character is a word of its own."""
        known, blank = self.known[chars], chars == BLANK
        start = ~known
        start[1:] |= ~known[:-1] | (blank[1:] & ~blank[:-1])
        start[offsets[:-1][np.diff(offsets) > 0]] = True
        return np.flatnonzero(start)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of each text, one text after another."""
        blank = chr(BLANK)
        texts = [blank + t.replace(" ", blank) if t else "" for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
        if not len(chars):
            return np.empty(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        starts = self._units(chars, offsets)
        ends = np.append(starts[1:], len(chars))
        values = _value(chars)
        names = tb.sequence_hashes(values, starts, ends)
        unique, first, inverse = np.unique(names, return_index=True, return_inverse=True)
        if len(self.words) > REMEMBERED:
            self.forget()
        at = np.minimum(np.searchsorted(self.words, unique), max(len(self.words) - 1, 0))
        new = self.words[at] != unique if len(self.words) else np.ones(len(unique), bool)
        if new.any():
            self._learn(chars, starts[first[new]], ends[first[new]], unique[new])
            at = np.searchsorted(self.words, unique)
        slot = self.slots[at][inverse]
        sizes = self.begins[slot + 1] - self.begins[slot]
        done = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.flat[np.repeat(self.begins[slot] - done[:-1], sizes) + np.arange(done[-1])]
        return ids, done[np.searchsorted(starts, offsets)]

    def _learn(self, chars, starts, ends, names) -> None:
        sizes = ends - starts
        flat, counts, order = [], [], []
        strange = ~self.known[chars[starts]]
        for k in np.flatnonzero(strange).tolist():
            raw = chr(chars[starts[k]]).encode("utf-8")
            flat.append(np.array([self.byte[b] for b in raw], np.int32))
            counts.append(np.array([len(raw)]))
            order.append(np.array([k]))
        for size in np.unique(sizes[~strange]).tolist():
            rows = np.flatnonzero(~strange & (sizes == size))
            step = max(1, TOGETHER * 8 // size)
            for part in (rows[i : i + step] for i in range(0, len(rows), step)):
                ids, n = self.viterbi(chars[starts[part][:, None] + np.arange(size)])
                flat.append(ids)
                counts.append(n)
                order.append(part)
        order, counts = np.concatenate(order), np.concatenate(counts)
        base = len(self.begins) - 1
        self.flat = np.concatenate([self.flat, *flat])
        self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(counts)])
        words = np.concatenate([self.words, names[order]])
        slots = np.concatenate([self.slots, base + np.arange(len(order))])
        by_name = np.argsort(words)
        self.words, self.slots = words[by_name], slots[by_name]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of runs of ids; bytes that make no character become U+FFFD."""
        sizes = self.raw_sizes[ids]
        done = np.concatenate([[0], np.cumsum(sizes)])
        raw = self.raw_bytes[np.repeat(self.raw_starts[ids] - done[:-1], sizes) + np.arange(done[-1])].tobytes()
        ends = done[offsets].tolist()
        texts = (raw[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:], strict=False))
        return [t[1:] if t.startswith(" ") else t for t in texts]


@cache
def pieces(path: str) -> Pieces:
    """The vocabulary of this worker."""
    return Pieces(path)


def encode(documents: DataFrame, model: str, *keep: str, ids: str = "ids") -> DataFrame:
    """The ``keep`` columns and the ids of each row's text, in a column named ``ids``.

    Columns pass the workers under numbers, so they may have any name.
    """
    named = [c.alias(f"c{k}") for k, c in enumerate(quoted(keep))]
    rows = documents.select(*named, F.col("text").cast("string").alias("whole"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tb.sliced(batches, "whole"):
            texts = [t or "" for t in batch.column("whole").to_pylist()]
            found, offsets = pieces(model).encode(texts)
            listed = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(found))
            names = [f"c{k}" for k in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), listed], [*names, "ids"])

    schema = rows.drop("whole").schema.add("ids", T.ArrayType(T.IntegerType()))
    return rows.mapInArrow(run, schema).toDF(*keep, ids)


def decode(rows: DataFrame, model: str, *keep: str) -> DataFrame:
    """The ``keep`` columns and the text of each row's ids."""
    rows = rows.select(*keep, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, offsets = _lists(batch.column("ids"))
            texts = pa.array(pieces(model).decode(ids, offsets), pa.string())
            columns = [batch.column(c) for c in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, texts], [*keep, "text"])

    return rows.mapInArrow(run, rows.drop("ids").schema.add("text", "string"))


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([0 if v is None else v for v in column.value_lengths().to_pylist()], np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes)])


def round_trip(documents: DataFrame, model: str) -> DataFrame:
    """doc_id, ids, n_tokens, ids_crc32 and whether decoding gives the text back."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(model)
        for batch in tb.sliced(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids, offsets = own.encode(texts)
            back = own.decode(ids, offsets)
            raw, cuts = ids.astype("<u4").tobytes(), (offsets * 4).tolist()
            same = [a.replace(chr(BLANK), " ") == b for a, b in zip(texts, back, strict=True)]
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids)),
                    pa.array(np.diff(offsets)),
                    pa.array(crc, pa.int64()),
                    pa.array(same, pa.bool_()),
                ],
                ["doc_id", "ids", "n_tokens", "ids_crc32", "same"],
            )

    return rows.mapInArrow(
        run, "doc_id bigint, ids array<int>, n_tokens bigint, ids_crc32 bigint, same boolean"
    )
