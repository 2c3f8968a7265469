"""Token ids of whole texts from the ids of their words.

A tokenizer that drops white space encodes the words of a text independently, so each distinct word
is encoded once and texts are put together from the remembered codes, which stand in flat arrays sorted
by 64-bit hashes of the words. The memory of a worker holds at most ``REMEMBERED`` words and half as
many again; it only saves time.
"""

from __future__ import annotations

import os
import unicodedata
from functools import cache

import numpy as np

from martkeeper.llm import textbytes as tb

REMEMBERED = 1_500_000
TOGETHER = 200
SEPARATOR = "|"
ENDINGS = ".,;:!?%$&#*()[]{}-=+/"
# Letters whose lower case depends on the place or the library.
UNSURE = frozenset("Σİİ")


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


class _Table:
    """Codes by hash: sorted keys, and where each one's ids are."""

    def __init__(self, keys=None, lengths=None, codes=None) -> None:
        keys = np.empty(0, np.uint64) if keys is None else keys
        order = np.argsort(keys)
        lengths = np.empty(0, np.int64) if lengths is None else lengths
        self.keys, self.lengths = keys[order], lengths[order]
        self.starts = (np.cumsum(lengths) - lengths)[order]
        self.codes = np.empty(0, "<u4") if codes is None else codes

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether a hash is there, its place)."""
        place = np.minimum(np.searchsorted(self.keys, hashes), max(len(self.keys) - 1, 0))
        return (self.keys[place] == hashes if len(self.keys) else np.zeros(len(hashes), bool)), place

    def with_rows(self, other: _Table) -> _Table:
        return _Table(
            np.concatenate([self.keys, other.keys]),
            np.concatenate([self.lengths, other.lengths]),
            np.concatenate([t.codes_of(np.arange(len(t.keys))) for t in (self, other)]),
        )

    def codes_of(self, place: np.ndarray) -> np.ndarray:
        return gathered(self.codes, self.starts[place], self.lengths[place])


class WordCodes:
    """Codes by word.

    The file's normalizer and pre-tokenizer take most of the time. A word of letters only, with or
    without punctuation at its end, needs neither: it is one run of letters, and one of punctuation.
    A second tokenizer with the file's model and a split at white space encodes these runs.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.runs = Tokenizer(self.whole.model)
        self.runs.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        self.between = self.runs.encode(SEPARATOR).ids
        self.endings: dict[str, bytes] = {"": b""}
        self.all, self.recent = _Table(), _Table()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The codes of each text as little-endian unsigned 32-bit integers, one after another."""
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
        ids, lengths = self.ids(np.frombuffer(b"".join(texts), np.uint8), offsets)
        ends = np.cumsum(lengths) * 4
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip((ends - lengths * 4).tolist(), ends.tolist(), strict=True)]

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each) of texts given by their bytes."""
        starts, ends, rows = tb.spans(data, offsets)
        hashes = tb.span_hashes(data, starts, ends, False)
        words, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        known = self.all.find(words)[0] | self.recent.find(words)[0]
        new = first[~known]
        self._learn(words[~known], [data[a:b].tobytes() for a, b in zip(starts[new], ends[new], strict=True)])
        lengths, flat = np.zeros(len(words), np.int64), []
        places = np.zeros(len(words), np.int64)
        at = 0
        for table in (self.all, self.recent):
            hit, place = table.find(words)
            place = place[hit]
            lengths[hit] = table.lengths[place]
            flat.append(table.codes_of(place))
            places[hit] = at + np.cumsum(lengths[hit]) - lengths[hit]
            at += len(flat[-1])
        ids = gathered(np.concatenate(flat), places[inverse], lengths[inverse])
        per_text = np.bincount(rows, lengths[inverse], len(offsets) - 1).astype(np.int64)
        return ids, per_text

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        """Remember the codes of new words."""
        codes = self._codes(words)
        lengths = np.array([len(c) // 4 for c in codes], np.int64)
        self.recent = self.recent.with_rows(_Table(hashes, lengths, np.frombuffer(b"".join(codes), "<u4")))
        if len(self.recent.keys) * 4 > len(self.all.keys):
            kept = self.all if len(self.all.keys) < REMEMBERED else _Table()
            self.all, self.recent = kept.with_rows(self.recent), _Table()

    def _codes(self, words: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(words)
        stemmed: list[int] = []
        stems: list[str] = []
        ends: list[str] = []
        others: list[int] = []
        texts = [word.decode() for word in words]
        for i, text in enumerate(texts):
            stem = text if text.isalpha() else text.rstrip(ENDINGS)
            if stem.isalpha() and (stem.isascii() or _plain(stem)):
                stemmed.append(i)
                stems.append(stem.lower())
                ends.append(text[len(stem) :])
            else:
                others.append(i)
        encoded = self.whole.encode_batch_fast([texts[i] for i in others], add_special_tokens=False)
        for i, encoding in zip(others, encoded, strict=True):
            out[i] = np.array(encoding.ids, "<u4").tobytes()
        unknown = [e for e in set(ends) if e not in self.endings]
        self.endings.update(zip(unknown, self._runs(unknown), strict=True))
        for i, code, end in zip(stemmed, self._runs(stems), ends, strict=True):
            out[i] = code + self.endings[end] if end else code
        return out

    def _runs(self, runs: list[str]) -> list[bytes]:
        """The codes of runs, many in one text with a sign between them whose id none of them has."""
        groups = [runs[i : i + TOGETHER] for i in range(0, len(runs), TOGETHER)]
        out: list[bytes] = []
        between = np.uint32(self.between[0])
        for encoding in self.runs.encode_batch_fast([f" {SEPARATOR} ".join(g) for g in groups]):
            ids = np.array(encoding.ids, "<u4")
            cuts = np.flatnonzero(ids == between) * 4
            raw = ids.tobytes()
            starts = [0, *(cuts + 4).tolist()]
            out += [raw[a:b] for a, b in zip(starts, [*cuts.tolist(), len(raw)], strict=True)]
        return out


def _plain(stem: str) -> bool:
    return UNSURE.isdisjoint(stem) and unicodedata.is_normalized("NFC", stem)


@cache
def word_codes(path: str) -> WordCodes:
    """The coder of this worker."""
    return WordCodes(path)
