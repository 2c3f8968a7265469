"""Token files, pieces, words and hashes against the libraries and plain Python."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from martkeeper.llm import sentence_pieces, textbytes, token_files
from martkeeper.llm.word_codes import WordCodes

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "\n\n", "\u2581", "ΑΣ Σ.", "İstanbul", "don't it's 'tis", "e\u0301a A\u030a ﬁ", "<|endoftext|>x", "a|b || |",
    "\u00a0x\u2003y\x1cz", "² ½ Ⅷ a1b2", "日本語。", "\x00 a\x00", "👍🏽 a\u200db", "<s> <unk> <0x41>", "=" * 300, " " * 90, "x" * 5000,
]


def texts():
    rng = random.Random(1)
    bits = ["the", "ing", " ", "  ", "\n", "é", "ß", "日", "1", ".", ",", "==", "/", "Ω", "tion", "A", "'s", "\t", "\U0001f600"]
    return ODD + ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 60))) for _ in range(600)]


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string, Text_2 string").drop("Text_2")


def test_words_are_coded_as_whole_texts():
    coder, whole = WordCodes(WORDS), Tokenizer.from_file(WORDS)
    own = coder.encode([t.encode() for t in texts()])
    expected = [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts()]
    assert own == expected


def test_pieces_are_those_of_the_library():
    library, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), sentence_pieces.Pieces(PIECES)
    for _ in range(2):  # the second time from memory
        ids, offsets = own.encode(texts())
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == library.encode(texts())
    assert own.decode(ids, offsets) == library.decode(library.encode(texts()))
    broken = np.array([3 + 0xC3, 3 + 0x41, 0, 1, 2], np.int32)
    assert own.decode(broken, np.array([0, 5])) == [library.decode(broken.tolist())]


def test_a_pair_of_pieces_fits_only_as_the_library_keeps_it():
    library, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), sentence_pieces.Pieces(PIECES)
    text = "▁the" + "rein" * 40
    ids, _ = own.viterbi(np.array([[ord(c) for c in text]]))
    assert ids.tolist() == library.encode("the" + "rein" * 40)


def test_round_trip_over_rows(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts()[:60])] + [(None, None, "x"), (3, "twice", "x"), (3, "twice", "x")]
    done = sentence_pieces.round_trip(documents(spark, rows), PIECES).collect()
    assert len(done) == 63 and all(r.same for r in done)
    encoded = sentence_pieces.encode(documents(spark, rows), PIECES, "doc_id")
    back = sentence_pieces.decode(encoded, PIECES, "doc_id")
    assert {r.text for r in back.filter("doc_id = 3").collect()} == {texts()[3].replace("\u2581", " "), "twice"}
    assert sentence_pieces.round_trip(documents(spark, []), PIECES).count() == 0


@pytest.mark.parametrize("high", [1, 200, 40_000, 2**31])
def test_any_token_of_a_file_is_read_directly(high):
    rng = np.random.default_rng(high)
    lengths = np.array([0, 1, 700, 0, 513, 2000])
    ids = rng.integers(0, high, lengths.sum()).astype("<u4")
    file = token_files.TokenFile(token_files.pack([None, 4, 5, 5, 6, 7], lengths, ids))
    assert file.doc_ids == [None, 4, 5, 5, 6, 7]
    assert [file.token(i) for i in range(len(ids))] == ids.tolist()
    assert np.array_equal(np.concatenate([file.document(i) for i in range(6)]), ids)


def test_token_files_hold_all_rows_in_order(spark, tmp_path):
    rows = [(i % 40, t, "x") for i, t in enumerate(texts())] + [(None, None, "x"), (7, None, "x")]
    df = documents(spark, rows).repartition(5)
    listing = token_files.write_tokens(df, f"{tmp_path}/files", WORDS)
    read = sorted(token_files.read_tokens(listing, f"{tmp_path}/files").collect(), key=lambda r: r.start)
    whole, start = Tokenizer.from_file(WORDS), 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    assert len(read) == len(order)
    for row, (doc_id, text, _) in zip(read, order, strict=True):
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc_id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    none = token_files.write_tokens(documents(spark, []), f"{tmp_path}/none", WORDS)
    assert token_files.read_tokens(none, f"{tmp_path}/none").count() == 0


def test_spans_and_hashes_follow_the_words(monkeypatch):
    monkeypatch.setattr(textbytes, "CHUNK", 64)
    textbytes._powers.cache_clear()
    try:
        all_texts = [*texts(), None, "end"]
        data, offsets = textbytes.buffers(pa.array(all_texts).slice(2))
        starts, ends, rows = textbytes.spans(data, offsets)
        raw = data.tobytes()
        got = [(int(r), raw[a:b]) for a, b, r in zip(starts, ends, rows, strict=True)]
        assert got == [(i, w) for i, t in enumerate(all_texts[2:]) for w in (t or "").encode().split()]
        hashes = textbytes.span_hashes(data, starts, ends, False)
        by_word = {}
        for (_, word), value in zip(got, hashes.tolist(), strict=True):
            assert by_word.setdefault(word, value) == value
        assert len(set(by_word.values())) == len(by_word)
        lower = textbytes.span_hashes(np.frombuffer(b"AbC abc", np.uint8), np.array([0, 4]), np.array([3, 7]), True)
        assert lower[0] == lower[1]
    finally:
        textbytes._powers.cache_clear()


def test_slices_cover_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (0, 3 << 20, 5, 1 << 20, 1 << 20, 1 << 20)] + [None]})
    parts = list(textbytes.sliced([batch, batch.slice(0, 0)]))
    assert sum(p.num_rows for p in parts) == 7 and len(parts) > 1
