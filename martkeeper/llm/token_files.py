"""Token files with directly addressable codes.

An id is cut into chunks of eight bits. Level 0 holds the lowest chunk of every id; a bitmap tells
which ids go on, and those have their next chunk in level 1, and so on. The place of an id in the
next level is the number of set bits before it, which a rank directory (a running count for every
512 bits) and a popcount of at most 64 bytes give, so any id is read without decoding others.

A file holds whole documents in ascending order of doc_id: a header of little-endian unsigned 64-bit
words (magic, documents, tokens, levels, length of each level), the doc_ids (with one byte each that
tells whether there is one), the documents' token offsets, and for each level its chunks, bitmap and
directory. Files follow each other in the order of their names.

Documents come in ascending doc_id, NULL first, equal ids by text; every row is written. A NULL or
empty text has the end id only. Texts are encoded whole.
"""

from __future__ import annotations

import posixpath
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martkeeper.llm import textbytes as tb
from martkeeper.llm.common import work_folder, written
from martkeeper.llm.word_codes import word_codes

MAGIC = int.from_bytes(b"DACIDS01", "little")
BLOCK = 512
END_ID = 2
TOKENS_PER_FILE = 4_000_000
ENCODE_BYTES = 4 << 20


def pack(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of a file: documents with ``lengths`` tokens each, whose ids follow each other."""
    levels = []
    rest = ids.astype("<u4")
    while True:
        chunks, rest = rest.astype(np.uint8), rest >> 8
        more = rest > 0
        levels.append((chunks, more))
        rest = rest[more]
        if not len(rest):
            break
    known = np.array([d is not None for d in doc_ids], np.uint8)
    out = [
        np.array([MAGIC, len(doc_ids), len(ids), len(levels), *[len(c) for c, _ in levels]], "<u8"),
        np.array([d or 0 for d in doc_ids], "<i8"),
        known,
        np.concatenate([[0], np.cumsum(lengths)]).astype("<u8"),
    ]
    for chunks, more in levels:
        bits = np.packbits(more, bitorder="little")
        blocks = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype="<u8") if len(more) else []
        out += [chunks, bits, np.concatenate([[0], np.cumsum(blocks)]).astype("<u8")]
    return b"".join(part.tobytes() for part in out)


class TokenFile:
    """Reads a packed file; ``token`` touches a few bytes of each level."""

    def __init__(self, raw: bytes) -> None:
        self.raw, self.at = raw, 0
        magic, docs, self.n_tokens, n_levels = (int(x) for x in self._take("<u8", 4))
        if magic != MAGIC:
            raise ValueError("not a token file")
        sizes = [int(n) for n in self._take("<u8", n_levels)]
        ids, known = self._take("<i8", docs), self._take("u1", docs)
        self.doc_ids = [int(d) if k else None for d, k in zip(ids, known, strict=True)]
        self.offsets = self._take("<u8", docs + 1).astype(np.int64)
        self.levels = [
            (self._take("u1", n), self._take("u1", -(-n // 8)), self._take("<u8", -(-n // BLOCK) + 1))
            for n in sizes
        ]

    def _take(self, kind: str, count: int) -> np.ndarray:
        part = np.frombuffer(self.raw, kind, count, self.at)
        self.at += part.nbytes
        return part

    def token(self, at: int) -> int:
        """The id at a place of the file."""
        value = 0
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            value |= int(chunks[at]) << (8 * k)
            if not bits[at >> 3] >> (at & 7) & 1:
                break
            block, upto = at // BLOCK, bits[at // BLOCK * (BLOCK // 8) : (at >> 3) + 1].copy()
            upto[-1] &= (1 << (at & 7)) - 1
            at = int(ranks[block]) + int(np.bitwise_count(upto).sum())
        return value

    def document(self, index: int) -> np.ndarray:
        """The ids of a document, one by one through the levels' ranks."""
        return self.range(int(self.offsets[index]), int(self.offsets[index + 1]))

    def range(self, start: int, end: int) -> np.ndarray:
        """The ids of a run of places; only these are touched."""
        out = np.zeros(end - start, "<u4")
        place = np.arange(end - start)
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            out[place] |= chunks[start:end].astype("<u4") << np.uint32(8 * k)
            base = start // BLOCK * BLOCK
            more = np.unpackbits(bits[base // 8 : -(-end // 8)], bitorder="little")
            first = int(ranks[base // BLOCK]) + int(more[: start - base].sum())
            more = more[start - base : end - base].astype(bool)
            place, start, end = place[more], first, first + int(more.sum())
            if not len(place):
                break
        return out


def store(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder that driver and executors share."""
    if "://" not in folder:
        return pafs.LocalFileSystem(), folder.removeprefix("file:")
    return pafs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme under which Spark finds it; a path alone is on ``fs.defaultFS``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


WRITTEN = "part int, number int, file string, n_docs bigint, n_tokens bigint"


def write_tokens(
    documents: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = END_ID,
    partitions: int | None = None,
) -> DataFrame:
    """Encode ``documents`` (doc_id, text) into files in ``folder``; returns the list of files.

    The rows are dealt by ranges of doc_id, so a part's files hold a run of documents. A file is
    written under a name of its own attempt and then moved, so a repeated task replaces it.
    """
    spark = documents.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = store(folder)
        files.create_dir(root, recursive=True)
        part, coder = TaskContext.get().partitionId(), word_codes(tokenizer)
        done, doc_ids, codes, sizes, tokens = [], [], [], [], 0

        def flush() -> None:
            lengths = np.concatenate(sizes)
            raw = pack(doc_ids, lengths, np.concatenate(codes))
            name = f"tokens-{part:06d}-{len(done):06d}.dac"
            attempt = posixpath.join(root, f".{name}.{uuid.uuid4().hex}")
            with files.open_output_stream(attempt) as out:
                out.write(raw)
            files.move(attempt, posixpath.join(root, name))
            done.append((part, len(done), name, len(doc_ids), int(lengths.sum())))

        for batch in tb.sliced(batches):
            ids, lengths = coder.ids(*tb.buffers(batch.column("text")))
            ids = np.insert(ids, np.cumsum(lengths), end_id)
            lengths = lengths + 1
            ends = np.cumsum(lengths)
            ids_of = batch.column("doc_id").to_pylist()
            first = 0
            while first < len(ids_of):
                # Up to the first document with which the file is full.
                base = int(ends[first] - lengths[first])
                to = int(np.searchsorted(ends, base + TOKENS_PER_FILE - tokens)) + 1
                to = min(to, len(ids_of))
                doc_ids += ids_of[first:to]
                codes.append(ids[base : ends[to - 1]])
                sizes.append(lengths[first:to])
                tokens += len(codes[-1])
                if tokens >= TOKENS_PER_FILE:
                    flush()
                    doc_ids, codes, sizes, tokens = [], [], [], 0
                first = to
        if doc_ids:
            flush()
        names = [f.split()[0] for f in WRITTEN.split(", ")]
        yield pa.RecordBatch.from_pylist(
            [dict(zip(names, d, strict=True)) for d in done], schema=_arrow(WRITTEN)
        )

    order = [F.asc_nulls_first("doc_id"), F.asc_nulls_first("text")]
    dealt = rows.repartitionByRange(partitions, order[0]).sortWithinPartitions(*order)
    return written(dealt.mapInArrow(write, WRITTEN), "token-files")


READ = "part int, number int, at int, doc_id bigint, offset bigint, n_tokens bigint, ids_crc32 bigint"


def read_tokens(listing: DataFrame, folder: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32, part, number, at."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with files.open_input_stream(posixpath.join(root, row["file"])) as source:
                    file = TokenFile(source.read())
                n = len(file.doc_ids)
                ids, at = file.range(0, file.n_tokens), file.offsets.tolist()
                crc = [zlib.crc32(ids[at[i] : at[i + 1]].tobytes()) for i in range(n)]
                columns = [
                    np.full(n, row["part"], np.int32), np.full(n, row["number"], np.int32),
                    np.arange(n, dtype=np.int32), pa.array(file.doc_ids, pa.int64()),
                    file.offsets[:-1], np.diff(file.offsets), np.array(crc, np.int64),
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], [f.split()[0] for f in READ.split(", ")]
                )

    # One row per file: the running sum is over the list of files, not over documents.
    order = Window.orderBy("part", "number")
    before = listing.select(
        "part", "number", (F.sum("n_tokens").over(order) - F.col("n_tokens")).alias("before")
    )
    partitions = int(listing.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = listing.select("part", "number", "file").repartition(partitions).mapInArrow(read, READ)
    return rows.join(F.broadcast(before), ["part", "number"]).select(
        "doc_id",
        (F.col("before") + F.col("offset")).cast("bigint").alias("start"),
        "n_tokens",
        "ids_crc32",
        "part",
        "number",
        "at",
    )


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in ddl.split(", "))])


def token_files(spark: SparkSession, documents: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write the documents' ids to files in the shared folder and read them back."""
    folder = qualified(spark, work_folder(spark, "tokens"))
    return read_tokens(write_tokens(documents, folder, tokenizer, end_id), folder)
