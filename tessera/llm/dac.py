"""Token ids as directly addressable codes.

An id is cut into chunks of 8 bits. Level 0 holds the lowest chunk of every id, level k the next chunk of those ids that
go on beyond level k - 1. A bitmap of each level marks the ids that go on, and a rank directory holds the number of marks
before every 512th bit, so the i-th id of a file is read with one lookup a level: no block is decoded for it.

A file is one self-contained run of bytes: a header, the documents' ids and first tokens, then the levels. Files lie as
binary values in a Parquet table in ascending doc_id order, so they are written and committed by Spark on any store it
can reach, and a lost executor's files are written again. `write` gives each document its end id, `read` decodes.

Defined cases: null and empty texts are documents of the end id alone; ties of doc_id follow the order of their texts;
null doc_ids come first; an empty table gives no file rows and an empty result; other columns are not read."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.common import shared_dir
from tessera.llm.tokens import run_encoder

MAGIC = b"TDAC0001"
CHUNK_BITS, RANK_BITS = 8, 512
END_ID = 1
#: A file is closed when it has so many tokens; a longer document makes a longer file.
FILE_TOKENS = 2_000_000
NO_ID = -(2**63)


def encode(ids: np.ndarray, doc_ids: np.ndarray, doc_tokens: np.ndarray) -> bytes:
    """The bytes of one file: `ids` of all its documents, which have `doc_tokens` ids each."""
    out = [np.asarray(doc_ids, "<i8").tobytes(), np.concatenate(([0], np.cumsum(doc_tokens))).astype("<u8").tobytes()]
    rest, levels = ids.astype(np.uint64), 0
    while levels == 0 or len(rest):
        chunks = (rest & np.uint64(2**CHUNK_BITS - 1)).astype(np.uint8)
        rest = rest >> np.uint64(CHUNK_BITS)
        goes_on = rest > 0
        bitmap = np.packbits(goes_on, bitorder="little")
        bitmap = np.pad(bitmap, (0, -len(bitmap) % (RANK_BITS // 8)))
        marks = np.bitwise_count(bitmap.reshape(-1, RANK_BITS // 8)).sum(axis=1, dtype=np.uint64)
        directory = np.concatenate(([0], np.cumsum(marks)))[: len(marks)].astype("<u8")
        out += [struct.pack("<Q", len(chunks)), chunks.tobytes(), bitmap.tobytes(), directory.tobytes()]
        rest = rest[goes_on]
        levels += 1
    return MAGIC + struct.pack("<QQI", len(doc_ids), len(ids), levels) + b"".join(out)


class Reader:
    """Reads a file of `encode` in place."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        n_docs, self.n_tokens, n_levels = struct.unpack_from("<QQI", data, 8)
        at = 28
        self.doc_ids = np.frombuffer(data, "<i8", n_docs, at)
        at += 8 * n_docs
        self.starts = np.frombuffer(data, "<u8", n_docs + 1, at).astype(np.int64)
        at += 8 * (n_docs + 1)
        self.levels = []
        for _ in range(n_levels):
            (n,) = struct.unpack_from("<Q", data, at)
            blocks = -(-n // RANK_BITS)
            chunks = np.frombuffer(data, np.uint8, n, at + 8)
            bitmap = np.frombuffer(data, np.uint8, blocks * RANK_BITS // 8, at + 8 + n)
            directory = np.frombuffer(data, "<u8", blocks, at + 8 + n + len(bitmap))
            self.levels.append((chunks, bitmap, directory))
            at += 8 + n + len(bitmap) + 8 * blocks

    def __len__(self) -> int:
        return self.n_tokens

    def __getitem__(self, i: int) -> int:
        """The i-th id, from one chunk and one rank a level."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value = 0
        for level, (chunks, bitmap, directory) in enumerate(self.levels):
            value |= int(chunks[i]) << (CHUNK_BITS * level)
            byte, bit = divmod(i, 8)
            if not bitmap[byte] >> bit & 1:
                break
            first = i // RANK_BITS * (RANK_BITS // 8)
            before = int(np.bitwise_count(bitmap[first:byte]).sum(dtype=np.int64)) + (int(bitmap[byte]) & ((1 << bit) - 1)).bit_count()
            i = int(directory[i // RANK_BITS]) + before
        return value

    def document(self, d: int) -> np.ndarray:
        """The ids of the d-th document, by direct access."""
        return np.array([self[i] for i in range(self.starts[d], self.starts[d + 1])], np.uint32)

    def all(self) -> np.ndarray:
        """Every id, level by level."""
        out = np.zeros(self.n_tokens, np.uint32)
        at = np.arange(self.n_tokens)
        for level, (chunks, bitmap, _) in enumerate(self.levels):
            out[at] |= chunks.astype(np.uint32) << np.uint32(CHUNK_BITS * level)
            at = at[np.unpackbits(bitmap, count=len(chunks), bitorder="little").view(bool)]
        return out


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode every whole text of `docs` (doc_id, text) and write the files to `path` in ascending doc_id order."""

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth = TaskContext.get().partitionId(), 0
        encoder, end = run_encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        doc_ids: list[int] = []
        held: list[bytes] = []
        tokens = 0

        def close() -> pa.RecordBatch:
            sizes = np.array([len(x) // 4 for x in held], np.int64)
            data = encode(np.frombuffer(b"".join(held), "<u4"), np.array(doc_ids, np.int64), sizes)
            row = {"part": [part], "nth": [nth], "n_docs": [len(doc_ids)], "n_tokens": [int(sizes.sum())], "codes": [data]}
            return pa.RecordBatch.from_pydict(row, pa.schema([("part", pa.int64()), ("nth", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("codes", pa.binary())]))

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for at in range(0, len(ids), 1024):
                texts = [t or b"" for t in batch.column("text").slice(at, 1024).cast(pa.binary()).to_pylist()]
                for doc_id, packed in zip(ids[at : at + 1024], encoder.packed(texts), strict=True):
                    doc_ids.append(NO_ID if doc_id is None else doc_id)
                    held.append(packed + end)
                    tokens += len(held[-1]) // 4
                    if tokens >= FILE_TOKENS:
                        yield close()
                        doc_ids, held, tokens, nth = [], [], 0, nth + 1
        if held:
            yield close()

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(files, "part long, nth long, n_docs long, n_tokens long, codes binary").write.option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids (array) of every document in the files; start counts the ids of all documents before it."""
    return _located(spark, path, "ids array<long>", lambda ids, cuts: pa.array([x.tolist() for x in np.split(ids, cuts[1:-1])], pa.list_(pa.int64())))


def digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""
    crc = lambda ids, cuts: pa.array([zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.int64())
    return _located(spark, path, "ids_crc32 long", crc)


def _located(spark: SparkSession, path: str, column: str, make) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, nth, codes in zip(*(batch.column(c).to_pylist() for c in ("part", "nth", "codes")), strict=True):
                file = Reader(codes)
                n = len(file.doc_ids)
                doc_ids = pa.array(file.doc_ids, mask=file.doc_ids == NO_ID)
                arrays = [pa.array([part] * n, pa.int64()), pa.array([nth] * n, pa.int64()), doc_ids, pa.array(file.starts[:-1]), pa.array(np.diff(file.starts)), make(file.all(), file.starts)]
                yield pa.RecordBatch.from_arrays(arrays, names=["part", "nth", "doc_id", "inside", "n_tokens", column.split()[0]])

    files = spark.read.parquet(path)
    decoded = files.select("part", "nth", "codes").mapInArrow(run, f"part long, nth long, doc_id long, inside long, n_tokens long, {column}")
    # offsets of files: first within a part, then of parts, of which there are no more than partitions were written
    sizes = files.select("part", "nth", "n_tokens")
    before = F.sum("n_tokens").over(W.partitionBy("part").orderBy("nth").rowsBetween(W.unboundedPreceding, -1))
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    part_start = F.sum("n_tokens").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    offsets = (
        sizes.select("part", "nth", F.coalesce(before, F.lit(0)).alias("in_part"))
        .join(parts.select("part", F.coalesce(part_start, F.lit(0)).alias("part_start")), "part")
        .select("part", "nth", (F.col("in_part") + F.col("part_start")).alias("offset"))
    )
    return decoded.join(offsets, ["part", "nth"]).select("doc_id", (F.col("offset") + F.col("inside")).alias("start"), "n_tokens", column.split()[0])


def scratch_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tessera/dac-{uuid.uuid4().hex}"
