"""Packing of documents into fixed-length token sequences along a space-filling curve.

1. Each document is encoded once; its token counts, hashed into a vector, are projected to four
   dimensions, and the place of that point on a Hilbert curve is the document's key. The compressed
   ids and the key are written to the shared folder.
2. The rows are range-partitioned and sorted by (key, doc_id, row), so neighbours on the curve, that
   is documents of like content, stand next to each other.
3. Each partition is filled into sequences from its first row to its last. Documents are cut at
   sequence ends. What is left at a partition's end becomes sequences of power-of-two lengths, which
   need no padding.

A partition holds its current sequence and one Arrow batch. Equal keys (copies) are told apart by id
and row, so a large group of copies is spread over partitions like any other rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Workspace, bounded_chunks, partitions_for
from ledgerloom.llm.tokens import encoder

SEQUENCE_TOKENS = 2048
END_ID = 1
DIMENSIONS = 4
BITS = 15
BUCKETS = 1024
_REACH = 4.0
_ROWS = 200
_CHARS = 1 << 23  # of texts that are encoded at once
_CACHED = 690_000  # pieces kept by a worker; a dict takes twice the room from 699,051 entries on
_SEQUENCES_PER_PARTITION = 1 << 40


def _projection() -> np.ndarray:
    return np.random.default_rng(20).standard_normal((BUCKETS, DIMENSIONS))


def document_points(blobs: list[bytes], projection: np.ndarray) -> np.ndarray:
    """The hashed, damped, length-normalised token counts of each document, projected to a few dimensions."""
    row = np.repeat(np.arange(len(blobs)), [len(data) // 4 for data in blobs])
    ids = np.frombuffer(b"".join(blobs), "<u4")
    buckets = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(54)
    cells = np.bincount(row * BUCKETS + buckets.astype(np.int64), minlength=len(blobs) * BUCKETS)
    weights = np.log1p(cells).reshape(-1, BUCKETS)
    norms = np.sqrt((weights * weights).sum(axis=1, keepdims=True))
    return (weights / np.where(norms > 0, norms, 1.0)) @ projection


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each point (rows, coordinates 0 to 2**bits - 1) on a Hilbert curve.

    Gray-code form: from the highest bit down the lower bits of each axis are inverted or exchanged
    with the first axis, then the axes' bits are undone by a running exclusive-or and interleaved.
    """
    x = points.astype(np.uint64).T.copy()
    n = len(x)
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        q = one << np.uint64(level)
        low = q - one
        for axis in range(n):
            high = (x[axis] & q) != 0
            swap = (x[0] ^ x[axis]) & low
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            if axis:
                x[axis] = np.where(high, x[axis], x[axis] ^ swap)
    for axis in range(1, n):
        x[axis] ^= x[axis - 1]
    undo = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        q = one << np.uint64(level)
        undo = np.where((x[n - 1] & q) != 0, undo ^ (q - one), undo)
    x ^= undo
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in range(n):
            key = (key << one) | ((x[axis] >> np.uint64(level)) & one)
    return key.astype(np.int64)


def curve_key(points: np.ndarray) -> np.ndarray:
    cells = np.clip((points + _REACH) / (2 * _REACH), 0, 1) * (2**BITS - 1)
    return hilbert_keys(cells.astype(np.int64))


def encoded_documents(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, n_tokens, curve_key, ids (zstandard frame of little-endian unsigned 32-bit ids)."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of, projection = encoder(tokenizer_path, _CACHED), _projection()
        end = end_id.to_bytes(4, "little")
        press = zstandard.ZstdCompressor(level=1, write_content_size=True)
        for batch in batches:
            doc_ids = batch["doc_id"].to_numpy()
            for first, texts in bounded_chunks([text or "" for text in batch["text"]], _CHARS):
                encoded = [data + end for data in ids_of.encode_many(texts)]
                for low in range(0, len(texts), _ROWS):
                    blobs = encoded[low : low + _ROWS]
                    # A few at a time, so that a very long text is not joined with many others.
                    points = [document_points(chunk, projection) for _, chunk in bounded_chunks(blobs)]
                    yield pd.DataFrame(
                        {
                            "doc_id": doc_ids[first + low : first + low + len(blobs)],
                            "n_tokens": [len(data) // 4 for data in blobs],
                            "curve_key": curve_key(np.concatenate(points)),
                            "ids": [press.compress(data) for data in blobs],
                        }
                    )

    # Ids travel as text: pandas rounds whole numbers beside a null.
    encoded = docs.select(F.col("doc_id").cast("string"), "text").mapInPandas(
        encode, "doc_id string, n_tokens long, curve_key long, ids binary"
    )
    return encoded.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def _powers(length: int) -> list[int]:
    return [1 << bit for bit in range(length.bit_length() - 1, -1, -1) if length >> bit & 1]


def pack(docs: DataFrame, tokenizer_path: str, sequence_tokens: int = SEQUENCE_TOKENS, end_id: int = END_ID) -> DataFrame:
    """One row per piece of a document in a sequence, with the piece's ids.

    docs: doc_id, text; other columns are ignored. Null or empty text is the end id alone. Rows with
    equal or null doc_id are packed as rows of their own. An empty table gives no rows.
    Result: doc_id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset. Sequence ids are
    unique and ascend along the curve, with gaps between partitions.
    """
    space = Workspace(docs.sparkSession, "packing")
    rows = encoded_documents(docs, tokenizer_path, end_id).withColumn("row", F.monotonically_increasing_id())
    rows = space.store(rows, "encoded")
    ordered = rows.repartitionByRange(partitions_for(docs), "curve_key", "doc_id", "row").sortWithinPartitions(
        "curve_key", "doc_id", "row"
    )

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        next_id = TaskContext.get().partitionId() * _SEQUENCES_PER_PARTITION
        open_pieces: list[tuple] = []  # of the current sequence: doc_id, start, ids, doc_tokens
        used = 0
        unpack = zstandard.ZstdDecompressor()

        def rows_of(pieces: list[tuple], sequence: int) -> list[tuple]:
            place, out = 0, []
            for doc_id, start, ids, total in pieces:
                out.append((doc_id, start, len(ids) // 4, ids, zlib.crc32(ids), total, sequence, place))
                place += len(ids) // 4
            return out

        def frame(out: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(out, columns=["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            out: list[tuple] = []
            for doc_id, total, blob in zip(batch["doc_id"], batch["n_tokens"], batch["ids"], strict=True):
                data, start = unpack.decompress(blob), 0
                while start < total:
                    length = min(total - start, sequence_tokens - used)
                    open_pieces.append((doc_id, start, data[4 * start : 4 * (start + length)], total))
                    start += length
                    used += length
                    if used == sequence_tokens:
                        out += rows_of(open_pieces, next_id)
                        open_pieces, used, next_id = [], 0, next_id + 1
                        if len(out) >= 2000:
                            yield frame(out)
                            out = []
            if out:
                yield frame(out)
        out = []
        for length in _powers(used):
            pieces, room = [], length
            while room:
                doc_id, start, ids, total = open_pieces.pop(0)
                taken = min(room, len(ids) // 4)
                pieces.append((doc_id, start, ids[: 4 * taken], total))
                room -= taken
                if taken < len(ids) // 4:
                    open_pieces.insert(0, (doc_id, start + taken, ids[4 * taken :], total))
            out += rows_of(pieces, next_id)
            next_id += 1
        if out:
            yield frame(out)

    packed = ordered.select(F.col("doc_id").cast("string"), "n_tokens", "ids").mapInPandas(
        fill,
        "doc_id string, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
    return packed.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
