"""Token ids in binary files of independent zstandard frames with a trailing seek table.

A file is a run of zstandard frames and one skippable frame, the seek table in the public "seekable"
layout: per frame its compressed size, its size and a 32-bit checksum of its content, then the number
of frames, a flag byte and a magic number. Each frame also ends with zstandard's own checksum. Any
zstandard tool can read a file from the front; a reader that wants some documents reads the table at
the end and decompresses only their frames.

A frame's content: number of documents, then per document its id (signed 64 bit), a flag for a null
id and its number of tokens, then all their ids (unsigned 32 bit); little-endian throughout.

Documents are range-partitioned by doc_id, one file a partition, and files are named with a random
part: of several attempts at a task only the one whose rows Spark commits is in the table of frames,
so lost executors leave unlisted files and no wrong results.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import partitions_for
from ledgerloom.llm.tokens import encoder

END_ID = 1
FRAME_BYTES = 1 << 20

# Fixed values of the seekable layout.
_SKIPPABLE, _SEEKABLE, _WITH_CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80

_HEAD = np.dtype([("doc_id", "<i8"), ("is_null", "u1"), ("n_tokens", "<u4")])


def _open_folder(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder)


class FrameWriter:
    """Writes documents to one stream, frame by frame."""

    def __init__(self, stream):
        self._stream = stream
        self._press = zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)
        self._table: list[tuple[int, int, int]] = []
        self._heads: list[tuple[int, bool, int]] = []
        self._ids: list[bytes] = []
        self._size = 0
        self.frames: list[tuple] = []  # frame, first_doc_id, last_doc_id, n_docs, n_tokens

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self._heads.append((doc_id or 0, doc_id is None, len(ids) // 4))
        self._ids.append(ids)
        self._size += len(ids)
        if self._size >= FRAME_BYTES:
            self._end_frame()

    def _end_frame(self) -> None:
        content = struct.pack("<I", len(self._heads)) + np.array(self._heads, _HEAD).tobytes() + b"".join(self._ids)
        frame = self._press.compress(content)
        self._stream.write(frame)
        known = [h[0] for h in self._heads if not h[1]]
        self.frames.append(
            (len(self._table), known[0] if known else None, known[-1] if known else None, len(self._heads), self._size // 4)
        )
        self._table.append((len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        self._heads, self._ids, self._size = [], [], 0

    def close(self) -> None:
        if self._heads:
            self._end_frame()
        entries = b"".join(struct.pack("<III", *entry) for entry in self._table)
        foot = struct.pack("<IBI", len(self._table), _WITH_CHECKSUMS, _SEEKABLE)
        self._stream.write(struct.pack("<II", _SKIPPABLE, len(entries) + len(foot)) + entries + foot)


class FrameReader:
    """Reads single frames of a file by its seek table; a wrong checksum is an error."""

    def __init__(self, file):
        self._file = file
        self._unpack = zstandard.ZstdDecompressor()
        size = file.size()
        file.seek(size - 9)
        count, flags, magic = struct.unpack("<IBI", file.read(9))
        if magic != _SEEKABLE or flags != _WITH_CHECKSUMS:
            raise ValueError("not a seekable file with checksums")
        file.seek(size - 9 - 12 * count)
        self._table = np.frombuffer(file.read(12 * count), "<u4").reshape(-1, 3).astype(np.int64)
        self._places = np.concatenate(([0], np.cumsum(self._table[:, 0])))

    def __len__(self) -> int:
        return len(self._table)

    def frame(self, k: int) -> Iterator[tuple[int | None, bytes]]:
        """doc_id and ids of each document in a frame."""
        self._file.seek(int(self._places[k]))
        content = self._unpack.decompress(self._file.read(int(self._table[k, 0])))
        if len(content) != self._table[k, 1] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self._table[k, 2]:
            raise ValueError(f"frame {k} does not match its checksum")
        (count,) = struct.unpack_from("<I", content)
        heads = np.frombuffer(content, _HEAD, count, 4)
        place = 4 + heads.nbytes
        for doc_id, is_null, n_tokens in heads.tolist():
            yield (None if is_null else doc_id), content[place : place + 4 * n_tokens]
            place += 4 * n_tokens


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Encode and write all documents in ascending doc_id order below ``folder``; returns the table of frames.

    docs: doc_id (integer), text; other columns are ignored. Null text counts as empty: the end id
    alone. Null ids come first; rows with equal ids are kept, in the order of their texts. An empty
    table gives no file. Result, also written to ``folder``/frames: shard, name, frame, first_doc_id,
    last_doc_id, n_docs, n_tokens.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    tie = F.xxhash64("text")
    rows = rows.withColumn("tie", tie).repartitionByRange(partitions_for(docs), "doc_id", "tie")
    rows = rows.sortWithinPartitions("doc_id", "tie", "text")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = TaskContext.get().partitionId()
        ids_of, end = encoder(tokenizer_path), end_id.to_bytes(4, "little")
        writer = stream = None
        name = f"tokens-{shard:06d}-{uuid.uuid4().hex}.zst"
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                if writer is None:
                    files, place = _open_folder(f"{folder}/files")
                    files.create_dir(place, recursive=True)
                    stream = files.open_output_stream(f"{place}/{name}", compression=None)
                    writer = FrameWriter(stream)
                writer.add(None if pd.isna(doc_id) else int(doc_id), ids_of.encode_bytes(text) + end)
        if writer is None:
            return
        writer.close()
        stream.close()
        out = pd.DataFrame(writer.frames, columns=["frame", "first_doc_id", "last_doc_id", "n_docs", "n_tokens"])
        for column, name_at in (("first_doc_id", 1), ("last_doc_id", 2)):
            out[column] = pd.array([entry[name_at] for entry in writer.frames], dtype="Int64")  # whole beside a null
        yield out.assign(shard=shard, name=name)[["shard", "name", "frame", "first_doc_id", "last_doc_id", "n_docs", "n_tokens"]]

    # Ids travel as text: pandas rounds whole numbers beside a null.
    frames = rows.select(F.col("doc_id").cast("string"), "text").mapInPandas(
        write, "shard int, name string, frame int, first_doc_id long, last_doc_id long, n_docs long, n_tokens long"
    )
    frames.write.mode("overwrite").parquet(f"{folder}/frames")
    return token_frames(docs.sparkSession, folder)


def token_frames(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/frames")


def read_token_files(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, ids of every document, or of the few asked for.

    ``start`` counts the ids of all documents before. Only frames that may hold a wanted id are read
    and decompressed; the list of wanted ids is the caller's and goes to every task.
    """
    frames = token_frames(spark, folder)
    shards = frames.groupBy("shard").agg(F.sum("n_tokens").alias("tokens"))
    before = F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = shards.select("shard", F.coalesce(before, F.lit(0)).alias("shard_start"))
    in_shard = Window.partitionBy("shard").orderBy("frame").rowsBetween(Window.unboundedPreceding, -1)
    frames = frames.withColumn("start", F.coalesce(F.sum("n_tokens").over(in_shard), F.lit(0))).join(shards, "shard")
    frames = frames.select("name", "frame", "first_doc_id", "last_doc_id", (F.col("start") + F.col("shard_start")).alias("start"))
    wanted = None if doc_ids is None else sorted(set(doc_ids))
    if wanted is not None:
        hit = F.lit(False)
        for doc_id in wanted:
            hit = hit | F.lit(doc_id).between(F.col("first_doc_id"), F.col("last_doc_id"))
        frames = frames.where(hit)
    keep = None if wanted is None else frozenset(wanted)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, place = _open_folder(f"{folder}/files")
        open_name, reader, file = None, None, None
        for batch in batches:
            for name, frame, start in zip(batch["name"], batch["frame"], batch["start"], strict=True):
                if name != open_name:
                    if file is not None:
                        file.close()
                    file = files.open_input_file(f"{place}/{name}")
                    open_name, reader = name, FrameReader(file)
                out = []
                for doc_id, ids in reader.frame(frame):
                    if keep is None or doc_id in keep:
                        out.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), ids))
                    start += len(ids) // 4
                if out:
                    got = pd.DataFrame(out, columns=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])
                    yield got.assign(doc_id=pd.array([row[0] for row in out], dtype="Int64"))
        if file is not None:
            file.close()

    frames = frames.repartition(partitions_for(frames), "name").sortWithinPartitions("name", "frame")
    return frames.select("name", "frame", "start").mapInPandas(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"
    )
