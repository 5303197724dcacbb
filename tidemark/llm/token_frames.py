"""Token-id files: one independent zstandard frame per document.

A file is a run of zstandard frames, one per document in ascending doc_id
order, each holding the ids as little-endian unsigned 32-bit integers. Two
skippable frames follow, so any zstandard reader still decodes the whole file:

1. the id table: per frame the doc_id (signed 64-bit) and one null flag byte,
   compressed as one zstandard frame;
2. the public seek-table layout: per frame the compressed size, decompressed
   size and the low 32 bits of the content's XXH64, then the frame count, a
   descriptor byte (128: checksums present) and the seekable magic number.

A reader fetches the file's tail, finds the frames it wants and reads just
those byte ranges; a frame whose checksum differs raises.

Each Spark partition of a range partitioning by doc_id, and by the row's place
in the table among equal ids, becomes one file. A task writes under a name of its own attempt and renames at the end, so a
repeated or speculative task replaces the file with the same bytes. Counts of
documents and ids per file go to a manifest table beside the files.

Defined cases: a null text counts as empty; every document ends with the end
id; null doc_ids come first and repeated doc_ids are separate documents next
to each other, in the table's order; an empty table gives no file and an empty manifest; other
columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.byte_bpe import encoder
from tidemark.llm.common import stage, sub_batches

# Fixed values of the public seekable zstandard layout.
SKIPPABLE_SEEK = 0x184D2A5E
SKIPPABLE_IDS = 0x184D2A5D
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80

MANIFEST = "file_no int, name string, n_docs long, n_tokens long"


def filesystem(uri: str):
    """pyarrow file system and path of a shared folder (file, hdfs, s3, gs)."""
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


class FrameWriter:
    """Writes frames to an open binary stream and closes with both tables."""

    def __init__(self, out, level: int = 3):
        import zstandard

        self._out, self._zip = out, zstandard.ZstdCompressor(level=level)
        self._ids: list[int | None] = []
        self._seek: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, content: bytes) -> None:
        import xxhash

        frame = self._zip.compress(content)
        self._out.write(frame)
        self._ids.append(doc_id)
        self._seek.append((len(frame), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))

    def close(self) -> None:
        ids = np.array([x or 0 for x in self._ids], dtype="<i8").tobytes()
        ids = self._zip.compress(ids + bytes(x is None for x in self._ids))
        self._out.write(struct.pack("<II", SKIPPABLE_IDS, len(ids)) + ids)
        table = np.array(self._seek, dtype="<u4").reshape(-1, 3).tobytes()
        foot = struct.pack("<IBI", len(self._seek), CHECKSUMS, SEEKABLE_MAGIC)
        self._out.write(struct.pack("<II", SKIPPABLE_SEEK, len(table) + len(foot)) + table + foot)


class FrameReader:
    """Random access to a frame file through any seekable binary stream."""

    def __init__(self, src, size: int):
        import zstandard

        self._src, self._unzip = src, zstandard.ZstdDecompressor()
        src.seek(size - 9)
        n, flags, magic = struct.unpack("<IBI", src.read(9))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUMS:
            raise ValueError("not a token-frame file")
        src.seek(size - 9 - 12 * n - 8)
        head = struct.unpack("<II", src.read(8))
        if head != (SKIPPABLE_SEEK, 12 * n + 9):
            raise ValueError("damaged seek table")
        self.sizes = np.frombuffer(src.read(12 * n), dtype="<u4").reshape(n, 3)
        self.at = np.concatenate([[0], np.cumsum(self.sizes[:, 0], dtype=np.int64)])
        src.seek(int(self.at[-1]))
        kind, length = struct.unpack("<II", src.read(8))
        if kind != SKIPPABLE_IDS:
            raise ValueError("damaged id table")
        ids = self._unzip.decompress(src.read(length), max_output_size=9 * n + 1) if n else b""
        null = np.frombuffer(ids[8 * n:], dtype=np.uint8)
        self.doc_ids = [None if z else int(x) for x, z in zip(np.frombuffer(ids[:8 * n], "<i8"), null, strict=True)]
        self.tokens = self.sizes[:, 1].astype(np.int64) // 4

    def frame(self, k: int) -> bytes:
        """Content of frame k, read and checked by itself."""
        import xxhash

        packed, length, check = map(int, self.sizes[k])
        self._src.seek(int(self.at[k]))
        content = self._unzip.decompress(self._src.read(packed), max_output_size=max(1, length))
        if len(content) != length or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k}: checksum differs")
        return content


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2,
                      level: int = 3) -> DataFrame:
    """Encode every whole text and write the files; returns the manifest
    (file_no, name, n_docs, n_tokens), read from its written table."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ctx, enc = TaskContext.get(), encoder(tokenizer_path)
        end = struct.pack("<I", end_id)
        fs, folder = filesystem(path)
        no = ctx.partitionId()
        name = f"tokens-{no:06d}.zst"
        own = f"{folder}/_{name}.{ctx.taskAttemptId()}"
        out = writer = None
        n_docs = n_tokens = 0
        for b in sub_batches(batches):
            if out is None:
                fs.create_dir(folder, recursive=True)
                out = fs.open_output_stream(own)
                writer = FrameWriter(out, level)
            for doc_id, ids in zip(b.column(0).to_pylist(), enc.encode(b.column(1).to_pylist()), strict=True):
                writer.add(doc_id, ids + end)
                n_docs += 1
                n_tokens += len(ids) // 4 + 1
        if out is not None:
            writer.close()
            out.close()
            fs.move(own, f"{folder}/{name}")
            yield pa.RecordBatch.from_pydict({
                "file_no": pa.array([no], pa.int32()), "name": [name],
                "n_docs": pa.array([n_docs], pa.int64()), "n_tokens": pa.array([n_tokens], pa.int64())})

    # The row's place in the table ends ties: a doc_id of many rows is cut into
    # several files, and a repeated task writes the same frames.
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_row"))
    ordered = rows.repartitionByRange("doc_id", "_row").sortWithinPartitions("doc_id", "_row").drop("_row")
    return stage(ordered.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(spark: SparkSession, path: str, manifest: DataFrame,
                     doc_ids: Sequence[int] | None = None, digest: bool = False) -> DataFrame:
    """Documents of the files: doc_id, start, n_tokens and ``ids`` (binary), or
    with ``digest`` their unsigned crc32 as ``ids_crc32``. ``doc_ids``: only
    these documents' frames are fetched and decompressed; ``start`` still
    counts all ids before a document.

    The one window numbers files, not documents: a row per file.
    """
    first = F.coalesce(F.sum("n_tokens").over(
        Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.withColumn("base", first)
    wanted = None if doc_ids is None else frozenset(doc_ids)
    last = ("ids_crc32", pa.int64()) if digest else ("ids", pa.binary())
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), last])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = filesystem(path)
        for b in batches:
            for name, base in zip(b.column("name").to_pylist(), b.column("base").to_pylist(), strict=True):
                size = fs.get_file_info(f"{folder}/{name}").size
                with fs.open_input_file(f"{folder}/{name}") as src:
                    r = FrameReader(src, size)
                    starts = base + np.concatenate([[0], np.cumsum(r.tokens)[:-1]]) if len(r.tokens) else []
                    pick = [k for k, d in enumerate(r.doc_ids) if wanted is None or d in wanted]
                    for at in range(0, len(pick), 512):
                        ks = pick[at:at + 512]
                        body = [r.frame(k) for k in ks]
                        yield pa.RecordBatch.from_arrays([
                            pa.array([r.doc_ids[k] for k in ks], pa.int64()),
                            pa.array([int(starts[k]) for k in ks], pa.int64()),
                            pa.array([len(x) // 4 for x in body], pa.int64()),
                            pa.array([zlib.crc32(x) for x in body] if digest else body, last[1])],
                            schema=schema)

    n = max(1, manifest.count())
    out = f"doc_id long, start long, n_tokens long, {'ids_crc32 long' if digest else 'ids binary'}"
    return files.repartition(n).mapInArrow(read, out)
