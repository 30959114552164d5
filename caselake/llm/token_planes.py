"""Token ids as plane-shuffled binary frames.

A file holds frames; a frame holds whole documents. Their ids in a row are cut into blocks of a fixed
size; each block is transposed into byte planes (or bit planes) and each plane compressed by itself, so
the constant high planes cost nothing. The frame's header and chunk index say where each plane lies.
Frames are rows of Parquet files, so Spark's commit protocol keeps a lost executor's work from being seen.

Null texts count as empty; a null doc_id sorts first; rows with the same doc_id are ordered by text; an
empty table gives an empty dataset. Other columns are not stored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from caselake.llm.tokens import encoder, with_end

FRAME_IDS = 65_536
BLOCK_IDS = 16_384
_HEAD = struct.Struct("<4sHHIII")  # magic, version, planes per block, documents, ids, ids per block
_MAGIC = b"TPL1"
FRAMES = "shard int, frame long, first_doc long, start_in_shard long, n_docs long, n_ids long, payload binary"
DOCS = "doc_id long, shard int, start_in_shard long, n_tokens long, ids_crc32 long"


def to_planes(block: np.ndarray, bits: bool) -> list[bytes]:
    """Rows of the transposed block: 4 byte planes or 32 bit planes."""
    raw = block.astype("<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        raw = np.packbits(np.unpackbits(raw, axis=1, bitorder="little").T, axis=1, bitorder="little")
        return [row.tobytes() for row in raw]
    return [row.tobytes() for row in np.ascontiguousarray(raw.T)]


def from_planes(planes: list[bytes], size: int) -> np.ndarray:
    rows = np.stack([np.frombuffer(p, np.uint8) for p in planes])
    if len(planes) == 32:
        rows = np.packbits(np.unpackbits(rows, axis=1, count=size, bitorder="little").T, axis=1, bitorder="little").T
    return np.ascontiguousarray(rows.T).view("<u4").ravel()


def pack_frame(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray, bits: bool = False, level: int = 3) -> bytes:
    """Header, chunk index (compressed size of each plane; 0 for a plane of zeros), document table, planes."""
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=level).compress
    known = np.array([d is not None for d in doc_ids], np.uint8)
    table = squeeze(known.tobytes() + np.array([d or 0 for d in doc_ids], "<i8").tobytes() + lengths.astype("<u4").tobytes())
    planes = [p for low in range(0, len(ids), BLOCK_IDS) for p in to_planes(ids[low:low + BLOCK_IDS], bits)]
    stored = [squeeze(p) if any(p) else b"" for p in planes]
    index = np.array([len(table), *map(len, stored)], "<u4").tobytes()
    return b"".join([_HEAD.pack(_MAGIC, 1, 32 if bits else 4, len(doc_ids), len(ids), BLOCK_IDS), index, table, *stored])


def unpack_frame(frame: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Inverse of ``pack_frame``: document ids, lengths, ids."""
    import zstandard

    expand = zstandard.ZstdDecompressor().decompress
    magic, version, per_block, n_docs, n_ids, block = _HEAD.unpack_from(frame)
    if magic != _MAGIC or version != 1:
        raise ValueError("Not a token frame of this version.")
    n_planes = -(-n_ids // block) * per_block
    index = np.frombuffer(frame, "<u4", 1 + n_planes, _HEAD.size)
    at = _HEAD.size + index.nbytes
    bounds = at + np.concatenate([[0], np.cumsum(index, dtype=np.int64)])
    parts = [frame[a:z] for a, z in zip(bounds[:-1], bounds[1:])]
    table = expand(parts[0])
    known = np.frombuffer(table, np.uint8, n_docs)
    docs = np.frombuffer(table, "<i8", n_docs, n_docs)
    lengths = np.frombuffer(table, "<u4", n_docs, 9 * n_docs).astype(np.int64)
    out = []
    for k, low in enumerate(range(0, n_ids, block)):
        size = min(block, n_ids - low)
        width = size if per_block == 4 else -(-size // 8)
        planes = [expand(p) if p else bytes(width) for p in parts[1 + k * per_block:1 + (k + 1) * per_block]]
        out.append(from_planes(planes, size))
    ids = np.concatenate(out) if out else np.zeros(0, np.uint32)
    return [int(d) if k else None for d, k in zip(docs, known)], lengths, ids


def _frames(file: str, end: int, bits: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = encoder(file).encode, TaskContext.get().partitionId()
        docs, lengths, ids, size, frame, start = [], [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            count = np.concatenate(lengths)
            payload = pack_frame(docs, count, np.concatenate(ids), bits)
            cells = [[shard], [frame], [docs[0]], [start], [len(docs)], [size], [payload]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cells, (pa.int32(), *[pa.int64()] * 5, pa.binary()))],
                ["shard", "frame", "first_doc", "start_in_shard", "n_docs", "n_ids", "payload"])

        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for low, flat, count in encode(batch.column("text").to_pylist()):
                flat, count = with_end(flat, count, end)
                done, bounds = 0, np.concatenate([[0], np.cumsum(count)])
                while done < len(count):
                    # As many documents as fill the frame, and one at least.
                    take = max(1, int(np.searchsorted(bounds, bounds[done] + FRAME_IDS - size)) - done)
                    some = slice(done, min(done + take, len(count)))
                    docs += names[low + some.start:low + some.stop]
                    lengths.append(count[some])
                    ids.append(flat[bounds[some.start]:bounds[some.stop]])
                    size, done = size + len(ids[-1]), some.stop
                    if size >= FRAME_IDS:
                        yield close()
                        docs, lengths, ids, start, frame, size = [], [], [], start + size, frame + 1, 0
        if docs:
            yield close()

    return run


def write_tokens(docs: DataFrame, path: str, file: str, end: int, bits: bool = False) -> None:
    """Encode every text of ``docs`` in ascending doc_id order and write frames under ``path``."""
    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_frames(file, end, bits), FRAMES).write.option("compression", "none").parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            names, lengths, ids = unpack_frame(row["payload"])
            starts = np.cumsum(lengths) - lengths
            raw = memoryview(ids.astype("<u4").tobytes())
            sums = [zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(starts.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(np.full(len(names), row["shard"]), pa.int32()),
                 pa.array(row["start_in_shard"] + starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())],
                ["doc_id", "shard", "start_in_shard", "n_tokens", "ids_crc32"])


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the frames under ``path``.

    ``start`` adds up two levels: inside a shard the writer has counted; before it, the totals of the
    shards in front, one row per write task.
    """
    frames = spark.read.parquet(path)
    totals = frames.groupBy("shard").agg(F.min("first_doc").alias("lowest"), F.sum("n_ids").alias("total"))
    order = Window.orderBy("lowest", "shard")
    before = totals.select("shard", (F.sum("total").over(order) - F.col("total")).alias("before"))
    docs = frames.select("shard", "start_in_shard", "payload").mapInArrow(_read, DOCS)
    return docs.join(before, "shard").select("doc_id", (F.col("before") + F.col("start_in_shard")).alias("start"), "n_tokens", "ids_crc32")
