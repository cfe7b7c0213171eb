"""Token-id files with fixed-width ids.

Each id takes ``max(1, (vocabulary - 1).bit_length())`` bits. Blocks of BLOCK ids start on a byte
boundary; their byte offsets are stored, so that a range of ids is read without what lies before it.

File, little-endian::

    magic 8 bytes | bits u32 | ids in a block u32 | documents u64 | ids u64
    blocks of packed ids, most significant bit first
    block offsets u64[blocks + 1], from the first block
    document ids i64[documents] | which ids are not null u8[documents] | first id of each document u64[documents + 1]
    place of the block offsets u64 | magic 8 bytes
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.llm._common import materialize, pieces, small_batches, text_or_empty
from textloom.llm.tokens import default_tokenizer, encoder

MAGIC = b"TLBITS01"
BLOCK = 4096
#: A file is closed when it holds so many ids.
FILE_IDS = 1 << 24
_HEAD = struct.Struct("<8sIIQQ")


def width(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Ids in ``bits`` bits each, most significant bit first, padded to a whole byte."""
    spread = np.unpackbits(np.ascontiguousarray(ids, ">u4").view(np.uint8).reshape(-1, 4), axis=1)
    if len(ids) and int(np.max(ids)) >> bits:
        raise ValueError(f"an id does not fit in {bits} bits")
    return np.packbits(spread[:, 32 - bits :].reshape(-1)).tobytes()


def unpack_bits(data: bytes, bits: int, n: int) -> np.ndarray:
    spread = np.zeros((n, 32), np.uint8)
    spread[:, 32 - bits :] = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits).reshape(n, bits)
    return np.packbits(spread, axis=1).view(">u4").reshape(-1).astype("<u4")


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


class Writer:
    """Writes one file under a name that no other attempt uses; the table of files names those of the attempts that count."""

    def __init__(self, fs: pafs.FileSystem, path: str, bits: int):
        self.fs, self.path, self.bits = fs, path, bits
        self.out = fs.open_output_stream(path)
        self.offsets, self.ids, self.keys, self.firsts, self.pending, self.waiting = [0], 0, [], [0], [], 0

    def add(self, key: int | None, ids: bytes) -> None:
        self.keys.append(key)
        self.ids += len(ids) // 4
        self.firsts.append(self.ids)
        self.pending.append(ids)
        self.waiting += len(ids) // 4
        if self.waiting >= 64 * BLOCK:
            self._blocks(final=False)

    def _blocks(self, final: bool) -> None:
        ids = np.frombuffer(b"".join(self.pending), "<u4")
        whole = len(ids) if final else len(ids) - len(ids) % BLOCK
        for at in range(0, whole, BLOCK):
            packed = pack_bits(ids[at : min(at + BLOCK, whole)], self.bits)
            self.out.write(packed)
            self.offsets.append(self.offsets[-1] + len(packed))
        self.pending, self.waiting = [ids[whole:].tobytes()], len(ids) - whole

    def close(self) -> None:
        self._blocks(final=True)
        for values, kind in ((self.offsets, "<u8"), ([k or 0 for k in self.keys], "<i8"), ([k is not None for k in self.keys], "u1"), (self.firsts, "<u8")):
            self.out.write(np.asarray(values, kind).tobytes())
        self.out.write(_HEAD.pack(MAGIC, self.bits, BLOCK, len(self.keys), self.ids) + struct.pack("<Q", self.offsets[-1]) + MAGIC)
        self.out.close()

    def abandon(self) -> None:
        self.out.close()
        self.fs.delete_file(self.path)


class Reader:
    """Random access to one file; only the tables at its end stay in memory."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.file = fs.open_input_file(path)
        size, tail = self.file.size(), _HEAD.size + 16
        end = self.file.read_at(tail, size - tail) if size >= tail else b""
        if end[-8:] != MAGIC or end[:8] != MAGIC:
            raise ValueError(f"not a whole token file: {path}")
        _, self.bits, self.block, documents, self.ids = _HEAD.unpack(end[: _HEAD.size])
        at = struct.unpack("<Q", end[_HEAD.size : _HEAD.size + 8])[0]
        blocks = -(-self.ids // self.block)
        tables = self.file.read_at(size - tail - at, at)
        a, b = 8 * (blocks + 1), 8 * documents
        self.offsets = np.frombuffer(tables[:a], "<u8").astype(np.int64)
        self.keys = np.frombuffer(tables[a : a + b], "<i8")
        self.known = np.frombuffer(tables[a + b : a + b + documents], "u1").astype(bool)
        self.firsts = np.frombuffer(tables[a + b + documents :], "<u8").astype(np.int64)

    def slice(self, start: int, stop: int) -> np.ndarray:
        """Ids from start to stop, reading only the blocks that hold them."""
        if stop <= start:
            return np.zeros(0, "<u4")
        first, last = start // self.block, (stop - 1) // self.block
        data = self.file.read_at(int(self.offsets[last + 1] - self.offsets[first]), int(self.offsets[first]))
        if self.block * self.bits % 8 == 0:
            ids = unpack_bits(data, self.bits, min(self.ids, (last + 1) * self.block) - first * self.block)
        else:
            cut = self.offsets[first : last + 2] - self.offsets[first]
            ids = np.concatenate([unpack_bits(data[x:y], self.bits, min(self.block, self.ids - k * self.block)) for k, x, y in zip(range(first, last + 1), cut, cut[1:])])
        return ids[start - first * self.block : stop - first * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.slice(int(self.firsts[k]), int(self.firsts[k + 1]))

    def documents(self, at_once: int = 1 << 20) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(id, first position, ids) of each document in the file's order, some at a time."""
        k, n = 0, len(self.keys)
        while k < n:
            stop = max(k + 1, int(np.searchsorted(self.firsts, self.firsts[k] + at_once, "right")) - 1)
            base = int(self.firsts[k])
            ids = self.slice(base, int(self.firsts[stop]))
            for j in range(k, stop):
                yield (int(self.keys[j]) if self.known[j] else None), int(self.firsts[j]), ids[int(self.firsts[j]) - base : int(self.firsts[j + 1]) - base]
            k = stop


def write_tokens(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = 0, file_ids: int = FILE_IDS) -> DataFrame:
    """Write ids of all texts, the end id after each, in ascending order of the id; one row per file.

    Returns part, nth, path, documents, ids and first (ids in all files before it), one row per file. A
    null text is empty; null ids come first; rows of one id are ordered by text. An empty table: no file.
    Files of attempts that were lost may stay in the folder; only those in the table are read.
    """
    spark, source = docs.sparkSession, tokenizer or default_tokenizer()
    small_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end, task = encoder(source), np.array([end_id], "<u4").tobytes(), TaskContext.get()
        fs, root = file_system(folder)
        fs.create_dir(root, recursive=True)
        part, nth, writer, made = task.partitionId(), 0, None, []

        def close() -> None:
            nonlocal nth, writer
            writer.close()
            made.append((part, nth, writer.path, len(writer.keys), writer.ids))
            nth, writer = nth + 1, None

        try:
            for batch in pieces(batches):
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if writer is None:
                        writer = Writer(fs, f"{root}/part-{part:06d}-{nth:06d}-{task.taskAttemptId()}.bits", width(enc.vocabulary))
                    writer.add(key, enc.encode(text) + end)
                    if writer.ids >= file_ids:
                        close()
            if writer is not None:
                close()
        except BaseException:
            if writer is not None:
                writer.abandon()
            raise
        columns = list(zip(*made)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))], ["part", "nth", "path", "documents", "ids"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    placed = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    files = materialize(placed.mapInArrow(run, "part int, nth int, path string, documents long, ids long"))
    before = Window.orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return files.select("*", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first"))


def read_tokens(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """One row per document of these files: doc_id, start (ids before it in all files), ids (little-endian uint32)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(folder)
        for batch in pieces(batches):
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held, size = [], 0
                for key, start, ids in Reader(fs, path).documents():
                    held.append((key, first + start, ids.tobytes()))
                    size += len(ids)
                    if size >= 1 << 20:
                        yield rows(held)
                        held, size = [], 0
                if held:
                    yield rows(held)

    def rows(held: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), (pa.int64(), pa.int64(), pa.binary()))], ["doc_id", "start", "ids"])

    # AQE would join all the small rows of this list in one task; a number keeps the files apart.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.select("path", "first").repartition(tasks, "path").mapInArrow(run, "doc_id long, start long, ids binary")
