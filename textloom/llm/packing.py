"""Cost-balanced packing of documents into sequences of bounded length.

A piece of n tokens costs ``linear * n + quadratic * n**2`` (projections and attention inside the
piece). In a window of documents, pieces go in descending order to the sequence of least cost among
those with room. A piece for which no sequence has room is cut at the roomiest one, so that all
sequences of a window are full; the few tokens that are left over open the next window. Only the last
sequence of a partition is padded. Partitions too small for that to be little are read by one task;
there is no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm._common import pieces, small_batches, text_or_empty
from textloom.llm.tokens import default_tokenizer, encoder

CAPACITY = 1024
#: Tokens gathered before a window is packed.
WINDOW_TOKENS = 1 << 20
#: Estimated bytes of input that a task reads at least, so that one padded sequence is under a hundredth of a per cent of megabytes.
TASK_BYTES = 1 << 19
#: Cost of a token, and of a pair of tokens that attend to each other.
LINEAR, QUADRATIC = 1.0, 1.0 / 512
_SCHEMA = "id {id}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def assign(lengths: np.ndarray, capacity: int = CAPACITY, linear: float = LINEAR, quadratic: float = QUADRATIC, full: bool = False):
    """Pack documents of these lengths: arrays (document, start, length, sequence, offset), by sequence and offset.

    Full sequences cut from documents longer than the capacity come first. A length of zero has no piece.
    With ``full`` there are full sequences only, and the ends of the last documents are in no piece.
    """
    lengths = np.asarray(lengths, np.int64)
    whole, rest = lengths // capacity, lengths % capacity
    doc = np.repeat(np.arange(len(lengths)), whole)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(whole) - whole, whole)
    out = [(doc, nth * capacity, np.full(len(doc), capacity), np.arange(len(doc)), np.zeros(len(doc), np.int64))]
    n = int(rest.sum()) // capacity if full else -(-int(rest.sum()) // capacity)
    room, cost, placed = np.full(n, capacity, np.int64), np.zeros(n), []
    for d in np.argsort(-rest, kind="stable"):
        left, start = int(rest[d]), int(whole[d]) * capacity
        while left and room.any():
            fits = np.flatnonzero(room >= left)
            s = int(fits[np.argmin(cost[fits])]) if len(fits) else int(np.argmax(room))
            take = min(left, int(room[s]))
            placed.append((int(d), start, take, s + len(doc), capacity - int(room[s])))
            room[s] -= take
            cost[s] += linear * take + quadratic * take * take
            left, start = left - take, start + take
    if placed:
        out.append(tuple(np.array(x, np.int64) for x in zip(*placed)))
    found = [np.concatenate(x) for x in zip(*out)]
    order = np.lexsort((found[4], found[3]))
    return tuple(x[order] for x in found)


def fewer(docs: DataFrame, least: int = TASK_BYTES) -> DataFrame:
    """The same rows in no more partitions than the plan's own estimate of its size fills; no shuffle."""
    size = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return docs.coalesce(max(1, min(size // least, (1 << 31) - 1)))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None, end_id: int = 0, capacity: int = CAPACITY, window_tokens: int = WINDOW_TOKENS) -> DataFrame:
    """One row per piece: id, start, length, ids (little-endian uint32), doc_tokens, sequence_id, offset.

    A null or empty text is one piece, the end id. Null and repeated ids are kept, each row packed for
    itself; other columns are ignored; an empty table gives an empty one. Ties in length keep the order of rows.
    """
    path = tokenizer or default_tokenizer()
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        end = np.array([end_id], "<u4").tobytes()
        base, done = TaskContext.get().partitionId() << 33, 0
        waiting: list[tuple] = []  # (id, ids not yet packed, their place in the document, tokens of the document)
        held = 0

        def flush(last: bool) -> pa.RecordBatch:
            nonlocal done, waiting, held
            doc, start, length, sequence, offset = assign([len(w[1]) // 4 for w in waiting], capacity, full=not last)
            of = doc.tolist()
            ids = [waiting[d][1][4 * s : 4 * (s + n)] for d, s, n in zip(of, start.tolist(), length.tolist())]
            first = np.array([w[2] for w in waiting], np.int64)
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([waiting[d][0] for d in of], key_type), pa.array(start + first[doc]), pa.array(length), pa.array(ids, pa.binary()),
                    pa.array([waiting[d][3] for d in of], pa.int64()), pa.array(sequence + base + done), pa.array(offset),
                ],
                ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )
            done += int(sequence[-1]) + 1 if len(sequence) else 0
            packed = np.bincount(doc, weights=length, minlength=len(waiting)).astype(np.int64).tolist()
            waiting = [(w[0], w[1][4 * n :], w[2] + n, w[3]) for w, n in zip(waiting, packed) if 4 * n < len(w[1])]
            held = sum(len(w[1]) // 4 for w in waiting)
            return out

        for batch in pieces(batches):
            key_type = batch.schema.field(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = enc.encode(text) + end
                waiting.append((key, ids, 0, len(ids) // 4))
                held += len(ids) // 4
                if held >= max(window_tokens, capacity):
                    yield flush(last=False)
        if waiting:
            yield flush(last=True)

    rows = fewer(docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")))
    return rows.mapInArrow(run, _SCHEMA.format(id=rows.schema["id"].dataType.simpleString())).withColumnRenamed("id", id_col)
