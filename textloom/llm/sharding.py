"""Contiguous shards of nearly equal bytes, in DataFrame operations only.

Rows are dealt by range of the id; each partition's total gives the bytes before it, so a running sum
inside partitions becomes a global prefix sum. The line of all bytes is cut at equal targets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm._common import materialize

SHARDS = 40
#: Bytes that a row takes beside its text.
ROW_BYTES = 16


def shard_by_bytes(docs: DataFrame, size: Column, order: list[Column], shards: int = SHARDS, carry: dict[str, Column] | None = None) -> DataFrame:
    """Columns of ``carry``, size, shard (int, from 0) and slot (long, gapless from 0 in its shard).

    ``order`` is the order of the shards' rows; nulls come first, ties are broken by size and by the
    carried columns, so that equal rows are the only ones that may change places. A row lies in the
    shard that holds its middle byte. All sizes zero: everything is in shard 0. Rows are never dropped.
    """
    carry = carry or {}
    keys = [f"_k{i}" for i in range(len(order))]
    light = docs.select(*[o.alias(k) for k, o in zip(keys, order)], *[c.alias(f"_c_{n}") for n, c in carry.items()], size.cast("long").alias("_size"))
    within = [*keys, "_size", *[f"_c_{n}" for n in carry]]
    dealt = materialize(light.repartitionByRange(*[F.col(c).asc_nulls_first() for c in within]).withColumn("_part", F.spark_partition_id()))

    # One row for each partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("_part").agg(F.sum("_size").alias("_bytes"), F.count("*").alias("_rows"))
    bases = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(Window.partitionBy(F.lit(0))).alias("_all"),
    )
    running = Window.partitionBy("_part").orderBy(*[F.col(c).asc_nulls_first() for c in within]).rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        dealt.select("*", F.coalesce(F.sum("_size").over(running), F.lit(0)).alias("_in_part"), F.count("*").over(running).alias("_row_in_part"))
        .join(F.broadcast(bases), "_part")
        .withColumn("_middle", 2 * (F.col("_bytes_before") + F.col("_in_part")) + F.col("_size"))
        .withColumn("shard", F.least(F.lit(shards - 1), F.when(F.col("_all") > 0, F.expr(f"(_middle * {shards}) div (2 * _all)")).otherwise(0)).cast("int"))
        .withColumn("_row", F.col("_rows_before") + F.col("_row_in_part"))
    )
    first = placed.groupBy("shard").agg(F.min("_row").alias("_first"))  # at most as many rows as shards
    return placed.join(F.broadcast(first), "shard").select(*[F.col(f"_c_{n}").alias(n) for n in carry], F.col("_size").alias("size"), "shard", (F.col("_row") - F.col("_first")).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Documents in order of doc_id: doc_id, text_crc32, size, shard, slot. A null text has no bytes."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return shard_by_bytes(docs, F.octet_length(raw) + ROW_BYTES, [F.col("doc_id")], shards, {"doc_id": F.col("doc_id"), "text_crc32": F.crc32(raw)})
