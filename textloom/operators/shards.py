"""Shards of a byte budget, filled in order: a shard ends with the row that reaches the budget.

What goes over is forgotten, so a running sum cannot tell the shards. Rows are cut into blocks of keys
instead. Where a block ends depends on what it is entered with only through its first shard end, so each
block tells, in its own task, how it would be left from each; one task reads these tables, not the rows,
and finds how each block is entered; then all blocks number their rows at once.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARD_BYTES = 256 * 1024 * 1024
#: Sampled keys for each block, and blocks for each shuffle partition.
SAMPLED, BLOCKS = 20, 4


def row_bytes(df: DataFrame) -> Column:
    """UTF-8 bytes of the text, else of the row as JSON."""
    return F.octet_length("text") if "text" in df.columns else F.octet_length(F.to_json(F.struct(*df.columns)))


def block_table(sizes: np.ndarray, budget: int) -> tuple[int, list[int], list[int], list[int]]:
    """(bytes, need, closed, held): entered with at least ``need`` bytes, a block closes so many shards and is left holding so much.

    The first entry whose need is met counts; if none is, no shard ends and the bytes are added.
    """
    ends, m = np.cumsum(sizes), len(sizes)
    begins = ends - sizes
    stop = np.maximum(np.searchsorted(ends, begins + budget, "left"), np.arange(m)).tolist()
    closed, left = [0] * (m + 1), [0] * (m + 1)
    for k in range(m - 1, -1, -1):
        if stop[k] < m:
            closed[k], left[k] = closed[stop[k] + 1] + 1, left[stop[k] + 1]
        else:
            left[k] = int(ends[-1] - begins[k])
    need, shards, held = [], [], []
    # The block's first shard end is a row that adds bytes (its first row, if there is no budget) within one budget of the start.
    first = np.flatnonzero((begins < budget) & (sizes > 0)) if budget > 0 else np.arange(min(m, 1))
    for k in first.tolist():
        now = closed[k + 1] + 1, left[k + 1]
        if need and now == (shards[-1], held[-1]):
            need[-1] = budget - int(ends[k])
        else:
            need.append(budget - int(ends[k]))
            shards.append(now[0])
            held.append(now[1])
    return int(ends[-1]), need, shards, held


def _blocks(light: DataFrame) -> DataFrame:
    """Adds b, the number of the row's range of (g, o, n), by binary search among keys of least hashes, a sample of bounded size."""
    spark = light.sparkSession
    count = BLOCKS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct("g", "o", "n")
    drawn = light.select(key.alias("k")).orderBy(F.xxhash64("k")).limit(SAMPLED * count)
    cuts = drawn.agg(F.array_sort(F.collect_list("k")).alias("all"))
    cuts = cuts.select(F.transform(F.sequence(F.lit(1), F.lit(count - 1)), lambda i: F.get("all", (i * F.size("all") / count).cast("int"))).alias("cuts"))
    steps = F.array(*[F.lit(2**k) for k in range(count.bit_length() - 1, -1, -1)])
    below = lambda at, step: (at + step <= count - 1) & F.coalesce(F.get("cuts", at + step - 1) <= key, F.lit(False))
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(below(at, step), at + step).otherwise(at))
    return light.join(F.broadcast(cuts), how="inner", on=F.lit(True)).withColumn("b", found).drop("cuts")  # one row


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, int, np.ndarray]]:
    """Sizes of each group's rows in a block, from rows in that order."""
    now, sizes = None, array("q")
    for batch in batches:
        for g, b, n in zip(*(batch.column(c).to_pylist() for c in ("g", "b", "n"))):
            if now != (g, b):
                if sizes:
                    yield *now, np.array(sizes, np.int64)
                now, sizes = (g, b), array("q")
            sizes.append(n or 0)
    if sizes:
        yield *now, np.array(sizes, np.int64)


def greedy_shards(rows: DataFrame, group: str, order: str, size: Column | str, budget: int = SHARD_BYTES) -> DataFrame:
    """(group, order, bytes, shard): shards from 0 in each group.

    Null groups and orders come first, a null size counts as none, rows of equal order are taken by size.
    An empty table gives an empty one. The rows are read three times, by key and size.
    """
    light = rows.select(F.col(group).alias("g"), F.col(order).alias("o"), (F.col(size) if isinstance(size, str) else size).cast("long").alias("n"))
    kinds = {f.name: f.dataType.simpleString() for f in light.schema}
    placed = _blocks(light)

    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, b, sizes in _segments(batches):
            total, need, closed, held = block_table(sizes, budget)
            yield pa.RecordBatch.from_pylist([{"g": g, "b": b, "total": total, "need": need, "closed": closed, "held": held}], told)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, shard, held = None, 0, 0
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if now != (r["g"],):
                    now, shard, held = (r["g"],), 0, 0
                out.append((shard, held))
                hit = next((k for k, least in enumerate(r["need"]) if least <= held), None)
                shard, held = (shard, held + r["total"]) if hit is None else (shard + r["closed"][hit], r["held"][hit])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([s for s, _ in out], pa.int32()), pa.array([h for _, h in out], pa.int64())], ["g", "b", "shard", "held"])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = 0, 0
        for batch in batches:
            stay, shards = [], []
            for k, (start, n, s, h) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("start", "n", "shard", "held")))):
                if start:
                    shard, held = s, h
                    continue
                stay.append(k)
                shards.append(shard)
                held += n or 0
                if held >= budget:
                    shard, held = shard + 1, 0
            kept = batch.take(pa.array(stay, pa.int64()))
            yield pa.RecordBatch.from_arrays([kept.column("g"), kept.column("o"), kept.column("n"), pa.array(shards, pa.int32())], ["g", "o", "n", "shard"])

    from pyspark.sql.pandas.types import to_arrow_type

    told = pa.schema([("g", to_arrow_type(light.schema["g"].dataType)), ("b", pa.int32()), ("total", pa.int64()), ("need", pa.list_(pa.int64())), ("closed", pa.list_(pa.int32())), ("held", pa.list_(pa.int64()))])
    ends = placed.repartition("g", "b").sortWithinPartitions("g", "b", "o", "n").select("g", "b", "n").mapInArrow(tables, f"g {kinds['g']}, b int, total long, need array<long>, closed array<int>, held array<long>")
    starts = ends.repartition("g").sortWithinPartitions("g", "b").mapInArrow(walk, f"g {kinds['g']}, b int, shard int, held long")
    # A block's entry stands before its rows, so no join is needed.
    entries = starts.select("g", "b", F.lit(True).alias("start"), F.lit(None).cast(kinds["o"]).alias("o"), F.lit(None).cast("long").alias("n"), "shard", "held")
    both = entries.unionByName(placed.select("g", "b", F.lit(False).alias("start"), "o", "n", F.lit(None).cast("int").alias("shard"), F.lit(None).cast("long").alias("held")))
    lined = both.repartition("g", "b").sortWithinPartitions("g", "b", F.desc("start"), "o", "n").select("g", "o", "n", "start", "shard", "held")
    return lined.mapInArrow(number, f"g {kinds['g']}, o {kinds['o']}, n long, shard int").toDF(group, order, "bytes", "shard")


def shard_names(shards: DataFrame, group: str) -> DataFrame:
    """Adds file: <group>-00000-of-00003.parquet."""
    totals = shards.groupBy(group).agg((F.max("shard") + 1).alias("_of"))
    return shards.join(totals, group).withColumn("file", F.format_string("%s-%05d-of-%05d.parquet", F.col(group), F.col("shard"), F.col("_of"))).drop("_of")


def shard_stats(rows: DataFrame, group: str = "source") -> DataFrame:
    """Rows, files and bytes of each group from rows with shard and bytes."""
    return rows.groupBy(group).agg(F.count("*").alias("rows"), F.countDistinct("shard").alias("files"), F.sum("bytes").alias("raw_bytes"))
