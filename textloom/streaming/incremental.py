"""Runs that do new work only: file streams that stop when nothing is left, with state from run to run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def new_records(spark: SparkSession, folder: str, schema: str, files_at_once: int = 1000) -> DataFrame:
    """A stream of JSON lines from files not read before; torn lines are skipped."""
    return spark.readStream.schema(schema).option("mode", "DROPMALFORMED").option("maxFilesPerTrigger", files_at_once).json(folder)


def run_once(stream: DataFrame, out: str, checkpoint: str, each: Callable[[DataFrame, int], DataFrame] | None = None) -> None:
    """Process what is there and stop; a rerun goes on where this one ended."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if each is None:
        query = writer.format("parquet").option("path", out).outputMode("append").start()
    else:
        query = writer.foreachBatch(lambda df, k: each(df, k).write.mode("append").parquet(out)).start()
    query.awaitTermination()


def first_of_key(stream: DataFrame, key: Column) -> DataFrame:
    """Keys seen in earlier batches and runs are dropped; the state holds keys only."""
    return stream.withColumn("_key", key).dropDuplicates(["_key"]).drop("_key")


def recent_first_of_key(stream: DataFrame, key: str, at: str, keep: str) -> DataFrame:
    """As first_of_key, with state that ends: only duplicates within ``keep`` of each other are dropped."""
    return stream.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", keep).dropDuplicatesWithinWatermark([key]).drop("_at")


def split_failures(rows: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(good, quarantined)."""
    return rows.where(F.col(error).isNull()).drop(error), rows.where(F.col(error).isNotNull())


def progress(query) -> dict:
    """Rows and rate of the last batch."""
    last = query.lastProgress or {}
    return {"batch": last.get("batchId"), "rows": last.get("numInputRows"), "rows_per_second": last.get("processedRowsPerSecond")}
