"""Helpers shared by the operators of this package."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in an Arrow batch: whole texts travel, so a batch must stay small when documents are long.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Batches of whole texts must be small, on the JVM's side too. Sessions of ``textloom.session`` have this size from the start.

    Elsewhere it is lowered and stays so, since plans read it when they run; a smaller one is left alone.
    """
    if int(spark.conf.get(_BATCH)) > BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def pieces(batches: Iterator[pa.RecordBatch], rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to so many rows, so that few texts at a time become Python objects."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


@contextmanager
def large_batches(spark: SparkSession) -> Iterator[None]:
    """For rows of a few numbers; holds for what is computed inside."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(1 << 15))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, named by the cluster; a temporary one only where both are one machine."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        current = sc._jsc.sc().getCheckpointDir()
        if current.isDefined():
            named = current.get()
        elif sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
            named = tempfile.mkdtemp(prefix="textloom-")
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(named)
    return named


def new_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/textloom-{what}-{uuid.uuid4().hex}"


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def discard(spark: SparkSession, folders: list[str]) -> None:
    """Delete folders whose rows a later stage holds."""
    for path in folders:
        fs, p = _files(spark, path)
        fs.delete(p, True)
    folders.clear()


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage for a small or medium table: files in the shared folder, freed with the table."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, what: str, folders: list[str] | None = None) -> DataFrame:
    """Cut lineage for a large table: compressed Parquet in the shared folder.

    It is deleted when the driver ends, or sooner by ``discard`` if its name is kept in ``folders``.
    """
    spark, path = df.sparkSession, new_folder(df.sparkSession, what)
    df.write.parquet(path)
    fs, p = _files(spark, path)
    fs.deleteOnExit(p)
    if folders is not None:
        folders.append(path)
    return spark.read.schema(df.schema).parquet(path)
