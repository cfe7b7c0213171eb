"""Session settings that results depend on, and defaults for local runs."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Results depend on these two.
SETTINGS = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true"}
#: Rows are whole texts, so an Arrow batch must hold few of them.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "512"}


def build(master: str = "local[*]", shuffle_partitions: int = 8, memory: str = "4g") -> SparkSession:
    builder = SparkSession.builder.master(master).appName("textloom")
    for k, v in (SETTINGS | BATCHES).items():
        builder = builder.config(k, v)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions)).config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false").config("spark.sql.adaptive.enabled", "true").getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
