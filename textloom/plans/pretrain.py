"""From article files to shards, checksums and a card."""

from __future__ import annotations

from pyspark.sql import SparkSession

from textloom.operators.package import document_rows
from textloom.operators.shards import SHARD_BYTES
from textloom.sources.readers import articles, file_system
from textloom.sources.sinks import card, write_checksums, write_shards, write_text


def build(spark: SparkSession, root: str, out: str, origin: str, license: str, base_url: str | None = None, suffixes: tuple[str, ...] = (".md",), budget: int = SHARD_BYTES) -> dict:
    """Writes one source's shards, a card and checksums; rows, files and bytes of what was written.

    Articles are read once: the rows are written beside the shards, which are made from them, and then go.
    """
    staged = f"{out}/.rows-{origin}"
    document_rows(articles(spark, root, suffixes), origin, license, base_url).write.mode("overwrite").parquet(staged)
    files = write_shards(spark.read.parquet(staged), out, origin, "doc_id", budget)
    fs, place = file_system(staged)
    fs.delete_dir(place)
    size = spark.read.parquet(*files).selectExpr("count(*) as rows", "coalesce(sum(octet_length(text)), 0) as raw_bytes").first() if files else {"rows": 0, "raw_bytes": 0}
    stats = {"source": origin, "rows": size["rows"], "files": len(files), "raw_bytes": size["raw_bytes"]}
    write_text(f"{out}/README.md", card([stats], origin))
    write_checksums(spark, out)
    return stats
