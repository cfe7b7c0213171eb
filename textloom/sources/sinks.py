"""Packaged datasets: named Parquet shards, checksums, a card, and the check before publishing."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions.text import compact, human
from textloom.operators.shards import SHARD_BYTES, greedy_shards, row_bytes
from textloom.sources.readers import file_system, list_files

ZSTD_LEVEL = 6


def write_shards(rows: DataFrame, folder: str, name: str, order: str, budget: int = SHARD_BYTES) -> list[str]:
    """One file for each shard, <name>-00000-of-00003.parquet, in the rows' order; the folder must be shared.

    Shards are found first; rows are then dealt by shard and written by Spark's committer, one file each.
    """
    spark = rows.sparkSession
    # A row is known by its order and its content, never by the order alone, which may be null or repeated; equal rows share a shard.
    keyed = rows.withColumn("_row", F.xxhash64(F.to_json(F.struct(*rows.columns)))).withColumn("_all", F.lit(name)).withColumn("_order", F.struct(F.col(order), F.col("_row")))
    light = keyed.groupBy("_all", "_order").agg(F.sum(row_bytes(rows)).alias("_bytes"))
    shards = greedy_shards(light, "_all", "_order", "_bytes", budget).select("_order", "shard")
    placed = keyed.join(shards.select(F.col("_order")[order].alias("_o"), F.col("_order")["_row"].alias("_r"), "shard"), F.col(order).eqNullSafe(F.col("_o")) & (F.col("_row") == F.col("_r"))).select(*rows.columns, "shard")
    n = shards.agg(F.max("shard") + 1).first()[0] or 0
    made = f"{folder}/.{name}"
    out = placed.repartition(max(n, 1), "shard").sortWithinPartitions("shard", order).write.mode("overwrite").option("compression", "zstd").option("parquet.compression.codec.zstd.level", str(ZSTD_LEVEL))
    out.partitionBy("shard").parquet(made)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(made).getFileSystem(spark._jsc.hadoopConfiguration())
    final = []
    for status in fs.globStatus(fs_path(f"{made}/shard=*/*.parquet")) or []:
        k = int(re.search(r"shard=(\d+)", status.getPath().toString())[1])
        final.append(f"{folder}/{name}-{k:05d}-of-{n:05d}.parquet")
        fs.rename(status.getPath(), fs_path(final[-1]))
    fs.delete(fs_path(made), True)
    return sorted(final)


def write_checksums(spark: SparkSession, folder: str | Path, name: str = "SHA256SUMS") -> dict[str, str]:
    """SHA-256 of every file below the folder but the list itself, by sorted path; files are read in tasks, a part at a time."""
    root = str(folder)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(root)
        for b in batches:
            sums = []
            for path in b.column(0).to_pylist():
                sha = hashlib.sha256()
                with fs.open_input_stream(f"{base}/{path}") as f:
                    while part := f.read(1 << 20):
                        sha.update(part)
                sums.append(sha.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sums, pa.string())], ["path", "sha256"])

    files = list_files(spark, root, ("",), skip=(name,)).select("path").repartition(4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    # One short line for each file of a packaged dataset.
    sums = {r.path: r.sha256 for r in files.mapInArrow(digest, "path string, sha256 string").collect()}
    sums = dict(sorted(sums.items()))
    write_text(f"{root}/{name}", "".join(f"{h}  {p}\n" for p, h in sums.items()))
    return sums


def write_text(path: str, text: str) -> None:
    """A small file on any file system."""
    fs, place = file_system(path)
    fs.create_dir(place.rsplit("/", 1)[0])
    with fs.open_output_stream(place) as f:
        f.write(text.encode())


def append_json_lines(path: str | Path, records: list[dict]) -> None:
    """Whole lines, one write each."""
    with open(path, "a", encoding="utf-8") as f:
        for r in records:
            f.write(json.dumps(r, ensure_ascii=False) + "\n")
            f.flush()


def card(stats: list[dict], title: str) -> str:
    """A dataset card from rows of source, rows, files, raw_bytes."""
    rows, size = sum(s["rows"] for s in stats), sum(s["raw_bytes"] for s in stats)
    head = f"# {title}\n\n{rows:,} rows, {human(size)} of text, about {compact(size / 3.6)} tokens.\n\n| source | rows | share | files | text |\n|---|---:|---:|---:|---:|\n"
    return head + "".join(f"| {s['source']} | {s['rows']:,} | {100 * s['rows'] / max(rows, 1):.1f}% | {s['files']} | {human(s['raw_bytes'])} |\n" for s in stats)


def build_totals(stats: list[dict], disk_bytes: int) -> dict:
    """Rows, tokens, bytes of text and on disk, and how many times smaller the files are."""
    rows, raw = sum(s["rows"] for s in stats), sum(s["raw_bytes"] for s in stats)
    return {"rows": rows, "tokens": int(raw / 3.6), "raw_bytes": raw, "disk_bytes": disk_bytes, "ratio": round(raw / disk_bytes, 2) if disk_bytes else 0.0}


def datasheet(stats: list[dict], title: str, splits: dict[str, dict] | None = None, licenses: dict[str, str] | None = None) -> str:
    """What a dataset is made of: sources by size with their licenses, question and answer splits, all counts from build statistics.

    splits: rows, files, raw_bytes and flagged (answers with unsupported terms) of each split.
    """
    totals, licenses = build_totals(stats, 0), licenses or {}
    out = [f"# Datasheet: {title}", "", "## Composition", "", f"{totals['rows']:,} documents, about {compact(totals['tokens'])} tokens.", ""]
    for s in sorted(stats, key=lambda s: (-s["raw_bytes"], s["source"])):
        share = 100 * s["raw_bytes"] / max(totals["raw_bytes"], 1)
        out.append(f"- {s['source']}: {s['rows']:,} documents, {human(s['raw_bytes'])} ({share:.1f}%), {licenses.get(s['source'], 'license unknown')}")
    if splits:
        out += ["", "## Questions and answers", "", "| split | rows | files | text | flagged |", "|---|---:|---:|---:|---:|"]
        for name, s in sorted(splits.items()):
            flagged = 100 * s.get("flagged", 0) / max(s["rows"], 1)
            out.append(f"| {name} | {s['rows']:,} | {s['files']} | {human(s['raw_bytes'])} | {s.get('flagged', 0):,} ({flagged:.1f}%) |")
    return "\n".join(out) + "\n"


def check_publishable(folder: str | Path) -> list[str]:
    """Files that would be published; restricted ones stop everything."""
    fs, base = file_system(str(folder))
    if fs.get_file_info(f"{base}/restricted").type != pafs.FileType.NotFound:
        raise PermissionError(f"{folder}/restricted must not be published")
    return sorted(i.path[len(base) :].lstrip("/") for i in fs.get_file_info(pafs.FileSelector(base, recursive=True)) if i.type == pafs.FileType.File)
