"""Tables from files: article files, JSON lines, title lists, XML dumps, failure ledgers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textloom.operators.tables import real_failures

# Files beside articles that are not articles.
NOT_DOCUMENTS = ("manifest.md", "manifest.jsonl", "articles.txt", "articles.jsonl", "categories.txt")


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


#: The driver lists level by level until it has this many folders for the tasks, or none is left.
FOLDERS, LEVELS = 1000, 3


def list_files(spark: SparkSession, root: str, suffixes: tuple[str, ...], limit: int | None = None, skip: tuple[str, ...] = NOT_DOCUMENTS) -> DataFrame:
    """(path, size) of files below root with these suffixes, path relative and sorted.

    Names that start with a dot and folders that start with an underscore hold articles too; Spark's
    own listing would leave them out, so the shared file system is listed here: the uppermost folders on
    the driver, what lies below them in tasks. A root that is missing gives an empty table.
    """
    fs, base = file_system(root)
    wanted = lambda info: info.type == pafs.FileType.File and info.base_name.lower().endswith(suffixes) and info.base_name not in skip
    found, folders = [], [base]
    for _ in range(LEVELS):
        below = []
        for folder in folders:
            for info in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
                if info.type == pafs.FileType.Directory:
                    below.append(info.path)
                elif wanted(info):
                    found.append((info.path[len(base) :].lstrip("/"), info.size))
        folders = below
        if not folders or len(folders) >= FOLDERS:
            break

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(root)
        for b in batches:
            for folder in b.column(0).to_pylist():
                infos = [i for i in fs.get_file_info(pafs.FileSelector(folder, recursive=True)) if wanted(i)]
                yield pa.RecordBatch.from_arrays([pa.array([i.path[len(base) :].lstrip("/") for i in infos], pa.string()), pa.array([i.size for i in infos], pa.int64())], ["path", "size"])

    files = spark.createDataFrame(found, "path string, size long")
    if folders:
        dealt = spark.createDataFrame([(f,) for f in folders], "folder string").repartition(min(len(folders), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
        files = files.unionByName(dealt.mapInArrow(listed, "path string, size long"))
    files = files.orderBy("path")
    return files.limit(limit) if limit else files


def articles(spark: SparkSession, root: str, suffixes: tuple[str, ...] = (".md",), limit: int | None = None, partitions: int | None = None) -> DataFrame:
    """(path, text) of article files; bytes that are not UTF-8 are replaced."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(root)
        for b in batches:
            for path in b.column(0).to_pylist():
                with fs.open_input_file(f"{base}/{path}") as f:
                    yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([f.read().decode("utf-8", "replace")])], ["path", "text"])

    paths = list_files(spark, root, suffixes, limit).select("path")
    return paths.repartition(partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(read, "path string, text string")


def stat_scan(spark: SparkSession, root: str, suffixes: tuple[str, ...]) -> DataFrame:
    """Count and bytes by suffix, without reading a file."""
    suffix = F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1))
    return list_files(spark, root, suffixes).groupBy(suffix.alias("suffix")).agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))


def json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Records; blank and torn lines are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def title_list(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Distinct titles, one on a line; several lists are united."""
    return spark.read.text(path).select(F.trim("value").alias("title")).where("title <> ''").distinct()


def ledger(spark: SparkSession, path: str, schema: str = "item string, error string") -> DataFrame:
    """Failures that are the item's own."""
    return real_failures(json_lines(spark, path, schema)).distinct()


def xml_pages(spark: SparkSession, path: str) -> DataFrame:
    """(title, wikitext) of pages in the main namespace that are no redirects; the last revision counts."""
    schema = "title string, ns int, redirect struct<_title: string>, revision array<struct<text: struct<_VALUE: string>>>"
    pages = spark.read.format("xml").option("rowTag", "page").schema(schema).load(path)
    text = F.element_at(F.col("revision.text._VALUE"), -1)
    return pages.where("coalesce(ns, 0) = 0 and redirect is null and title is not null and size(revision) > 0").select("title", text.alias("wikitext")).where("wikitext <> ''")
