"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm._common import new_folder, table, text_or_empty
from textloom.llm.oracle import ORACLE_SQL  # noqa: F401


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textloom.llm.packing import pack

    return pack(table(spark, sf_dir, "documents")).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textloom.llm.bpe import encode

    return encode(table(spark, sf_dir, "documents"), digests=True)


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textloom.llm.html import extract

    pages = extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", F.col("_text").alias("text"), F.char_length("_text").cast("long").alias("n_chars"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textloom.llm.simhash import digits, groups

    return groups(table(spark, sf_dir, "documents")).select("doc_id", digits().alias("fingerprint"), "component_id")


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textloom.llm.ann import search

    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textloom.llm.tokenfile import read_tokens, write_tokens

    folder = new_folder(spark, "tokens")
    files = write_tokens(table(spark, sf_dir, "documents"), folder)
    return read_tokens(spark, files, folder).select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textloom.llm.langid import fit, held_out, identify

    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"), F.col("_rejected").alias("rejected"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textloom.llm.minhash import edited_likeness

    return edited_likeness(table(spark, sf_dir, "documents"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textloom.llm.suffix import remove_repeats

    kept = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", F.octet_length(text_or_empty()).cast("long").alias("n_bytes"), F.col("_removed").alias("n_removed"), F.col("_spans").alias("n_spans"), F.sha2("_kept", 256).alias("kept_sha256"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textloom.llm.sharding import shard_documents

    return shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_bpe": op2_bpe,
    "op3_html": op3_html,
    "op4_simhash": op4_simhash,
    "op5_neighbours": op5_neighbours,
    "op6_token_files": op6_token_files,
    "op7_language": op7_language,
    "op8_minhash": op8_minhash,
    "op9_repeats": op9_repeats,
    "op10_sharding": op10_sharding,
}
