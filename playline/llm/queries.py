"""The queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playline.llm import bpe, chat_format, decontaminate, importance, oracles, secret_scan
from playline.llm.collocations import ORACLE, best_of_each_language, collocations
from playline.llm.jaccard import similar
from playline.llm.licenses import licenses
from playline.llm.quality import quality
from playline.llm.suffixes import without_repeats
from playline.llm.token_files import read_tokens, write_tokens
from playline.llm.toxicity import fit, score
from playline.llm.warc import page_records, read_archives, read_warc, write_warc
from playline.session import prepare, scratch_path

END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    cut = without_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.decontaminate(documents, benchmark))


def op3_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return similar(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    definition = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text()
    path = scratch_path(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), definition, path, END_ID)
    return read_tokens(spark, path).select(
        "doc_id",
        "start",
        F.expr("CAST(octet_length(ids) DIV 4 AS BIGINT)").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return secret_scan.report(secret_scan.scan(table(spark, sf_dir, "documents"), path="source"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    path = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return page_records(read_warc(read_archives(spark, path)))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files below their source and language; texts of up to 500 characters with a
    notice count as licence files, since the table has none by name."""
    prepare(spark)
    place = F.concat_ws("/", "source", "lang", F.expr("doc_id DIV 1000"), F.col("doc_id"))
    files = table(spark, sf_dir, "documents").select("doc_id", place.alias("path"), "text")
    return licenses(files, is_license_file=F.length("text") <= 500)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.digests(table(spark, sf_dir, "documents"), ranks)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return best_of_each_language(collocations(table(spark, sf_dir, "documents")))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return importance.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one more, -1, that says what the template itself says."""
    prepare(spark)
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select(*extra.columns).unionByName(extra)
    return chat_format.digest(chat_format.read_back(chat_format.format_chats(rows)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_repetition": op3_repetition,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_token_files": op5_token_files,
    "op6_secrets": op6_secrets,
    "op7_warc": op7_warc,
    "op8_toxicity": op8_toxicity,
    "op9_licenses": op9_licenses,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_collocations": op11_collocations,
    "op12_importance": op12_importance,
    "op13_chat_format": op13_chat_format,
}

ORACLES: dict[str, str] = {
    "op1_suffix_dedup": oracles.SUFFIX_DEDUP,
    "op2_decontamination": decontaminate.ORACLE,
    "op3_repetition": oracles.REPETITION,
    "op4_jaccard_join": oracles.JACCARD_JOIN,
    "op7_warc": oracles.WARC,
    "op11_collocations": ORACLE,
    "op12_importance": importance.ORACLE,
    "op13_chat_format": chat_format.ORACLE,
}
