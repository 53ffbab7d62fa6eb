"""The registered queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tallyhouse.llm import (
    alignment,
    cuckoo,
    language,
    lexical,
    lines,
    mixing,
    packing,
    simhash,
    threads,
    token_files,
    toxicity,
    vectors,
    warc,
)
from tallyhouse.llm.common import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    printed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", printed.alias("fingerprint"), "component_id")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derive(warc.responses_of(_table(spark, sf_dir, "pages")))


def op3_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threads.link_replies(threads.mailed(_table(spark, sf_dir, "conversations")))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_of(_table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuckoo.exact_duplicates(_table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_tokens(_table(spark, sf_dir, "documents"), path)
    return token_files.token_digests(token_files.read_tokens(spark, path))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return toxicity.toxicity_of(docs, labels)


def op11_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_rules(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical.build_index(_table(spark, sf_dir, "documents"))
    return lexical.search(index, _table(spark, sf_dir, "benchmark"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "pipeline": corpus_pipeline.run,
    "op1_simhash": op1_simhash,
    "op2_warc": op2_warc,
    "op3_quotes": op3_quotes,
    "op4_packing": op4_packing,
    "op5_language": op5_language,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_mixing": op7_mixing,
    "op8_top_k": op8_top_k,
    "op9_token_files": op9_token_files,
    "op10_toxicity": op10_toxicity,
    "op11_line_rules": op11_line_rules,
    "op12_lexical": op12_lexical,
    "op13_alignment": op13_alignment,
}
ORACLES: dict[str, str] = {
    "op3_quotes": threads.SQL,
    "op6_exact_dedup": cuckoo.SQL,
    "op8_top_k": vectors.SQL,
    "op11_line_rules": lines.SQL,
    "op12_lexical": lexical.SQL,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
