"""A corpus through five operators: from raw documents to packed sequences.

Each stage works on all that the one before kept; run() stores every stage's result in the
shared folder and reads it back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import cuckoo, mixing, packing, simhash, toxicity
from tallyhouse.llm.common import FILE, ROW, free_name, on_files, stored, with_row_key

#: The score from which a document counts as toxic.
TOXIC = 0.5


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of docs whose row key is among the kept ones; texts are not sorted."""
    file, row = free_name(docs, FILE), free_name(docs, ROW)
    keys = kept.select(F.col(FILE).alias(file), F.col(ROW).alias(row)).hint("shuffle_hash")
    return with_row_key(docs, file, row).join(keys, [file, row], "left_semi").select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the threshold; null and empty texts are scored too."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = free_name(docs, "__score")
    scored = toxicity.fit(docs, labels).score(docs, to=score)
    return scored.where(F.col(score) < TOXIC).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A to Z lower-cased) the row with the largest doc_id."""
    docs = on_files(docs)
    found = cuckoo.exact_duplicates(docs)
    return _only(docs, found.where("kept").select(FILE, ROW))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked fingerprints the row with the smallest doc_id.

    Links are op1's, at most 4 bits; most texts alike by 0.8 in 5-word shingles differ in
    more and stay. README has the measured recall.
    """
    docs = on_files(docs)
    return _only(docs, simhash.keep_one(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, or up to three times."""
    docs = on_files(docs)
    file, row, copy = (free_name(docs, n) for n in (FILE, ROW, "__copy"))
    taken = mixing.mix(docs).where("copies > 0")
    times = F.sequence(F.lit(1).cast("long"), F.col("copies")).alias(copy)
    copies = taken.select(F.col(FILE).alias(file), F.col(ROW).alias(row), times)
    joined = with_row_key(docs, file, row).join(copies.hint("shuffle_hash"), [file, row])
    return joined.withColumn(copy, F.explode(copy)).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack every document that is left; one row per piece with its ids."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Fitted scores, fingerprints and token ids are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
