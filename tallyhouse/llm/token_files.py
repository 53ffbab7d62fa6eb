"""Token ids as Parquet list columns, written for selective reads.

Documents are dealt by ranges of their id, so files hold them in ascending order, and
encoded where they lie. A row holds a document's ids as a list, its length and the ids
before it in its file's range; one sum per range turns that into the place in the whole
corpus. Row groups and pages are small, ids are dictionary or delta encoded, and the
writer's page index lets a reader skip to the rows of some documents, or read lengths
without touching the ids.

Defined results: a null text is empty and has only the end id; a null doc_id sorts first;
repeated rows each keep their own ids; an empty table gives files without rows. Other
columns, whatever their names, are not read. Long texts are encoded whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.llm.common import FILE, ROW, partitions, with_row_key
from tallyhouse.llm.tokens import encoder

SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"
#: Texts encoded at once, by count and by characters.
BATCH, BATCH_CHARS = 2048, 1 << 23


def slices(texts: pa.Array) -> Iterator[slice]:
    """Runs of texts that are encoded together; a very long text may make up its own run."""
    start, held = 0, 0
    for k, size in enumerate(pc.utf8_length(texts).to_pylist()):
        held += size or 0
        if k + 1 - start >= BATCH or held >= BATCH_CHARS or k + 1 == len(texts):
            yield slice(start, k + 1)
            start, held = k + 1, 0


def _encode_ordered(tokenizer: str | None, end_id: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        coder = encoder(tokenizer)
        end = np.array([end_id], np.int32)
        for batch in batches:
            for run in slices(texts := batch.column(1)):
                ids = [
                    np.frombuffer(x, coder.dtype).astype(np.int32) for x in coder.encode(texts[run])
                ]
                sizes = np.array([len(x) + 1 for x in ids], np.int64)
                starts = before + np.cumsum(sizes) - sizes
                before += int(sizes.sum())
                flat = np.concatenate([y for x in ids for y in (x, end)])
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(run.start, run.stop - run.start),
                        pa.array(np.full(len(ids), part, np.int32)),
                        pa.array(starts),
                        pa.array(sizes),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    ],
                    names=["doc_id", "part", "part_start", "n_tokens", "ids"],
                )

    return encode


def write_tokens(
    docs: DataFrame,
    path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = 0,
    encoding: str = "dictionary",
    row_group_bytes: int = 16 << 20,
    page_bytes: int = 256 << 10,
    page_rows: int = 2_000,
) -> None:
    """Encode all documents and write them to path in ascending order of id.

    encoding is "dictionary" or "delta" and holds for the ids; the numbers beside them
    are always delta encoded.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding {encoding!r}")
    spark = docs.sparkSession
    keyed = with_row_key(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    order = ["doc_id", FILE, ROW]  # repeated ids spread over ranges
    ordered = keyed.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    encoded = ordered.select("doc_id", "text").mapInArrow(_encode_ordered(tokenizer, end_id), SCHEMA)
    (
        encoded.write.option("parquet.block.size", str(row_group_bytes))
        .option("parquet.page.size", str(page_bytes))
        .option("parquet.page.row.count.limit", str(page_rows))
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", "false")
        .option("parquet.enable.dictionary#ids.list.element", str(encoding == "dictionary").lower())
        .parquet(path)
    )


def read_tokens(
    spark: SparkSession, path: str, columns: tuple[str, ...] = ("doc_id", "start", "n_tokens", "ids")
) -> DataFrame:
    """Read token files back; start counts the ids of all documents before a row's.

    Only the columns asked for are read, and a filter on doc_id reaches the files.
    """
    files = spark.read.schema(SCHEMA).parquet(path)
    if "start" not in columns:
        return files.select(*columns)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        files.groupBy("part")
        .agg(F.sum("n_tokens").alias("tokens"))
        .select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("first"))
    )
    # One row per written range, so small at any size of the input.
    placed = files.join(F.broadcast(firsts), "part")
    return placed.withColumn("start", F.col("first") + F.col("part_start")).select(*columns)


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        values = ids.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
        ends = ids.offsets.to_numpy().tolist()
        crc = [zlib.crc32(values[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
        rest = [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
        yield pa.RecordBatch.from_arrays(
            [*rest, pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
        )


def token_digests(tokens: DataFrame) -> DataFrame:
    """Per document the unsigned crc32 of its ids as little-endian unsigned 32-bit numbers."""
    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        _checksums, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
