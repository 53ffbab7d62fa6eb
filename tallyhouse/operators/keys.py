"""Dense surrogate keys in row order, without a global window."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Spark names a written file by its task and by its place among the task's files.
TASK, FILE_OF_TASK = r"part-(\d+)-", r"-c(\d+)"


def in_order(rows: DataFrame, order_by: list[str]) -> DataFrame:
    """Rows dealt by ranges of the order and sorted in them, NULLs last.

    Written as they are, the files follow each other in that order. rows has to read a
    stored table without a shuffle in between, so that it can be read twice alike. Rows
    that are equal in every ordering column may be many; their position in the input
    spreads them.
    """
    ordering = [F.asc_nulls_last(c) for c in order_by]
    return (
        rows.withColumn("_copy", F.monotonically_increasing_id())
        .repartitionByRange(*ordering, "_copy")
        .drop("_copy")
        .sortWithinPartitions(*ordering)
    )


def file_offsets(written: DataFrame) -> DataFrame:
    """Per file of a table written in order: its name and the rows of all files before it.

    Counting rows reads no column, only the files' footers. One row per file.
    """
    name = written.metadataColumn("_metadata")["file_name"].alias("_file")
    sizes = written.select(name).groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    place = [F.regexp_extract("_file", x, 1).try_cast("bigint") for x in (TASK, FILE_OF_TASK)]
    earlier = Window.orderBy(*place, "_file").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("_file", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))


def with_keys(written: DataFrame, offsets: DataFrame, key: str) -> DataFrame:
    """Number the rows of a table written in order: its file's offset plus the row's place.

    The written files are the table; nothing is written again. Offsets have one row per
    file, which bounds what is broadcast.
    """
    hidden = written.metadataColumn("_metadata")
    placed = written.select(
        "*", hidden["file_name"].alias("_file"), hidden["row_index"].alias("_index")
    )
    return placed.join(F.broadcast(offsets), "_file").select(
        (F.col("_offset") + F.col("_index") + 1).alias(key), *written.columns
    )


def assign_keys(rows: DataFrame, order_by: list[str], key: str, store, name: str) -> DataFrame:
    """Number the rows 1..n in the given order (NULLs last).

    Rows are range-partitioned and sorted once and written, so that both the counts per
    file and the numbered rows come from the same stored rows even if an executor is lost
    in between.
    """
    written = store.keep(f"{name}_placed", in_order(rows, order_by))
    return with_keys(written, store.keep(f"{name}_offsets", file_offsets(written)), key)
