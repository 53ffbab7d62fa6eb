"""Helpers shared by the operators: stored intermediates, row keys, dense positions."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
import zipfile
from pathlib import Path

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tallyhouse
from tallyhouse.plans.store import Files, shared_folder

FILE, ROW = "__file", "__row"
PART, POSITION = "__part", "__position"

#: Characters that separate words: space and the control characters 9 to 13.
WORD = "[^\\x20\\x09-\\x0D]+"


_roots: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one; every write gets its own, so plans never clash.

    An application's folders lie in one that is removed when its process ends.
    """
    application = spark.sparkContext.applicationId
    if application not in _roots:
        _roots[application] = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
        atexit.register(_remove, Files(spark), _roots[application])
    return f"{_roots[application]}/{name}-{uuid.uuid4().hex}"


def _remove(files: Files, folder: str) -> None:
    with contextlib.suppress(Py4JError, OSError):  # the JVM may be gone already
        files.delete(folder)


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a table to the shared folder and read it back: durable, cuts the lineage.

    Options are those of the Parquet writer.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, through Spark."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(tallyhouse.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="tallyhouse-")) / "tallyhouse.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc32_of(value: Column) -> Column:
    """Unsigned crc32 of a value's text."""
    return F.crc32(value.cast("string").cast("binary"))


def held_out(doc_id: Column) -> Column:
    """True for the fifth of ids that no model learns from; a null id is never held out."""
    return F.coalesce(crc32_of(doc_id) % 5 == 0, F.lit(False))


def free_name(df: DataFrame, name: str) -> str:
    """The name, or with underscores before it if the frame has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_row_key(df: DataFrame, file: str = FILE, row: str = ROW) -> DataFrame:
    """Add two columns, FILE and ROW if not said otherwise, which name a stored row.

    They stay the same in every later scan.

    Rows that do not come straight from files are stored first. Repeated rows and
    repeated or null ids thus stay apart.
    """
    ship_package(df.sparkSession)
    kept = on_files(df)
    hidden = kept.metadataColumn("_metadata")
    return kept.select(
        "*",
        F.xxhash64(hidden["file_path"]).alias(file),
        hidden["row_index"].alias(row),
    )


def on_files(df: DataFrame) -> DataFrame:
    """df itself if its rows come straight from files, else a stored copy.

    Two uses of the result with_row_key give the same keys.
    """
    try:
        df.select(df.metadataColumn("_metadata")["row_index"])
    except AnalysisException:
        return stored(df, "rows")
    return df


def numbered(
    df: DataFrame, order: list[str], name: str, sums: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """Number rows densely from 0 in a total order, without a global window.

    Rows are dealt by ranges of the order and stored with their place in the range; the
    first number of each range then comes from one count per range. For each column in
    sums, the sum over all rows before comes as <column>_before. Returns the rows with
    the column `index`, and the ranges (one row per partition).

    The order must end in columns that tell rows apart, so that equal values spread.
    """
    ranged = df.repartitionByRange(partitions(df.sparkSession), *order).sortWithinPartitions(*order)
    placed = stored(
        ranged.withColumn(PART, F.spark_partition_id()).withColumn(
            POSITION, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
        ),
        name,
    )
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy(PART).agg(
        F.count("*").alias("rows"), *[F.sum(c).alias(f"{c}_sum") for c in sums]
    )
    firsts = ranges.select(
        PART,
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"),
        *[F.coalesce(F.sum(f"{c}_sum").over(before), F.lit(0)).alias(f"{c}_first") for c in sums],
    )
    # One row per partition: small at any size of the input.
    index = F.col("first") + F.col(POSITION)
    out = placed.join(F.broadcast(firsts), PART).withColumn("index", index)
    within = (
        Window.partitionBy(PART).orderBy(POSITION).rowsBetween(Window.unboundedPreceding, -1)
    )
    for c in sums:
        out = out.withColumn(
            f"{c}_before", F.col(f"{c}_first") + F.coalesce(F.sum(c).over(within), F.lit(0))
        )
    return out.drop(PART, POSITION, "first", *[f"{c}_first" for c in sums]), ranges


def empty_like(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], T.StructType.fromDDL(schema))
