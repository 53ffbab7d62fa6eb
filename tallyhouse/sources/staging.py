"""From input files to staging tables: read, clean, type, stamp, store."""

import logging
from collections import Counter
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.sources.specs import SourceSpec

log = logging.getLogger(__name__)

# A decimal number as text, with or without an exponent.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


class StagingError(RuntimeError):
    """Some sources failed; the others were loaded."""

    def __init__(self, failures: dict[str, Exception]):
        super().__init__(f"{len(failures)} staging source(s) failed: {', '.join(failures)}")
        self.failures = failures


def normalize_columns(df: DataFrame) -> DataFrame:
    """Trimmed lower-case column names with underscores for spaces."""
    names = [c.strip().lower().replace(" ", "_") for c in df.columns]
    repeated = [name for name, n in Counter(names).items() if n > 1]
    if repeated:
        raise ValueError(f"columns that become equal once normalized: {', '.join(repeated)}")
    return df.toDF(*names)


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop the rows in which every column is NULL (or NaN)."""
    return df.na.drop("all")


def add_audit_columns(df: DataFrame, source_file: str) -> DataFrame:
    return df.withColumns(
        {"etl_loaded_at": F.current_timestamp(), "etl_source_file": F.lit(source_file)}
    )


def to_timestamp_safe(value: Column) -> Column:
    """NULL where the text is not a timestamp."""
    return value.try_cast("timestamp_ntz")


def to_number_safe(value: Column) -> Column:
    """NULL where the text is not a decimal number."""
    return F.when(value.cast("string").rlike(NUMBER), value.try_cast("double"))


def blank_tokens(df: DataFrame, tokens: Iterable[str]) -> DataFrame:
    """NULL for the texts that mean a missing cell."""
    tokens = list(tokens)
    if not tokens:
        return df
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(
        *[F.when(~F.col(c).isin(tokens), F.col(c)).alias(c) if c in texts else F.col(c) for c in df.columns]
    )


def apply_schema(df: DataFrame, schema: str, safe: bool) -> DataFrame:
    """Cast the declared columns. A bad value fails the load, or is NULL when safe."""
    if not schema:
        return df
    declared = T.StructType.fromDDL(schema)
    missing = [f.name for f in declared if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    types = {f.name: f.dataType for f in declared}
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}

    def typed(name: str) -> Column:
        if name not in types:
            return F.col(name)
        column = F.col(name)
        cast = (column.try_cast if safe else column.cast)(types[name])
        if name in texts and isinstance(types[name], T.NumericType):
            # A cast alone also reads suffixes and hexadecimal digits as numbers.
            message = F.concat(F.lit(f"{name} is not a number: "), column)
            wrong = F.lit(None) if safe else F.raise_error(message)
            cast = F.when(column.isNull() | column.rlike(NUMBER), cast).otherwise(wrong)
        return cast.alias(name)

    return df.select(*[typed(c) for c in df.columns])


def read_source(spark: SparkSession, spec: SourceSpec, safe: bool = False) -> DataFrame:
    """One source, cleaned and typed. Text files are read as text: one pass, no inference.

    Columns of csv files are taken by name, whatever their order in each file of a
    folder; a row with more or fewer cells than its header fails the load. JSON lines
    are taken by their keys; only a source that declares no columns is read once more
    to learn them.
    """
    reader = spark.read.format(spec.format)
    if spec.format == "csv":
        raw = _csv_files(spark, spec)
    elif spec.format == "json" and spec.schema and not spec.options:
        raw = _json_lines(spark, spec)
    elif spec.format == "json":
        raw = normalize_columns(reader.options(primitivesAsString=True, **spec.options).load(spec.path))
    else:
        raw = normalize_columns(reader.options(**spec.options).load(spec.path))
    cleaned = drop_empty_rows(blank_tokens(raw, spec.null_tokens))
    return add_audit_columns(apply_schema(cleaned, spec.schema, safe), spec.file_name)


def header_census(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files of a folder, or the file itself, by their first line; empty files are left out.

    One Spark job. Each task has one file, however large, and stops reading after its
    first rows; the driver opens none and gets one row per header.
    """

    # Defined here, it is sent to the executors whole: they need not have this package.
    def first_row(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    # A session of its own, so that no other query sees these settings.
    single = spark.newSession()
    whole = str(1 << 60)
    for key, value in {
        "spark.sql.files.maxPartitionBytes": whole,
        "spark.sql.files.openCostInBytes": whole,  # no second file fits beside one
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "16",
    }.items():
        single.conf.set(key, value)
    lines = single.read.text(path).select("value", F.col("_metadata.file_path").alias("path"))
    firsts = lines.mapInArrow(first_row, "value string, path string")
    # Paths are what Spark's own file listing holds on the driver as well.
    # The column holds paths as URIs, in which a plus sign stands for itself.
    path_text = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))
    found = firsts.groupBy("value").agg(F.sort_array(F.collect_list(path_text)).alias("paths"))
    return {row["value"]: row["paths"] for row in found.collect()}


def _csv_files(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Files of equal headers are read together, then united by normalized names."""
    by_header = header_census(spark, spec.path)
    options = {"header": True, "inferSchema": False, "enforceSchema": False, "mode": "FAILFAST"}
    reader = spark.read.format("csv").options(**options).options(**spec.options)
    read = [normalize_columns(reader.load(by_header[h])) for h in sorted(by_header)]
    read = read or [normalize_columns(reader.load(spec.path))]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), read)


def _json_lines(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Declared columns of JSON lines, found by their normalized keys."""
    names = [f.name for f in T.StructType.fromDDL(spec.schema)]
    cells = F.from_json("value", "map<string,string>", {"mode": "FAILFAST"})
    tidy = F.transform_keys(cells, lambda k, _: F.replace(F.lower(F.trim(k)), F.lit(" "), F.lit("_")))
    lines = spark.read.text(spec.path).where(F.trim("value") != "").select(tidy.alias("cells"))
    return lines.select(*[F.col("cells")[name].alias(name) for name in names])


def load_staging(
    spark: SparkSession, specs: Iterable[SourceSpec], store, safe: bool = False
) -> dict[str, DataFrame]:
    """Replace every staging table; try all sources before reporting the failed ones."""
    tables: dict[str, DataFrame] = {}
    failures: dict[str, Exception] = {}
    for spec in specs:
        seen = Observation(spec.table)
        try:
            staged = read_source(spark, spec, safe).observe(seen, F.count(F.lit(1)).alias("rows"))
            tables[spec.table] = store.save("staging", spec.table, staged)
            log.info("loaded %s: %d rows from %s", spec.table, seen.get["rows"], spec.path)
        except Exception as error:
            log.exception("could not load %s from %s", spec.table, spec.path)
            failures[spec.table] = error
    if failures:
        raise StagingError(failures)
    return tables
