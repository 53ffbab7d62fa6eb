"""Exact interpolated quantiles without gathering a group in one task."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_BITS = 20


def quantile_per_group(
    df: DataFrame,
    group: str,
    value: str,
    fraction: float,
    out: str,
    store,
    name: str,
    summaries: dict[str, tuple[Callable[[str], Column], str]] | None = None,
) -> DataFrame:
    """The continuous quantile of a two-decimal value for every group.

    The two neighbouring order statistics are found by counting: first the
    slice of 2^20 cents that holds each position, then the value inside that
    slice. The input is only ever counted with map-side combine; the windows
    run over counts. The slice counts are written, so that Spark knows their
    size when it picks the second join.

    summaries maps further output columns to an aggregate that can be applied
    again to its own results (sum, min, max) and its input column; they come
    from the same pass as the slice counts. Rows without a value count there,
    but not for the quantile.
    """
    summaries = summaries or {}
    cents = df.withColumn("_cents", (F.col(value) * 100).cast("bigint"))
    cents = cents.withColumn("_slice", F.shiftright("_cents", SLICE_BITS))
    slices = store.keep(
        f"{name}_slices",
        cents.groupBy(group, "_slice").agg(
            F.count("_cents").alias("_rows"),
            *[combine(column).alias(label) for label, (combine, column) in summaries.items()],
        ),
    )
    summary = slices.groupBy(group).agg(
        F.count(F.lit(1)).alias("_slices"),
        *[combine(label).alias(label) for label, (combine, _) in summaries.items()],
    )

    by_slice = Window.partitionBy(group).orderBy("_slice")
    counted = slices.where("_slice IS NOT NULL").select(
        group,
        "_slice",
        "_rows",
        F.sum("_rows").over(by_slice.rowsBetween(Window.unboundedPreceding, 0)).alias("_until"),
        F.sum("_rows").over(Window.partitionBy(group)).alias("_all"),
    )
    exact = F.lit(fraction) * (F.col("_all") - 1)
    counted = counted.withColumns(
        {"_low": F.floor(exact), "_high": F.ceil(exact), "_share": exact - F.floor(exact)}
    )

    def holds(position: str) -> Column:
        return (F.col("_until") > F.col(position)) & (
            F.col("_until") - F.col("_rows") <= F.col(position)
        )

    wanted = counted.where(holds("_low") | holds("_high")).select(
        group,
        "_slice",
        (F.col("_until") - F.col("_rows")).alias("_before"),
        "_low",
        "_high",
        "_share",
    )
    values = (
        cents.join(wanted, [group, "_slice"])
        .groupBy(group, "_slice", "_cents", "_before", "_low", "_high", "_share")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    by_value = Window.partitionBy(group, "_slice").orderBy("_cents")
    values = values.withColumn(
        "_until",
        F.col("_before")
        + F.sum("_rows").over(by_value.rowsBetween(Window.unboundedPreceding, 0)),
    )
    ends = values.groupBy(group, "_share").agg(
        F.max(F.when(holds("_low"), F.col("_cents"))).alias("_a"),
        F.max(F.when(holds("_high"), F.col("_cents"))).alias("_b"),
    )
    position = F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_share")
    quantiles = ends.select(group, (position / 100).cast("decimal(38,10)").alias(out))
    return summary.drop("_slices").join(quantiles, group, "left")
