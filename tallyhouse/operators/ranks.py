"""Rows within the first k places of any of several measures, with exact ranks."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Width, in bits, of the value slices that the ranks are counted by.
SLICES = (40, 20, 0)


def top_by_any(df: DataFrame, ranks: dict[str, str], k: int, store, name: str) -> DataFrame:
    """Keep rows whose rank by any measure is at most k; ties are all kept.

    ranks maps a rank column to an integer or two-decimal measure. NULL is the
    largest value, as everywhere: rows without a measure share its first place.
    The input never goes through one sorted partition. All measures are stacked
    into one column, so that every step handles them together: the k-th best
    values, found from k rows of each task, select the candidates; those are
    stored so that their size is known; then greater rows are counted by slices
    of values, all measures in one aggregate per level.
    """
    values = [(F.col(m) * 100).cast("bigint") for m in ranks.values()]

    def stacked(rows: DataFrame, *keep: str) -> DataFrame:
        cells = [F.struct(F.lit(i).alias("_m"), v.alias("_v")) for i, v in enumerate(values)]
        return rows.select(*keep, F.inline(F.array(*cells)))

    everyone = stacked(df)
    best = Window.partitionBy("_m").orderBy(F.col("_v").desc_nulls_first())
    first = everyone.withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= k)
    least = first.agg(
        F.struct(*[F.min(F.when(F.col("_m") == i, F.col("_v"))) for i in range(len(values))])
    ).scalar()

    def among_best(i: int) -> Column:
        enough = values[i] >= least.getField(f"col{i + 1}")
        return values[i].isNull() | F.coalesce(enough, F.lit(False))

    candidates = df.where(reduce(Column.__or__, map(among_best, range(len(values)))))
    chosen = store.keep(
        f"{name}_chosen", candidates.withColumn("_row", F.monotonically_increasing_id())
    )
    places = _places(stacked(chosen, "_row"), everyone)
    wide = places.groupBy("_row").agg(
        *[F.max(F.when(F.col("_m") == i, F.col("_rank"))).alias(r) for i, r in enumerate(ranks)]
    )
    # A row may be a candidate where NULLs alone fill the first k places.
    inside = reduce(Column.__or__, [F.col(r) <= k for r in ranks])
    return chosen.join(wide.where(inside), "_row").drop("_row")


def _places(chosen: DataFrame, everyone: DataFrame) -> DataFrame:
    """_rank of each chosen (_row, _m, _v): 1 + number of values of everyone above it.

    Greater values are counted slice by slice: those in a higher top slice, those
    in the same top slice but a higher middle slice, and so on. NULLs are a slice
    of their own, above all others. Every window runs over at most 2^20 slice
    counts, and only slices that hold a chosen value are refined.
    """

    def slice_of(bits: int) -> Column:
        return F.shiftright("_v", bits)

    placed = chosen.withColumn("_rank", F.lit(1).cast("bigint"))
    outer = None
    for bits in SLICES:
        pool = everyone.select("_m", "_v")
        # The first level has no slice around it; no value is NULL further in.
        around = F.lit(0).cast("bigint") if outer is None else slice_of(outer)
        if outer is not None:
            wanted = chosen.select("_m", around.alias("_outer")).distinct()
            pool = pool.withColumn("_outer", around).join(wanted, ["_m", "_outer"], "left_semi")
        counts = pool.groupBy("_m", around.alias("_outer"), slice_of(bits).alias("_slice")).agg(
            F.count(F.lit(1)).alias("_rows")
        )
        above = (
            Window.partitionBy("_m", "_outer")
            .orderBy(F.col("_slice").desc_nulls_first())
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        counts = counts.select("_m", "_slice", F.sum("_rows").over(above).alias("_above"))
        # NULL has no slice to join with and keeps the first place.
        placed = (
            placed.withColumn("_slice", slice_of(bits))
            .join(counts, ["_m", "_slice"], "left")
            .withColumn("_rank", F.col("_rank") + F.coalesce("_above", F.lit(0)))
            .drop("_slice", "_above")
        )
        outer = bits
    return placed
