"""One row per key."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(
    df: DataFrame, key: Column, order_by: list[str], collation: str | None = None
) -> DataFrame:
    """Keep the first row of every key, NULLs last; texts of order_by in a collation or by bytes.

    All other columns break ties, so the survivor does not depend on file order.
    Catalyst limits each group before the shuffle (WindowGroupLimit), so a key
    that holds most of the rows sends one row per task.
    """
    ties = [c for c in df.columns if c not in order_by]
    # Texts that a collation takes for equal are told apart by their bytes.
    first = [F.collate(c, collation) for c in order_by] if collation else []
    ordering = [c.asc_nulls_last() for c in (*first, *map(F.col, [*order_by, *ties]))]
    place = F.row_number().over(Window.partitionBy(key).orderBy(*ordering))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")
