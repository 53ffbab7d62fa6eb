"""Lookups that stay balanced when many rows have no key, or very many the same."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NULL_SPREAD = 4096

# A key is heavy if it has more than this share of the rows; so at most 50 are.
HEAVY_SHARE = 0.02
# Keys that a task and the driver keep count of, whatever the number of keys.
COUNTED = 10_000
MOST_COPIES = 1024


def optional_lookup(
    df: DataFrame, dim: DataFrame, key: str, dim_key: str, spread_by: str
) -> DataFrame:
    """Left join that keeps rows without a match and spreads rows without a key.

    The second join column follows from the key where there is one, so matches
    are unchanged; where the key is NULL it comes from another column, so those
    rows hash to many partitions instead of one.
    """

    def slot(column):
        return F.pmod(F.xxhash64(column), F.lit(NULL_SPREAD))

    left = df.withColumn("_slot", F.when(F.col(key).isNull(), slot(spread_by)).otherwise(slot(key)))
    right = dim.withColumnRenamed(dim_key, "_dim_key").withColumn("_dim_slot", slot("_dim_key"))
    matched = left.join(
        right,
        (F.col(key) == F.col("_dim_key")) & (F.col("_slot") == F.col("_dim_slot")),
        "left",
    )
    return matched.drop("_slot", "_dim_slot", "_dim_key")


def heavy_keys(df: DataFrame, key: str) -> list:
    """The keys that more than HEAVY_SHARE of the rows have, at most 50.

    Counted by a sketch of bounded size in one pass over the key column, without a shuffle
    of keys. The sketch may be off by a small part of the share, so a key near the limit
    may be in the list or not; nothing depends on it but the balance of the join.
    """
    top = F.expr(f"approx_top_k({key}, {int(1 / HEAVY_SHARE)}, {COUNTED})")
    # A NULL key meets nothing.
    row = df.where(F.col(key).isNotNull()).agg(top.alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [t["item"] for t in row["top"] or [] if t["count"] > row["n"] * HEAVY_SHARE]


def spread_join(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Inner join on key that stays balanced when few keys have very many rows.

    Rows of a heavy key are dealt to several copies of its partner rows by their place,
    so that equal rows spread as well. There are a few copies for each shuffle partition,
    of at most 50 keys. Every pair of rows meets once, as in a plain join. df has to read
    a stored table without a shuffle in between, so that a row's place stays the same.
    """
    heavy = heavy_keys(df, key)
    if not heavy:
        return df.join(dim, key)
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = min(MOST_COPIES, 4 * partitions)
    is_heavy = F.col(key).isin(heavy)
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(copies)).cast("int")
    left = df.withColumn("_copy", F.when(is_heavy, place).otherwise(0))
    every = F.when(is_heavy, F.sequence(F.lit(0), F.lit(copies - 1))).otherwise(F.array(F.lit(0)))
    right = dim.withColumn("_copy", F.explode(every))
    return left.join(right, [key, "_copy"]).drop("_copy")
