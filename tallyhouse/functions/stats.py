"""Statistics with NULL instead of an error for degenerate input."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def correlation(y: Column, x: Column) -> Column:
    """Pearson correlation over complete pairs; NULL for a constant series."""
    both = x.isNotNull() & y.isNotNull()
    xs = F.when(both, x.cast("double"))
    ys = F.when(both, y.cast("double"))
    spread = F.nullif(F.stddev_pop(xs) * F.stddev_pop(ys), F.lit(0.0))
    return F.covar_pop(xs, ys) / spread
