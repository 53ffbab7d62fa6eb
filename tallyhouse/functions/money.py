"""Rounding policy for amounts, ratios and counts.

Doubles are first cast to ten decimals, which drops binary noise, and only then
rounded half away from zero. Ratios are divided as decimals, never as doubles.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

TOTAL = "decimal(24,2)"


def money(value: Column, precision: int = 14) -> Column:
    """Amount with two decimals; NULL when it does not fit the precision."""
    return F.round(value.try_cast("decimal(38,10)"), 2).try_cast(f"decimal({precision},2)")


def whole(value: Column) -> Column:
    """Integer rounded like a database assignment, not truncated like a cast."""
    return F.rint(value).try_cast("int")


def overflows(value: Column, fitted: Column) -> Column:
    """True where a number is given but does not fit its column."""
    return value.isNotNull() & ~F.isnan(value) & fitted.isNull()


def total(value: Column | str) -> Column:
    """Sum of amounts, kept at a precision that can be summed again."""
    return F.sum(value).cast(TOTAL)


def fixed(value: Column, places: int) -> Column:
    return F.round(value.cast("decimal(38,10)"), places).cast(f"decimal(18,{places})")


def quotient(part: Column, base: Column) -> Column:
    """part / base with ten exact decimals, NULL when the base is zero."""
    return (part.cast("decimal(28,2)") / F.nullif(base.cast(TOTAL), F.lit(0).cast(TOTAL))).cast(
        "decimal(38,10)"
    )


def ratio(part: Column, base: Column, places: int = 2) -> Column:
    return fixed(quotient(part, base), places)


def percent(part: Column, base: Column, places: int = 2) -> Column:
    return fixed(quotient(part.cast(TOTAL) * 100, base), places)


def change(now: Column, before: Column) -> Column:
    """Percentage change against an earlier value."""
    return percent_of_rate(now - before, before)


def percent_of_rate(part: Column, base: Column, places: int = 2) -> Column:
    """Like percent, for rates that carry four decimals."""
    part4 = part.cast("decimal(24,4)") * 100
    base4 = F.nullif(base.cast("decimal(24,4)"), F.lit(0).cast("decimal(24,4)"))
    return fixed((part4 / base4).cast("decimal(38,10)"), places)
