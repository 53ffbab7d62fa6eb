"""Calendar helpers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_weekday(day: Column) -> Column:
    """1 is Monday, 7 is Sunday."""
    return (F.weekday(day) + 1).cast("int")


def iso_week_label(day: Column) -> Column:
    year = F.extract(F.lit("YEAROFWEEK"), day).cast("string")
    return F.concat(year, F.lit("-S"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def month_label(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def stacked_periods(day: Column) -> Column:
    """The day, ISO week, month and year of a date, as one array of structs.

    Exploding it stacks the four granularities from one scan of the input.
    """

    def period(tag: str, start: Column, label: Column) -> Column:
        return F.struct(
            F.lit(tag).alias("granularidad"), start.alias("periodo_inicio"), label.alias("periodo")
        )

    return F.array(
        period("DIA", day, F.date_format(day, "yyyy-MM-dd")),
        period("SEMANA", F.trunc(day, "week"), iso_week_label(day)),
        period("MES", month_start(day), month_label(day)),
        period("ANIO", F.trunc(day, "year"), F.date_format(day, "yyyy")),
    )
