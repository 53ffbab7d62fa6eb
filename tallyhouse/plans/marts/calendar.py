"""Sales over time, by weekday, by kind of day and by holiday."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.dates import stacked_periods
from tallyhouse.functions.money import TOTAL, percent, quotient, ratio, total
from tallyhouse.plans.rollups import distinct_invoices

# Weekday names, Monday first.
WEEKDAYS = ["Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado", "Domingo"]


def sales_evolution(sales_by_day: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    """Four granularities stacked, each with the previous period and a running total."""
    days = sales_by_day.join(dim_tiempo.select("sk_fecha", "fecha"), "sk_fecha")
    stacked = days.withColumn("p", F.explode(stacked_periods(F.col("fecha"))))
    periods = stacked.groupBy("p.granularidad", "p.periodo").agg(
        F.min("p.periodo_inicio").alias("periodo_inicio"),
        distinct_invoices().alias("nro_facturas"),
        F.count_distinct("fecha").alias("dias_con_ventas"),
        F.sum("unidades").alias("unidades_vendidas"),
        total(F.col("ingreso")).alias("ingreso_usd"),
        (total(F.col("ingreso")) - total(F.col("costo"))).cast(TOTAL).alias("margen_usd"),
    )
    by_period = Window.partitionBy("granularidad").orderBy("periodo_inicio")
    so_far = by_period.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    revenue = F.col("ingreso_usd")
    before = F.lag("ingreso_usd").over(by_period)
    return periods.select(
        "granularidad",
        "periodo",
        "periodo_inicio",
        "nro_facturas",
        "dias_con_ventas",
        "unidades_vendidas",
        "ingreso_usd",
        "margen_usd",
        ratio(revenue, F.col("nro_facturas")).alias("ticket_promedio_usd"),
        before.alias("ingreso_usd_periodo_anterior"),
        percent(revenue - before, before).alias("variacion_pct_vs_periodo_anterior"),
        total_over(revenue, so_far).alias("ingreso_acumulado_usd"),
    )


def total_over(value, window):
    return F.sum(value).over(window).cast(TOTAL)


def _day_measures() -> list:
    return [
        F.count_distinct("fecha").alias("dias_con_ventas"),
        distinct_invoices().alias("nro_facturas"),
        F.sum("unidades").alias("unidades_vendidas"),
        total(F.col("ingreso")).alias("ingreso_usd"),
    ]


def _day_ratios() -> list:
    revenue = F.col("ingreso_usd")
    everything = F.sum("ingreso_usd").over(Window.partitionBy())
    return [
        ratio(revenue, F.col("dias_con_ventas")).alias("ingreso_prom_por_dia_usd"),
        ratio(revenue, F.col("nro_facturas")).alias("ticket_promedio_usd"),
        percent(revenue, everything).alias("pct_del_ingreso_total"),
    ]


def sales_by_weekday(sales_by_day: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    weekdays = (
        sales_by_day.join(dim_tiempo, "sk_fecha")
        .groupBy("dia_semana")
        .agg(F.bool_or("es_fin_de_semana").alias("es_fin_de_semana"), *_day_measures())
    )
    names = F.array(*[F.lit(n) for n in WEEKDAYS])
    per_day = quotient(F.col("ingreso_usd"), F.col("dias_con_ventas"))
    # Seven rows at most from here on.
    return weekdays.select(
        "dia_semana",
        F.get(names, F.col("dia_semana") - 1).alias("nombre_dia"),
        "es_fin_de_semana",
        "dias_con_ventas",
        "nro_facturas",
        "unidades_vendidas",
        "ingreso_usd",
        *_day_ratios(),
        F.rank()
        .over(Window.orderBy(F.col("ingreso_usd").desc_nulls_first()))
        .cast("bigint")
        .alias("ranking_ingreso_total"),
        F.rank()
        .over(Window.orderBy(per_day.desc_nulls_first()))
        .cast("bigint")
        .alias("ranking_ingreso_promedio"),
    )


def sales_by_day_type(sales_by_day: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    """A holiday counts as such even on a weekend."""
    kind = (
        F.when(F.col("es_feriado"), "FERIADO")
        .when(F.col("es_fin_de_semana"), "FIN DE SEMANA")
        .otherwise("DIA LABORABLE")
    )
    return (
        sales_by_day.join(dim_tiempo, "sk_fecha")
        .groupBy(kind.alias("tipo_dia"))
        .agg(*_day_measures())
        .select("*", *_day_ratios())
    )


def sales_by_holiday(sales_by_day: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    return (
        sales_by_day.join(dim_tiempo.where("es_feriado"), "sk_fecha")
        .groupBy("nombre_feriado")
        .agg(
            *_day_measures(),
            F.min("fecha").alias("primera_fecha"),
            F.max("fecha").alias("ultima_fecha"),
        )
        .select(
            "nombre_feriado",
            "dias_con_ventas",
            "primera_fecha",
            "ultima_fecha",
            "nro_facturas",
            "unidades_vendidas",
            "ingreso_usd",
            ratio(F.col("ingreso_usd"), F.col("dias_con_ventas")).alias("ingreso_prom_por_dia_usd"),
        )
    )
