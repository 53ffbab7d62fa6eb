"""Currency mix and the effect of exchange rates."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.dates import month_label, month_start
from tallyhouse.functions.money import (
    TOTAL,
    change,
    fixed,
    percent,
    percent_of_rate,
    ratio,
    total,
)
from tallyhouse.functions.stats import correlation
from tallyhouse.functions.text import labelled
from tallyhouse.plans.marts.products import margin_columns
from tallyhouse.plans.rollups import distinct_invoices

# Currency codes and their names.
CURRENCY_NAMES = {"BS": "Bolívares", "USD": "Dólares", "COP": "Pesos colombianos"}


def _with_currency(sales_by_day: DataFrame, dim_moneda: DataFrame) -> DataFrame:
    return sales_by_day.join(dim_moneda.withColumnRenamed("codigo", "moneda"), "sk_moneda")


def currency_mix(sales_by_day: DataFrame, dim_moneda: DataFrame) -> DataFrame:
    """Share of every currency by revenue, invoices and units."""
    mix = (
        _with_currency(sales_by_day, dim_moneda)
        .groupBy("moneda")
        .agg(
            distinct_invoices().alias("nro_facturas"),
            F.sum("unidades").alias("unidades_vendidas"),
            total(F.col("ingreso")).alias("ingreso_usd"),
        )
    )
    code = F.col("moneda")

    def share(measure: str):
        return percent(F.col(measure), F.sum(measure).over(Window.partitionBy()))

    return mix.select(
        "moneda",
        labelled(code, CURRENCY_NAMES, code).alias("moneda_nombre"),
        "nro_facturas",
        "unidades_vendidas",
        "ingreso_usd",
        ratio(F.col("ingreso_usd"), F.col("nro_facturas")).alias("ticket_promedio_usd"),
        share("ingreso_usd").alias("pct_por_monto"),
        share("nro_facturas").alias("pct_por_nro_facturas"),
        share("unidades_vendidas").alias("pct_por_unidades"),
    )


def currency_mix_monthly(
    sales_by_day: DataFrame, dim_tiempo: DataFrame, dim_moneda: DataFrame
) -> DataFrame:
    months = (
        _with_currency(sales_by_day, dim_moneda)
        .join(dim_tiempo.select("sk_fecha", "fecha"), "sk_fecha")
        .groupBy(month_start("fecha").alias("mes_inicio"), "moneda")
        .agg(
            distinct_invoices().alias("nro_facturas"),
            total(F.col("ingreso")).alias("ingreso_usd"),
        )
    )
    of_month = F.sum("ingreso_usd").over(Window.partitionBy("mes_inicio"))
    return months.select(
        month_label("mes_inicio").alias("mes"),
        "mes_inicio",
        "moneda",
        "nro_facturas",
        "ingreso_usd",
        percent(F.col("ingreso_usd"), of_month).alias("pct_del_mes"),
    )


def _monthly_rates(dim_tiempo: DataFrame) -> DataFrame:
    """Mean and range of the rates of all days that the calendar has of a month."""
    return dim_tiempo.groupBy(month_start("fecha").alias("mes_inicio")).agg(
        fixed(F.avg("tasa_bs_usd"), 4).alias("tasa_bs_usd_prom"),
        fixed(F.min("tasa_bs_usd"), 4).alias("tasa_bs_usd_min"),
        fixed(F.max("tasa_bs_usd"), 4).alias("tasa_bs_usd_max"),
        fixed(F.avg("cop_por_usd"), 4).alias("cop_por_usd_prom"),
    )


def fx_monthly(
    sales_by_day: DataFrame, dim_tiempo: DataFrame, dim_moneda: DataFrame
) -> DataFrame:
    """Rates, revenue, margin and currency exposure per month, with changes."""
    revenue = F.col("ingreso")

    def collected_in(code: str):
        return total(F.when(F.col("moneda") == code, revenue))

    exposed = total(F.when(F.col("moneda") != "USD", revenue))
    sales = (
        _with_currency(sales_by_day, dim_moneda)
        .join(dim_tiempo.select("sk_fecha", "fecha"), "sk_fecha")
        .groupBy(month_start("fecha").alias("mes_inicio"))
        .agg(
            distinct_invoices().alias("nro_facturas"),
            F.sum("unidades").alias("unidades_vendidas"),
            total(revenue).alias("ingreso_usd"),
            total(F.col("costo")).alias("costo_usd"),
            collected_in("BS").alias("ingreso_usd_cobrado_en_bs"),
            collected_in("USD").alias("ingreso_usd_cobrado_en_usd"),
            collected_in("COP").alias("ingreso_usd_cobrado_en_cop"),
            F.coalesce(exposed, F.lit(0).cast(TOTAL)).alias("expuesto"),
        )
    )
    margin = margin_columns(F.col("ingreso_usd"), F.col("costo_usd"))
    months = (
        sales.join(_monthly_rates(dim_tiempo), "mes_inicio")
        .select(
            month_label("mes_inicio").alias("mes"),
            "mes_inicio",
            "tasa_bs_usd_prom",
            "tasa_bs_usd_min",
            "tasa_bs_usd_max",
            "cop_por_usd_prom",
            "nro_facturas",
            "unidades_vendidas",
            "ingreso_usd",
            "costo_usd",
            margin["margen_usd"].alias("margen_usd"),
            margin["margen_pct"].alias("margen_pct"),
            "ingreso_usd_cobrado_en_bs",
            "ingreso_usd_cobrado_en_usd",
            "ingreso_usd_cobrado_en_cop",
            percent(F.col("expuesto"), F.col("ingreso_usd")).alias("pct_ingreso_expuesto_a_fx"),
        )
    )
    # One row per month: a single sorted partition of calendar size.
    by_month = Window.orderBy("mes_inicio")

    def moved(measure: str):
        return change(F.col(measure), F.lag(measure).over(by_month))

    points = F.col("margen_pct") - F.lag("margen_pct").over(by_month)
    spread = F.col("tasa_bs_usd_max") - F.col("tasa_bs_usd_min")
    return months.select(
        "*",
        moved("tasa_bs_usd_prom").alias("var_pct_tasa_bs_usd"),
        moved("cop_por_usd_prom").alias("var_pct_tasa_cop_usd"),
        moved("ingreso_usd").alias("var_pct_ingreso_usd"),
        moved("margen_usd").alias("var_pct_margen_usd"),
        points.cast("decimal(18,2)").alias("delta_puntos_margen_pct"),
        percent_of_rate(spread, F.col("tasa_bs_usd_min")).alias("amplitud_pct_tasa_bs_en_el_mes"),
    )


def fx_correlation(fx_monthly: DataFrame) -> DataFrame:
    """How the monthly devaluation goes together with the results of the month."""
    devaluation = F.col("var_pct_tasa_bs_usd")

    def against(measure: str, name: str):
        return fixed(correlation(devaluation, F.col(measure)), 4).alias(name)

    return fx_monthly.agg(
        F.count(devaluation).alias("meses_comparables"),
        against("var_pct_ingreso_usd", "corr_devaluacion_vs_var_ingreso"),
        against("var_pct_margen_usd", "corr_devaluacion_vs_var_margen"),
        against("delta_puntos_margen_pct", "corr_devaluacion_vs_delta_margen_pct"),
        against("pct_ingreso_expuesto_a_fx", "corr_devaluacion_vs_exposicion_fx"),
    )


def margin_by_currency(sales_by_day: DataFrame, dim_moneda: DataFrame) -> DataFrame:
    by_currency = (
        _with_currency(sales_by_day, dim_moneda)
        .groupBy("moneda")
        .agg(
            distinct_invoices().alias("nro_facturas"),
            F.sum("unidades").alias("unidades_vendidas"),
            total(F.col("ingreso")).alias("ingreso_usd"),
            total(F.col("costo")).alias("costo_usd"),
            total(F.col("lista")).alias("lista"),
        )
    )
    margin = margin_columns(F.col("ingreso_usd"), F.col("costo_usd"))
    return by_currency.select(
        "moneda",
        "nro_facturas",
        "unidades_vendidas",
        "ingreso_usd",
        "costo_usd",
        margin["margen_usd"].alias("margen_usd"),
        margin["margen_pct"].alias("margen_pct"),
        percent(F.col("ingreso_usd") - F.col("lista"), F.col("lista")).alias(
            "desvio_pct_vs_precio_lista_usd"
        ),
    )
