"""Result sets behind the business report, read from the stored marts."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.money import fixed, percent, ratio, total
from tallyhouse.functions.text import amount_text, integer_text, percent_text, shorten
from tallyhouse.plans.marts.products import margin_columns
from tallyhouse.plans.rollups import distinct_invoices

# Margin band in percent and the order in which periods are shown.
BAND = (22.5, 23.5)
GRANULARITIES = ["DIA", "SEMANA", "MES", "ANIO"]
CURRENCIES = ["BS", "USD", "COP"]
# Columns that the currency pivot may have.
MOST_CURRENCIES = 50
HALF_YEAR = 6

COUNTED = {
    "dim_producto": "dim_producto",
    "dim_clientes": "dim_clientes",
    "dim_proveedor": "dim_proveedor",
    "dim_usuarios": "dim_usuarios",
    "dim_tiempo": "dim_tiempo",
    "fact_ventas": "fact_ventas",
    "fact_compras": "fact_compras",
    "fact_mov_inventario": "fact_mov_inventario",
}


def _level(w, level: str) -> DataFrame:
    return w["p04_margen"].where(F.col("nivel") == level)


def _periods(w, granularity: str) -> DataFrame:
    return w["p13_evolucion_ventas"].where(F.col("granularidad") == granularity)


def _largest(df: DataFrame, measure: str, n: int, *ties: str) -> DataFrame:
    return df.orderBy(F.col(measure).desc_nulls_first(), *[F.asc_nulls_last(t) for t in ties]).limit(n)


def _average(value: str) -> Column:
    return ratio(F.sum(value), F.count(value))


# Totals ------------------------------------------------------------------------------


def sales_totals(w) -> DataFrame:
    return (
        w["sales_by_day"]
        .join(w["dim_tiempo"].select("sk_fecha", "fecha"), "sk_fecha")
        .agg(
            F.sum("lineas").alias("lineas"),
            distinct_invoices().alias("facturas"),
            F.sum("unidades").alias("unidades"),
            total(F.col("ingreso")).alias("ingreso_usd"),
            F.min("fecha").alias("desde"),
            F.max("fecha").alias("hasta"),
        )
    )


def table_counts(w) -> DataFrame:
    """Rows per table."""
    w.tables([table for table in COUNTED.values() if table.startswith("dim_")])
    counts = [
        w.counted(table).agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("tabla"), "filas")
        for name, table in COUNTED.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def global_margin(w) -> DataFrame:
    sums = w["sales_by_day"].agg(
        total(F.col("ingreso")).alias("ingreso"), total(F.col("costo")).alias("costo")
    )
    margin = margin_columns(F.col("ingreso"), F.col("costo"))
    return sums.select(
        "ingreso", "costo", margin["margen_usd"].alias("margen"), margin["margen_pct"].alias("margen_pct")
    )


# Best sellers --------------------------------------------------------------------------


def _top_list(w, place: str, flag: str) -> DataFrame:
    return (
        w["p01_top_productos"]
        .where(flag)
        .select(
            F.col(place).alias("rk"),
            "codigo",
            "descripcion",
            "marca",
            "unidades_vendidas",
            "monto_vendido_usd",
            "nro_facturas",
        )
        .orderBy("rk", "codigo")
    )


def top_by_units(w) -> DataFrame:
    return _top_list(w, "ranking_por_cantidad", "top10_por_cantidad")


def top_by_revenue(w) -> DataFrame:
    return _top_list(w, "ranking_por_monto", "top10_por_monto")


def top_overlap(w) -> DataFrame:
    by_units, by_revenue = F.col("top10_por_cantidad"), F.col("top10_por_monto")
    return w["p01_top_productos"].agg(
        F.count_if(by_units & by_revenue).alias("en_ambos"),
        F.count_if(by_units & ~by_revenue).alias("solo_cantidad"),
        F.count_if(by_revenue & ~by_units).alias("solo_monto"),
    )


def rank_gaps(w) -> DataFrame:
    gaps = w["p01_top_productos"].select(
        "codigo",
        "descripcion",
        "unidades_vendidas",
        "monto_vendido_usd",
        "ranking_por_cantidad",
        "ranking_por_monto",
        F.abs(F.col("ranking_por_cantidad") - F.col("ranking_por_monto")).alias("brecha"),
    )
    return _largest(gaps, "brecha", 6, "codigo", "descripcion")


# Margin --------------------------------------------------------------------------------


def margin_top_categories(w) -> DataFrame:
    rows = _level(w, "CATEGORIA").select(
        "categoria",
        "unidades_vendidas",
        "ingreso_usd",
        "costo_mercancia_usd",
        "margen_usd",
        "margen_pct_sobre_ingreso",
    )
    return _largest(rows, "margen_usd", 12, "categoria")


def margin_top_brands(w) -> DataFrame:
    rows = _level(w, "MARCA").select(
        "marca", "unidades_vendidas", "ingreso_usd", "margen_usd", "margen_pct_sobre_ingreso"
    )
    return _largest(rows, "margen_usd", 12, "marca")


def _product_margins(w) -> DataFrame:
    return _level(w, "PRODUCTO").select(
        "codigo",
        "descripcion",
        "marca",
        "unidades_vendidas",
        "ingreso_usd",
        "margen_usd",
        "margen_pct_sobre_ingreso",
    )


def margin_top_products(w) -> DataFrame:
    return _largest(_product_margins(w), "margen_usd", 10, "codigo", "descripcion", "marca")


def margin_losses(w) -> DataFrame:
    losing = _product_margins(w).where("margen_usd < 0")
    return losing.orderBy("margen_usd", "codigo", "descripcion", F.asc_nulls_last("marca")).limit(10)


def margin_stats(w) -> DataFrame:
    margin, pct = F.col("margen_usd"), F.col("margen_pct_sobre_ingreso")
    return _level(w, "PRODUCTO").agg(
        F.count(F.lit(1)).alias("productos"),
        F.count_if(margin < 0).alias("con_perdida"),
        F.count_if(pct.between(*BAND)).alias("en_banda"),
        F.min(pct).alias("pct_min"),
        F.max(pct).alias("pct_max"),
        _average("margen_pct_sobre_ingreso").alias("pct_prom"),
        fixed(F.stddev_pop(pct), 2).alias("pct_desv"),
        total(F.when(margin < 0, margin)).alias("perdida_usd"),
    )


def margin_level_counts(w) -> DataFrame:
    return w["p04_margen"].groupBy("nivel").agg(F.count(F.lit(1)).alias("filas"))


def margin_band_share(w) -> DataFrame:
    inside, products = F.col("en_banda"), F.col("productos")
    return margin_stats(w).select(
        "en_banda",
        "productos",
        (products - inside).alias("fuera_de_banda"),
        percent(inside, products, 1).alias("pct_en_banda"),
    )


# Dead stock ------------------------------------------------------------------------------


def dead_stock_top(w) -> DataFrame:
    rows = (
        w["p06_inventario_muerto"]
        .where("es_inventario_muerto AND capital_inmovilizado_usd > 0")
        .select(
            "codigo",
            "descripcion",
            "marca",
            "stock_actual",
            "costo_usd",
            "capital_inmovilizado_usd",
            "fecha_ultima_venta",
            "dias_sin_vender",
            "clasificacion",
        )
    )
    return _largest(rows, "capital_inmovilizado_usd", 15, "codigo", "descripcion")


def dead_stock_kpi(w) -> DataFrame:
    dead, capital = F.col("es_inventario_muerto"), F.col("capital_inmovilizado_usd")
    return w["p06_inventario_muerto"].agg(
        F.count_if(dead).alias("productos_muertos"),
        total(F.when(dead, capital)).alias("capital_muerto"),
        total(capital).alias("capital_total"),
        F.max("dias_sin_vender").alias("dias_max"),
        F.max("fecha_corte").alias("fecha_corte"),
    )


def dead_capital_share(w) -> DataFrame:
    return dead_stock_kpi(w).select(
        "capital_muerto",
        "capital_total",
        percent(F.col("capital_muerto"), F.col("capital_total"), 1).alias("pct_capital_muerto"),
    )


# Sales over time ---------------------------------------------------------------------------


def evolution_yearly(w) -> DataFrame:
    return (
        _periods(w, "ANIO")
        .orderBy("periodo_inicio")
        .select(
            "periodo",
            "nro_facturas",
            "unidades_vendidas",
            "ingreso_usd",
            "margen_usd",
            "ticket_promedio_usd",
            "variacion_pct_vs_periodo_anterior",
        )
    )


def evolution_monthly(w) -> DataFrame:
    return (
        _periods(w, "MES")
        .select(
            "periodo",
            "periodo_inicio",
            "nro_facturas",
            "unidades_vendidas",
            "ingreso_usd",
            "margen_usd",
            "ticket_promedio_usd",
            "variacion_pct_vs_periodo_anterior",
        )
        .orderBy("periodo_inicio")
    )


def evolution_stats(w) -> DataFrame:
    stats = w["p13_evolucion_ventas"].groupBy("granularidad").agg(
        F.count(F.lit(1)).alias("periodos"),
        _average("ingreso_usd").alias("promedio"),
        F.min("ingreso_usd").alias("minimo"),
        F.max("ingreso_usd").alias("maximo"),
    )
    shown = F.array(*[F.lit(g) for g in GRANULARITIES])
    return stats.orderBy(F.array_position(shown, F.col("granularidad")))


def first_last_half_year(w) -> DataFrame:
    """Mean monthly revenue of the first and the last six months."""
    months = _periods(w, "MES").select(
        "ingreso_usd",
        F.row_number().over(Window.orderBy("periodo_inicio")).alias("from_start"),
        F.row_number().over(Window.orderBy(F.desc("periodo_inicio"))).alias("from_end"),
    )
    first = F.when(F.col("from_start") <= HALF_YEAR, F.col("ingreso_usd"))
    last = F.when(F.col("from_end") <= HALF_YEAR, F.col("ingreso_usd"))
    return months.agg(
        ratio(F.sum(first), F.count(first)).alias("promedio_primer_semestre"),
        ratio(F.sum(last), F.count(last)).alias("promedio_ultimo_semestre"),
    )


def best_worst_month(w) -> DataFrame:
    """The earliest month wins a tie."""
    best = F.min_by("periodo", F.struct(-F.col("ingreso_usd"), F.col("periodo")))
    worst = F.min_by("periodo", F.struct("ingreso_usd", "periodo"))
    return _periods(w, "MES").agg(
        best.alias("mejor_mes"),
        F.max("ingreso_usd").alias("mejor_ingreso_usd"),
        worst.alias("peor_mes"),
        F.min("ingreso_usd").alias("peor_ingreso_usd"),
        _average("ingreso_usd").alias("promedio_usd"),
    )


def weekday_uplift(w) -> DataFrame:
    """Best and worst weekday by revenue per day; the earlier weekday wins a tie."""
    per_day = F.col("ingreso_prom_por_dia_usd")
    days = w["p15_ventas_por_dia_semana"].agg(
        F.min_by("nombre_dia", F.struct(-per_day, F.col("dia_semana"))).alias("mejor_dia"),
        F.max(per_day).alias("mejor_prom_usd"),
        F.min_by("nombre_dia", F.struct(per_day, F.col("dia_semana"))).alias("peor_dia"),
        F.min(per_day).alias("peor_prom_usd"),
    )
    best, worst = F.col("mejor_prom_usd"), F.col("peor_prom_usd")
    return days.select("*", percent(best - worst, worst).alias("ventaja_pct"))


def holiday_vs_workday(w) -> DataFrame:
    """NULL for a kind of day without sales."""

    def per_day(kind: str) -> Column:
        return F.max(F.when(F.col("tipo_dia") == kind, F.col("ingreso_prom_por_dia_usd")))

    kinds = w["p15_ventas_feriado_vs_normal"].agg(
        per_day("FERIADO").alias("feriado_usd"), per_day("DIA LABORABLE").alias("laborable_usd")
    )
    holiday, workday = F.col("feriado_usd"), F.col("laborable_usd")
    return kinds.select("*", percent(holiday - workday, workday).alias("diferencia_pct"))


# Customers and currencies ------------------------------------------------------------------


def ticket_spread(w) -> DataFrame:
    return w["p16_ticket_por_tipo_cliente"].agg(
        F.min("ticket_promedio_usd").alias("ticket_min_usd"),
        F.max("ticket_promedio_usd").alias("ticket_max_usd"),
        fixed(F.median(F.col("ticket_mediano_usd").cast("double")), 2).alias("mediana_usd"),
    )


def currencies_present(w) -> list[str]:
    """Currencies of the monthly mix in lower case: the model's in their order, then others.

    They become columns, so more than MOST_CURRENCIES fail the report.
    """
    names = w["p18_mix_monedas_mensual"].select(F.lower("moneda").alias("moneda")).distinct()
    found = {row["moneda"] for row in names.limit(MOST_CURRENCIES + 1).collect()}
    if len(found) > MOST_CURRENCIES:
        raise ValueError(f"more than {MOST_CURRENCIES} currencies for one pivot")
    known = [c.lower() for c in CURRENCIES]
    return known + sorted(found.difference(known))


def currency_share_pivot(w) -> DataFrame:
    """Share of each currency per month, zero where it was not used."""
    currencies = currencies_present(w)
    share = (
        w["p18_mix_monedas_mensual"]
        .withColumn("moneda", F.lower("moneda"))
        .groupBy("mes_inicio")
        .pivot("moneda", currencies)
        .agg(F.sum("pct_del_mes"))
    )
    none = F.lit(0)
    return share.select(
        "mes_inicio",
        *[F.coalesce(F.col(f"`{c}`"), none).cast("decimal(18,2)").alias(c) for c in currencies],
    )


def currency_stack_offsets(w) -> DataFrame:
    """Where each currency's bar starts when the shares of a month are stacked."""
    share = currency_share_pivot(w)
    zero = F.lit(0).cast("decimal(18,2)")
    currencies = share.columns[1:]
    tops = F.aggregate(
        F.array(*[F.col(f"`{c}`") for c in currencies]),
        F.array(zero),
        lambda held, x: F.concat(held, F.array((F.element_at(held, -1) + x).cast("decimal(18,2)"))),
    )
    bases = [F.get("tops", F.lit(k)).alias(f"base_{c}") for k, c in enumerate(currencies)]
    return share.select("mes_inicio", tops.alias("tops")).select(
        "mes_inicio", *bases, F.element_at("tops", -1).alias("tope")
    )


# Exchange rates ------------------------------------------------------------------------------


def devaluation_total(w) -> DataFrame:
    rates = w["p19_tipo_cambio_mensual"].agg(
        F.min_by("tasa_bs_usd_prom", "mes_inicio").alias("tasa_inicial"),
        F.max_by("tasa_bs_usd_prom", "mes_inicio").alias("tasa_final"),
    )
    gain = F.col("tasa_final") - F.col("tasa_inicial")
    rate = (gain * 100 / F.nullif("tasa_inicial", F.lit(0).cast("decimal(18,4)"))).cast("decimal(38,10)")
    return rates.select("*", fixed(rate, 2).alias("devaluacion_pct"))


def fx_first_last(w) -> DataFrame:
    return w["p19_tipo_cambio_mensual"].agg(
        F.min_by("margen_pct", "mes_inicio").alias("margen_pct_inicial"),
        F.max_by("margen_pct", "mes_inicio").alias("margen_pct_final"),
        _average("pct_ingreso_expuesto_a_fx").alias("exposicion_promedio_pct"),
    )


# Formatted text ----------------------------------------------------------------------------


def formatted_kpis(w) -> DataFrame:
    """Headline figures as report text, '-' where there is none."""
    totals = sales_totals(w).select(
        integer_text(F.col("lineas")).alias("lineas"),
        integer_text(F.col("facturas")).alias("facturas"),
        integer_text(F.col("unidades")).alias("unidades"),
        amount_text(F.col("ingreso_usd"), 0).alias("ingreso"),
    )
    margin = global_margin(w).select(percent_text(F.col("margen_pct"), 1).alias("margen"))
    dead = dead_stock_kpi(w).select(
        amount_text(F.col("capital_muerto"), 2).alias("capital_muerto"),
        integer_text(F.col("dias_max")).alias("dias_max"),
    )

    def rows(df: DataFrame) -> DataFrame:
        pairs = [F.struct(F.lit(c).alias("kpi"), F.col(c).alias("texto")) for c in df.columns]
        return df.select(F.explode(F.array(*pairs)).alias("p")).select("p.kpi", "p.texto")

    return reduce(DataFrame.unionByName, [rows(totals), rows(margin), rows(dead)])


def formatted_top_products(w) -> DataFrame:
    return top_by_units(w).select(
        integer_text(F.col("rk")).alias("puesto"),
        "codigo",
        shorten(F.col("descripcion"), 12).alias("descripcion"),
        integer_text(F.col("unidades_vendidas")).alias("unidades"),
        amount_text(F.col("monto_vendido_usd"), 0).alias("monto"),
    )


def formatted_currency_mix(w) -> DataFrame:
    return w["p18_mix_monedas"].select(
        F.concat("moneda_nombre", F.lit(" ("), "moneda", F.lit(")")).alias("etiqueta"),
        amount_text(F.col("ingreso_usd"), 2).alias("ingreso"),
        percent_text(F.col("pct_por_monto"), 2).alias("monto"),
    )


DATASETS = {
    f.__name__: f
    for f in (
        sales_totals,
        table_counts,
        global_margin,
        top_by_units,
        top_by_revenue,
        top_overlap,
        rank_gaps,
        margin_top_categories,
        margin_top_brands,
        margin_top_products,
        margin_losses,
        margin_stats,
        margin_level_counts,
        margin_band_share,
        dead_stock_top,
        dead_stock_kpi,
        dead_capital_share,
        evolution_yearly,
        evolution_monthly,
        evolution_stats,
        first_last_half_year,
        best_worst_month,
        weekday_uplift,
        holiday_vs_workday,
        ticket_spread,
        currency_share_pivot,
        currency_stack_offsets,
        devaluation_total,
        fx_first_last,
        formatted_kpis,
        formatted_top_products,
        formatted_currency_mix,
    )
}

# Plain reads of a mart: name of the set, mart, order. A leading minus sorts descending, with
# NULLs last if a question mark follows; a leading exclamation mark sorts missing values first.
READS = {
    "p1_orden": ("p01_top_productos", ["ranking_por_cantidad", "ranking_por_monto", "codigo"]),
    "p4_orden": ("p04_margen", ["nivel", "-margen_usd"]),
    "p6_orden": (
        "p06_inventario_muerto",
        ["!fecha_ultima_venta", "-dias_sin_vender?", "-capital_inmovilizado_usd", "codigo"],
    ),
    "p13_orden": ("p13_evolucion_ventas", ["granularidad", "periodo_inicio"]),
    "p6_resumen": ("p06_inventario_muerto_resumen", ["-capital_inmovilizado_usd"]),
    "p15_dia": ("p15_ventas_por_dia_semana", ["dia_semana"]),
    "p15_tipo": ("p15_ventas_feriado_vs_normal", ["-ingreso_prom_por_dia_usd"]),
    "p15_fer": ("p15_ventas_por_feriado", ["-ingreso_usd"]),
    "p16": ("p16_ticket_por_tipo_cliente", ["-ticket_promedio_usd"]),
    "p18": ("p18_mix_monedas", ["-pct_por_monto"]),
    "p18_mes": ("p18_mix_monedas_mensual", ["mes_inicio", "moneda"]),
    "p19_mes": ("p19_tipo_cambio_mensual", ["mes_inicio"]),
    "p19_corr": ("p19_correlacion_fx", []),
    "p19_moneda": ("p19_margen_por_moneda", ["-margen_pct"]),
}


def _order(name: str) -> Column:
    """NULLs sort as the largest value, in either direction, unless the order says otherwise."""
    if name.startswith("!"):
        return F.col(name[1:]).isNull().desc()
    if name.endswith("?"):
        return F.col(name[1:-1]).desc_nulls_last()
    if name.startswith("-"):
        return F.col(name[1:]).desc_nulls_first()
    return F.col(name).asc_nulls_last()


def report_datasets(w) -> dict[str, DataFrame]:
    """Every result set of the report by name, each a lazy DataFrame."""
    reads = {
        name: w[mart].orderBy(*[_order(o) for o in order]) if order else w[mart]
        for name, (mart, order) in READS.items()
    }
    return reads | {name: build(w) for name, build in DATASETS.items()}


def write_report(w) -> None:
    """Store every result set in the report layer."""
    for name, df in report_datasets(w).items():
        w.store.save("report", name, df)
