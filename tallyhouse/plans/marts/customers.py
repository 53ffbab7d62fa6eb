"""Ticket size by customer type."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.money import fixed, percent, ratio, total
from tallyhouse.functions.text import labelled
from tallyhouse.operators.quantiles import quantile_per_group

# Customer type codes and their labels.
UNKNOWN_CODE = "SD"
UNKNOWN_LABEL = "Sin cliente identificado"
TYPE_LABELS = {
    "J": "Taller / Empresa (jurídico)",
    "V": "Particular (venezolano)",
    "E": "Extranjero",
}


def ticket_by_customer_type(invoices_by_type: DataFrame, store) -> DataFrame:
    """Mean, median and range of invoice totals. An invoice is one row per type."""
    invoices = invoices_by_type.withColumn(
        "codigo_tipo", F.coalesce("tipo", F.lit(UNKNOWN_CODE))
    )
    segments = quantile_per_group(
        invoices.withColumn("uno", F.lit(1)),
        "codigo_tipo",
        "ingreso",
        0.5,
        "mediana",
        store,
        "ticket_by_customer_type",
        {
            "nro_facturas": (F.sum, "uno"),
            "ingreso_total_usd": (total, "ingreso"),
            "unidades_vendidas": (F.sum, "unidades"),
            "lineas": (F.sum, "lineas"),
            "ticket_minimo_usd": (F.min, "ingreso"),
            "ticket_maximo_usd": (F.max, "ingreso"),
        },
    )
    label = labelled(F.col("codigo_tipo"), TYPE_LABELS, F.lit(UNKNOWN_LABEL))
    count, revenue = F.col("nro_facturas"), F.col("ingreso_total_usd")
    return segments.select(
        "codigo_tipo",
        label.alias("tipo_cliente"),
        "nro_facturas",
        "ingreso_total_usd",
        "unidades_vendidas",
        ratio(revenue, count).alias("ticket_promedio_usd"),
        fixed(F.col("mediana"), 2).alias("ticket_mediano_usd"),
        "ticket_minimo_usd",
        "ticket_maximo_usd",
        ratio(F.col("lineas"), count).alias("lineas_promedio_por_factura"),
        ratio(F.col("unidades_vendidas"), count).alias("unidades_promedio_por_factura"),
        percent(revenue, F.sum("ingreso_total_usd").over(Window.partitionBy())).alias(
            "pct_del_ingreso_total"
        ),
    )
