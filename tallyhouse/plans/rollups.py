"""Shared aggregates. Each reads a line table once; the marts read only these.

Counting distinct invoices is the one measure that is not additive. Nearly every
invoice lies on one day in one currency and is simply counted, once, even if it has
several customer types (colliding customer documents). The few that span several
days or currencies (duplicate holidays) are marked and counted exactly.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.money import TOTAL, total

DAY = ["sk_fecha", "sk_moneda"]
MEASURES = ["lineas", "unidades", "ingreso", "costo", "lista"]


# A stock as a positive number below the span; 0 stands for NULL, the smallest.
STOCK_SHIFT, STOCK_SPAN = (1 << 31) + 1, 1 << 33
PACKED, EPOCH = "decimal(19,0)", "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def sales_by_invoice(sale_lines: DataFrame) -> DataFrame:
    """One row per invoice, day, currency and customer type.

    `repetida` marks invoices that span several days or currencies; of any other
    invoice one row has 1 in `cuenta`.
    """
    quantity = F.col("cantidad")
    merged = sale_lines.groupBy("nro_factura", "sk_fecha", "sk_moneda", "tipo").agg(
        F.count(F.lit(1)).alias("lineas"),
        F.sum(quantity).alias("unidades"),
        total(F.col("subtotal_usd")).alias("ingreso"),
        total(quantity * F.col("costo_usd")).alias("costo"),
        total(quantity * F.col("precio_venta_usd")).alias("lista"),
    )
    same_invoice = Window.partitionBy("nro_factura")
    several = reduce(
        Column.__or__,
        [F.min(c).over(same_invoice) != F.max(c).over(same_invoice) for c in DAY],
    )
    place = F.row_number().over(same_invoice.orderBy(F.col("tipo").asc_nulls_last()))
    marked = merged.withColumn("repetida", several)
    return marked.withColumn("cuenta", ((place == 1) & ~F.col("repetida")).cast("int"))


def sales_by_day(sales_by_invoice: DataFrame) -> DataFrame:
    """Measures per day and currency, plus one row per day of every repeated invoice.

    distinct_invoices() over any grouping of these rows is exact.
    """
    sums = {m: F.sum(m) for m in ("lineas", "unidades")}
    sums |= {m: total(F.col(m)) for m in ("ingreso", "costo", "lista")}
    days = sales_by_invoice.groupBy("sk_fecha", "sk_moneda").agg(
        *[column.alias(m) for m, column in sums.items()],
        F.sum("cuenta").alias("facturas"),
        F.lit(None).cast("string").alias("nro_repetida"),
    )
    repeated = sales_by_invoice.where("repetida").select("sk_fecha", "sk_moneda", "nro_factura")
    empty = {m: F.lit(0).cast("bigint") for m in ("lineas", "unidades", "facturas")}
    empty |= {m: F.lit(0).cast(TOTAL) for m in ("ingreso", "costo", "lista")}
    repeated = repeated.distinct().select(
        "sk_fecha",
        "sk_moneda",
        *[empty[m].alias(m) for m in MEASURES],
        empty["facturas"].alias("facturas"),
        F.col("nro_factura").alias("nro_repetida"),
    )
    return days.unionByName(repeated)


def distinct_invoices() -> Column:
    """Distinct invoices over rows of sales_by_day."""
    return F.sum("facturas") + F.count_distinct("nro_repetida")


def invoices_by_type(sales_by_invoice: DataFrame) -> DataFrame:
    """One row per invoice and customer type."""
    columns = ["nro_factura", "tipo", "lineas", "unidades", "ingreso"]
    once = sales_by_invoice.where("NOT repetida").select(columns)
    again = (
        sales_by_invoice.where("repetida")
        .groupBy("nro_factura", "tipo")
        .agg(
            F.sum("lineas").alias("lineas"),
            F.sum("unidades").alias("unidades"),
            total(F.col("ingreso")).alias("ingreso"),
        )
    )
    return once.unionByName(again)


def sales_by_product(sale_lines: DataFrame) -> DataFrame:
    quantity = F.nullif("cantidad", F.lit(0))
    unit_price = (F.col("subtotal_usd") / quantity).cast("decimal(24,10)")
    return sale_lines.groupBy("sk_producto").agg(
        F.sum("cantidad").alias("unidades"),
        total(F.col("subtotal_usd")).alias("ingreso"),
        F.sum(unit_price).cast("decimal(34,10)").alias("precios"),
        F.count(unit_price).alias("nro_precios"),
        F.max("fecha").alias("ultima_venta"),
    )


def stock_by_product(movement_lines: DataFrame) -> DataFrame:
    """Stock after the latest movement; of simultaneous movements the higher stock.

    Time and stock are packed into one number that sorts like the pair, so that the
    maximum is found by hashing: no task sorts its movements.
    """
    since = F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, CAST(fecha_hora AS TIMESTAMP_NTZ))")
    stock = F.coalesce(F.col("stock_resultante").cast("bigint") + STOCK_SHIFT, F.lit(0))
    packed = since.cast(PACKED) * F.lit(STOCK_SPAN).cast(PACKED) + stock.cast(PACKED)
    latest = movement_lines.groupBy("sk_producto").agg(
        F.max(packed.cast("decimal(38,0)")).alias("latest"),
        F.min("fecha").alias("primer_movimiento"),
    )
    low = F.pmod(F.col("latest"), F.lit(STOCK_SPAN).cast("decimal(38,0)"))
    moment = ((F.col("latest") - low) / F.lit(STOCK_SPAN)).cast("bigint")
    return (
        latest.withColumn("low", low.cast("bigint"))
        .withColumn("moment", moment)
        .select(
            "sk_producto",
            "primer_movimiento",
            F.to_date(F.expr(f"timestampadd(MICROSECOND, moment, {EPOCH})")).alias("ultimo_movimiento"),
            F.nullif("low", F.lit(0).cast("bigint")).alias("low"),
        )
        .select(
            "sk_producto",
            "primer_movimiento",
            "ultimo_movimiento",
            (F.col("low") - STOCK_SHIFT).cast("int").alias("stock"),
        )
    )
