"""Dead stock."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.functions.money import percent, ratio, total

# Class labels by days without a sale.
NEVER_SOLD = "NUNCA VENDIDO"
CLASSES = [
    (180, "INVENTARIO MUERTO (180+ días)"),
    (90, "LENTA ROTACIÓN (90-179 días)"),
    (30, "ATENCIÓN (30-89 días)"),
]
ACTIVE = "ACTIVO"
DEAD_DAYS = 180


def dead_stock(
    dim_producto: DataFrame, sales_by_product: DataFrame, stock_by_product: DataFrame
) -> DataFrame:
    """Stock, tied-up capital and days without a sale of every product."""
    cutoff = sales_by_product.agg(F.max("ultima_venta")).scalar()
    joined = dim_producto.join(stock_by_product, "sk_producto", "left").join(
        sales_by_product, "sk_producto", "left"
    )
    stock = F.coalesce("stock", F.lit(0))
    base = joined.select(
        "codigo",
        "descripcion",
        "marca",
        "categoria",
        "ubicacion",
        "costo_usd",
        "precio_venta_usd",
        stock.alias("stock_actual"),
        (stock * F.col("costo_usd")).cast("decimal(24,2)").alias("capital_inmovilizado_usd"),
        F.col("ultimo_movimiento").alias("fecha_ultimo_movimiento"),
        F.col("ultima_venta").alias("fecha_ultima_venta"),
        F.coalesce("unidades", F.lit(0)).alias("unidades_vendidas_hist"),
        cutoff.alias("fecha_corte"),
        F.datediff(cutoff, F.coalesce("ultima_venta", "primer_movimiento")).alias("dias_sin_vender"),
    )
    unsold = F.col("fecha_ultima_venta").isNull()
    label = F.when(unsold, NEVER_SOLD)
    for days, name in CLASSES:
        label = label.when(F.col("dias_sin_vender") >= days, name)
    return base.select(
        "*",
        label.otherwise(ACTIVE).alias("clasificacion"),
        (unsold | (F.col("dias_sin_vender") >= DEAD_DAYS)).alias("es_inventario_muerto"),
    )


def dead_stock_summary(dead_stock: DataFrame) -> DataFrame:
    classes = dead_stock.groupBy("clasificacion").agg(
        F.count(F.lit(1)).alias("nro_productos"),
        F.sum("stock_actual").alias("unidades_en_stock"),
        total(F.col("capital_inmovilizado_usd")).alias("capital_inmovilizado_usd"),
        ratio(F.sum("dias_sin_vender"), F.count("dias_sin_vender"), 1).alias("dias_sin_vender_prom"),
    )
    everything = F.sum("capital_inmovilizado_usd").over(Window.partitionBy())
    return classes.select(
        "clasificacion",
        "nro_productos",
        "unidades_en_stock",
        "capital_inmovilizado_usd",
        percent(F.col("capital_inmovilizado_usd"), everything).alias("pct_del_capital_total"),
        "dias_sin_vender_prom",
    )
