"""The three facts at line grain.

The line tables carry a few attributes beside the fact columns (cost, list price,
customer type, time of a movement), looked up while the keys are resolved, so
that no mart has to join a large dimension to the lines again.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.money import money, overflows, whole
from tallyhouse.functions.text import after_prefix
from tallyhouse.operators.joins import optional_lookup, spread_join
from tallyhouse.plans.dims import reason

# Columns of the stored facts; the first of each list is the generated key.
FACT_COLUMNS = {
    "fact_compras": [
        "sk_compra",
        "sk_fecha",
        "sk_producto",
        "sk_proveedor",
        "cantidad",
        "cost_unt_usd",
        "subtotal_usd",
    ],
    "fact_ventas": [
        "sk_venta",
        "sk_fecha",
        "sk_hora",
        "sk_producto",
        "sk_cliente",
        "sk_empleado",
        "sk_moneda",
        "nro_factura",
        "cantidad",
        "precio_unit_usd",
        "subtotal_usd",
    ],
    "fact_mov_inventario": [
        "sk_movimiento",
        "sk_fecha",
        "sk_hora",
        "sk_producto",
        "sk_tipo_movimiento",
        "cantidad_entrada",
        "cantidad_salida",
        "cantidad_neta",
        "stock_resultante",
    ],
}

# The line table behind each fact and the source column its keys follow.
FACT_LINES = {
    "fact_compras": ("purchase_lines", "numero"),
    "fact_ventas": ("sale_lines", "nro_factura"),
    "fact_mov_inventario": ("movement_lines", "fecha_hora"),
}


# Columns of sale_lines that mark a converted amount too large for its column.
OVERFLOWS = {"precio_unit_usd": "precio_desborda", "subtotal_usd": "subtotal_desborda"}


def _calendar_keys(dim_tiempo: DataFrame, *extra: str) -> DataFrame:
    return dim_tiempo.select("fecha", "sk_fecha", *extra)


def _hour_keys(dim_hora: DataFrame) -> DataFrame:
    # At most 24 hours and NULL, whatever the size of the data.
    return F.broadcast(dim_hora.select("hora", "sk_hora"))


def _product_keys(dim_producto: DataFrame, *extra: str) -> DataFrame:
    return dim_producto.select(F.col("codigo").alias("product_codigo"), "sk_producto", *extra)


def _with_header(lines: DataFrame, header: DataFrame) -> DataFrame:
    """Lines and their header, both of fact size.

    Always a merge join: compressed files look smaller than they are, and neither
    side should ever be collected for a broadcast. It comes last, so the stored
    lines of one document lie next to each other and collapse before the shuffle
    when they are grouped by document.
    """
    return lines.join(header.hint("merge"), "numero")


def purchase_lines(
    stg_compras_header: DataFrame,
    stg_compras_detalle: DataFrame,
    dim_tiempo: DataFrame,
    dim_producto: DataFrame,
    dim_proveedor: DataFrame,
) -> DataFrame:
    """Purchase-order lines. Headers are resolved first: they are the smaller side."""
    supplier = dim_proveedor.select(
        F.col("documento").alias("proveedor_documento"), "sk_proveedor"
    )
    header = (
        stg_compras_header.select(
            "numero", "proveedor_documento", F.to_date("fecha_hora").alias("fecha")
        )
        .join(_calendar_keys(dim_tiempo), "fecha")
        .join(supplier, "proveedor_documento")
        .select("numero", "sk_fecha", "sk_proveedor")
    )
    lines = spread_join(stg_compras_detalle, _product_keys(dim_producto), "product_codigo")
    return _with_header(lines, header).select(
        "numero",
        "sk_fecha",
        "sk_producto",
        "sk_proveedor",
        whole(F.col("cantidad")).alias("cantidad"),
        money(F.col("costo_unitario_usd")).alias("cost_unt_usd"),
        money(F.col("subtotal_usd")).alias("subtotal_usd"),
    )


def sale_lines(
    stg_ventas_header: DataFrame,
    stg_ventas_detalle: DataFrame,
    dim_tiempo: DataFrame,
    dim_hora: DataFrame,
    dim_moneda: DataFrame,
    dim_clientes: DataFrame,
    dim_usuarios: DataFrame,
    dim_producto: DataFrame,
) -> DataFrame:
    """Invoice lines with amounts in USD at the rate of the day."""
    header = stg_ventas_header.select(
        "numero",
        F.to_date("fecha_hora").alias("fecha"),
        F.hour("fecha_hora").alias("hora"),
        after_prefix("cliente_documento").alias("cliente"),
        "usuario",
        "moneda",
    )
    header = (
        header.join(_calendar_keys(dim_tiempo, "cop_por_usd", "tasa_bs_usd"), "fecha")
        .join(_hour_keys(dim_hora), "hora")
        .join(dim_moneda.withColumnRenamed("codigo", "moneda"), "moneda")
    )
    customer = dim_clientes.select("documento", "sk_cliente", "tipo")
    user = dim_usuarios.select("username", F.col("sk_usuario").alias("sk_empleado"))
    header = optional_lookup(header, customer, "cliente", "documento", spread_by="numero")
    header = optional_lookup(header, user, "usuario", "username", spread_by="numero")
    # Amounts are divided by this; a currency without a rate column is taken as dollars.
    rate = (
        F.when(F.col("moneda") == "COP", F.col("cop_por_usd"))
        .when(F.col("moneda") == "BS", F.col("tasa_bs_usd"))
        .otherwise(F.lit(1.0))
    )
    header = header.select(
        "numero",
        "fecha",
        "sk_fecha",
        "sk_hora",
        "sk_moneda",
        "sk_cliente",
        "sk_empleado",
        "tipo",
        F.nullif(rate, F.lit(0.0)).alias("rate"),
    )
    product = _product_keys(dim_producto, "costo_usd", "precio_venta_usd")
    price = F.col("precio_unitario") / F.col("rate")
    subtotal = F.col("subtotal") / F.col("rate")
    lines = spread_join(stg_ventas_detalle, product, "product_codigo")
    return _with_header(lines, header).select(
        "fecha",
        "sk_fecha",
        "sk_hora",
        "sk_producto",
        "sk_cliente",
        "sk_empleado",
        "sk_moneda",
        F.col("numero").alias("nro_factura"),
        whole(F.col("cantidad")).alias("cantidad"),
        money(price).alias("precio_unit_usd"),
        money(subtotal).alias("subtotal_usd"),
        overflows(price, money(price)).alias(OVERFLOWS["precio_unit_usd"]),
        overflows(subtotal, money(subtotal)).alias(OVERFLOWS["subtotal_usd"]),
        "tipo",
        "costo_usd",
        "precio_venta_usd",
    )


def movement_lines(
    stg_movimientos_inventario: DataFrame,
    dim_tiempo: DataFrame,
    dim_hora: DataFrame,
    dim_producto: DataFrame,
    dim_tipo_movimiento: DataFrame,
) -> DataFrame:
    """Inventory movements with additive in, out and net quantities."""
    kind = dim_tipo_movimiento.select(
        F.col("codigo").alias("tipo"), "motivo", "sk_tipo_movimiento", "signo_stock"
    )
    moves = stg_movimientos_inventario.select(
        "fecha_hora",
        F.to_date("fecha_hora").alias("fecha"),
        F.hour("fecha_hora").alias("hora"),
        "product_codigo",
        "tipo",
        reason("motivo").alias("motivo"),
        F.abs(whole(F.col("cantidad"))).alias("moved"),
        whole(F.col("stock_nuevo")).alias("stock_resultante"),
    )
    resolved = (
        spread_join(moves, _product_keys(dim_producto), "product_codigo")
        .join(_calendar_keys(dim_tiempo), "fecha")
        .join(_hour_keys(dim_hora), "hora")
        .join(kind, ["tipo", "motivo"])
    )
    sign = F.col("signo_stock")
    return resolved.select(
        "fecha_hora",
        "fecha",
        "sk_fecha",
        "sk_hora",
        "sk_producto",
        "sk_tipo_movimiento",
        F.when(sign == 1, F.col("moved")).otherwise(0).alias("cantidad_entrada"),
        F.when(sign == -1, F.col("moved")).otherwise(0).alias("cantidad_salida"),
        (sign.cast("int") * F.col("moved")).alias("cantidad_neta"),
        "stock_resultante",
    )
