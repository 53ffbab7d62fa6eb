"""Best sellers and margin."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.money import TOTAL, fixed, percent, total
from tallyhouse.operators.ranks import top_by_any

ATTRIBUTES = ["codigo", "descripcion", "marca", "categoria"]
# What a product of the margin mart is, from the coarsest on.
KEYS = ["categoria", "marca", "codigo"]
TOP = 10


def product_totals(sales_by_product: DataFrame, dim_producto: DataFrame) -> DataFrame:
    """Sales per distinct combination of product attributes."""
    return (
        sales_by_product.join(dim_producto.select("sk_producto", *ATTRIBUTES), "sk_producto")
        .groupBy(*ATTRIBUTES)
        .agg(
            F.sum("unidades").alias("unidades_vendidas"),
            total(F.col("ingreso")).alias("monto_vendido_usd"),
            fixed(F.sum("precios") / F.nullif(F.sum("nro_precios"), F.lit(0)), 2).alias(
                "precio_prom_usd"
            ),
        )
    )


def top_products(
    product_totals: DataFrame,
    sale_lines: DataFrame,
    dim_producto: DataFrame,
    store,
) -> DataFrame:
    """Products within the first ten places by units or by revenue.

    Invoices are counted only for the products that are kept. Those are written
    first, so Spark knows how few they are before it joins them to the lines.
    """
    ranks = {
        "ranking_por_cantidad": "unidades_vendidas",
        "ranking_por_monto": "monto_vendido_usd",
    }
    kept = store.keep(
        "top_products", top_by_any(product_totals, ranks, TOP, store, "top_products")
    )
    same_product = [F.col(f"k.{c}").eqNullSafe(F.col(f"d.{c}")) for c in ATTRIBUTES]
    keys = store.keep(
        "top_product_keys",
        dim_producto.alias("d").join(kept.alias("k"), same_product).select("d.sk_producto", "k.*"),
    )
    return (
        sale_lines.join(keys, "sk_producto")
        .groupBy(*kept.columns)
        .agg(F.count_distinct("nro_factura").alias("nro_facturas"))
        .select(
            "ranking_por_cantidad",
            "ranking_por_monto",
            *ATTRIBUTES,
            "unidades_vendidas",
            "monto_vendido_usd",
            "nro_facturas",
            "precio_prom_usd",
            (F.col("ranking_por_cantidad") <= TOP).alias("top10_por_cantidad"),
            (F.col("ranking_por_monto") <= TOP).alias("top10_por_monto"),
        )
    )


def margin_columns(revenue: Column, cost: Column) -> dict[str, Column]:
    margin = (revenue - cost).cast(TOTAL)
    return {"margen_usd": margin, "margen_pct": percent(margin, revenue)}


def margin_by_level(
    sales_by_product: DataFrame, dim_producto: DataFrame, collation: str | None = None
) -> DataFrame:
    """Margin per product, brand and category, from sales already summed per product.

    Rows are summed per product once; brands and categories add up products, whose
    description, the largest in a collation or by bytes, is the largest of their largest.
    """
    sold = sales_by_product.join(dim_producto, "sk_producto").select(
        *ATTRIBUTES,
        "unidades",
        "ingreso",
        (F.col("unidades") * F.col("costo_usd")).cast(TOTAL).alias("costo"),
    )

    text = F.col("descripcion")
    largest = F.max(text)
    if collation:
        # Texts that the collation takes for equal are told apart by their bytes.
        rank = F.when(text.isNotNull(), F.struct(F.collate(text, collation).alias("c"), text.alias("t")))
        largest = F.max(rank)["t"]

    def summed(rows: DataFrame, *keys: str) -> DataFrame:
        return rows.groupBy(*keys).agg(
            largest.alias("descripcion"),
            F.sum("unidades").alias("unidades"),
            total(F.col("ingreso")).alias("ingreso"),
            total(F.col("costo")).alias("costo"),
        )

    def level(name: str, rows: DataFrame) -> DataFrame:
        return rows.select(
            F.lit(name).alias("nivel"),
            *[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in KEYS],
            "descripcion",
            F.col("unidades").alias("unidades_vendidas"),
            F.col("ingreso").alias("ingreso_usd"),
            F.col("costo").alias("costo_mercancia_usd"),
        )

    products = summed(sold, *KEYS)
    levels = (
        level("PRODUCTO", products)
        .unionAll(level("MARCA", summed(products, "marca")))
        .unionAll(level("CATEGORIA", summed(products, "categoria")))
    )
    margin = margin_columns(F.col("ingreso_usd"), F.col("costo_mercancia_usd"))
    return levels.select(
        "*",
        margin["margen_usd"].alias("margen_usd"),
        margin["margen_pct"].alias("margen_pct_sobre_ingreso"),
        percent(margin["margen_usd"], F.col("costo_mercancia_usd")).alias("markup_pct_sobre_costo"),
    )
