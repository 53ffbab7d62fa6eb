"""The eight dimensions, without their surrogate keys."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.dates import iso_weekday
from tallyhouse.functions.money import money
from tallyhouse.functions.text import after_prefix, blank_to_null, capitalize_words, labelled
from tallyhouse.operators.dedup import first_per_key

# Placeholders and codes that belong to the data contract.
NO_CODE = "SIN-CODIGO"
NO_REASON = "SIN MOTIVO"
INBOUND_TYPES = ("entrada", "import_inicial")
MOVEMENT_NAMES = {
    "entrada": "Entrada",
    "salida": "Salida",
    "venta": "Venta",
    "import_inicial": "Carga inicial",
}

# Surrogate key of every dimension and the columns that order it.
KEYS = {
    "dim_clientes": ("sk_cliente", ["documento", "tipo", "fecha_registro", "nombre", "email"]),
    "dim_usuarios": (
        "sk_usuario",
        ["username", "fecha_creacion", "nombre_completo", "rol", "activo"],
    ),
    "dim_tiempo": ("sk_fecha", ["fecha", "nombre_feriado", "tasa_bs_usd", "cop_por_usd"]),
    "dim_proveedor": ("sk_proveedor", ["documento", "nombre", "ciudad", "pais"]),
    "dim_moneda": ("sk_moneda", ["codigo"]),
    "dim_hora": ("sk_hora", ["hora_desc", "hora"]),
    "dim_producto": (
        "sk_producto",
        ["codigo", "descripcion", "marca", "nro_original", "costo_usd", "precio_venta_usd"],
    ),
    "dim_tipo_movimiento": ("sk_tipo_movimiento", ["codigo", "motivo"]),
}


def customers(stg_clientes: DataFrame) -> DataFrame:
    known = stg_clientes.where("documento IS NOT NULL")
    return first_per_key(known, F.col("documento"), ["fecha_registro"]).select(
        after_prefix("documento").alias("documento"),
        F.upper(F.left("documento", F.lit(1))).alias("tipo"),
        "nombre",
        F.to_date("fecha_registro").alias("fecha_registro"),
        F.lower(F.trim("email")).alias("email"),
        F.current_date().alias("fecha_creacion"),
    )


def users(stg_usuarios: DataFrame) -> DataFrame:
    known = stg_usuarios.where("username IS NOT NULL")
    return first_per_key(known, F.col("username"), ["fecha_creacion"]).select(
        F.lower(F.trim("username")).alias("username"),
        "nombre_completo",
        F.lower(F.trim("rol")).alias("rol"),
        (F.upper(F.trim("activo")) == "SI").alias("activo"),
        F.to_date("fecha_creacion").alias("fecha_creacion"),
    )


def calendar(stg_tasas_cambio: DataFrame, stg_feriados: DataFrame) -> DataFrame:
    """One row per exchange-rate row, once more for a second holiday on that day."""
    rates = stg_tasas_cambio.select(
        F.to_date("fecha").alias("fecha"), "tasa_bs_usd", "cop_por_usd", "tasa_bs_cop"
    )
    holidays = stg_feriados.select(F.to_date("fecha").alias("fecha"), "feriado")
    weekday = iso_weekday(F.col("fecha"))
    return rates.join(holidays, "fecha", "left").select(
        "fecha",
        F.quarter("fecha").alias("trimestre"),
        weekday.alias("dia_semana"),
        weekday.isin(6, 7).alias("es_fin_de_semana"),
        F.col("feriado").isNotNull().alias("es_feriado"),
        F.col("feriado").alias("nombre_feriado"),
        *[F.col(c).cast("double").alias(c) for c in ("tasa_bs_usd", "cop_por_usd", "tasa_bs_cop")],
    )


def suppliers(stg_proveedores: DataFrame) -> DataFrame:
    known = stg_proveedores.where("documento IS NOT NULL")
    city = F.split_part("direccion", F.lit(","), F.lit(-2))
    return first_per_key(known, F.col("documento"), ["fecha_registro"]).select(
        F.trim("documento").alias("documento"),
        F.trim("nombre").alias("nombre"),
        F.trim(city).alias("ciudad"),
        F.when(F.startswith("documento", F.lit("NIT")), "CO").otherwise("VE").alias("pais"),
        F.current_date().alias("fecha_creacion"),
    )


def currencies(stg_ventas_header: DataFrame) -> DataFrame:
    return stg_ventas_header.select(F.col("moneda").alias("codigo")).distinct()


def hours(stg_movimientos_inventario: DataFrame, stg_ventas_header: DataFrame) -> DataFrame:
    moved = stg_movimientos_inventario.select(F.hour("fecha_hora").alias("hora"))
    sold = stg_ventas_header.select(F.hour("fecha_hora").alias("hora"))
    band = F.when(F.col("hora") < 12, "manana").when(F.col("hora") >= 13, "tarde")
    # hora_desc only orders the keys: the latest hour comes first.
    return (
        moved.distinct()
        .union(sold.distinct())
        .distinct()
        .select("hora", band.otherwise("mediodia").alias("franja"), (-F.col("hora")).alias("hora_desc"))
    )


def products(stg_productos: DataFrame, collation: str | None = None) -> DataFrame:
    """Products by code, else by description; of several the first by description.

    Descriptions are in the order of a collation, such as UNICODE or es, or of their bytes.
    """
    described = stg_productos.where("descripcion IS NOT NULL")
    code = blank_to_null("codigo")
    identity = F.coalesce(code, F.trim("descripcion"))
    return first_per_key(described, identity, ["descripcion"], collation).select(
        F.coalesce(code, F.lit(NO_CODE)).alias("codigo"),
        blank_to_null("nro_original").alias("nro_original"),
        F.trim("descripcion").alias("descripcion"),
        blank_to_null("marca").alias("marca"),
        F.upper(F.split_part(F.trim("descripcion"), F.lit(" "), F.lit(1))).alias("categoria"),
        money(F.col("costo_usd"), 12).alias("costo_usd"),
        money(F.col("precio_venta_usd"), 12).alias("precio_venta_usd"),
        F.lit(None).cast("string").alias("ubicacion"),
        F.lit(0).alias("stock_minimo"),
        F.current_date().alias("fecha_creacion"),
    )


def reason(motivo: str) -> Column:
    return F.coalesce(blank_to_null(motivo), F.lit(NO_REASON))


def movement_types(stg_movimientos_inventario: DataFrame) -> DataFrame:
    kinds = (
        stg_movimientos_inventario.where("tipo IS NOT NULL")
        .select(F.col("tipo").alias("codigo"), reason("motivo").alias("motivo"))
        .distinct()
    )
    spaced = F.replace("codigo", F.lit("_"), F.lit(" "))
    inbound = F.col("codigo").isin(*INBOUND_TYPES)
    return kinds.select(
        "codigo",
        labelled(F.col("codigo"), MOVEMENT_NAMES, capitalize_words(spaced)).alias("nombre"),
        "motivo",
        F.when(inbound, "ENTRADA").otherwise("SALIDA").alias("efecto_stock"),
        F.when(inbound, 1).otherwise(-1).cast("smallint").alias("signo_stock"),
    )
