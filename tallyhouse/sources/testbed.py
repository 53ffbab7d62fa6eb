"""Staging inputs derived from the order-processing test tables.

The mapping keeps every row of its inputs and plants the dirt that the warehouse
has to cope with: blank and untrimmed codes, duplicates, keys that collide once
cleaned, unknown products and users, days without a rate, two holidays on a day.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Holidays as month-day and name, and one that falls on another.
HOLIDAYS = {
    "01-01": "Año Nuevo",
    "05-01": "Día del Trabajador",
    "07-24": "Natalicio",
    "12-24": "Nochebuena",
    "12-31": "Fin de Año",
}
SECOND_HOLIDAY = ("1998-05-01", "Día Extra")
DAY_WITHOUT_RATE = 31


def document(key: str) -> str:
    letter = f"substr('VJE', cast({key} % 3 as int) + 1, 1)"
    number = f"CASE WHEN {key} % 50 = 1 THEN {key} - 1 ELSE {key} END"
    return f"concat(CASE WHEN {key} % 7 = 0 THEN lower({letter}) ELSE {letter} END, '-', {number})"


def _versions(df: DataFrame, has_second: str) -> DataFrame:
    """Each row once, and once more as version 2 where the condition holds."""
    versions = f"explode(CASE WHEN {has_second} THEN array(1, 2) ELSE array(1) END) AS version"
    return df.selectExpr("*", versions)


def _calendar(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """All days from the first to the last that occurs in the tables."""
    days = orders.select(F.col("o_orderdate").alias("day")).union(lineitem.select("l_shipdate"))
    span = days.agg(F.to_date(F.min("day")).alias("a"), F.to_date(F.max("day")).alias("b"))
    return span.select(F.explode(F.sequence("a", "b")).alias("fecha"))


def _holidays(calendar: DataFrame) -> DataFrame:
    names = F.create_map(*[F.lit(x) for pair in HOLIDAYS.items() for x in pair])
    first = F.try_element_at(names, F.date_format("fecha", "MM-dd"))
    day, name = SECOND_HOLIDAY
    second = F.when(F.col("fecha") == F.lit(day).cast("date"), F.lit(name))
    return calendar.select("fecha", F.explode(F.array(first, second)).alias("feriado")).where(
        "feriado IS NOT NULL"
    )


#: The tables that staging() reads.
TABLES = ("customer", "lineitem", "nation", "orders", "part", "supplier")


def staging(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    orders, lineitem = table("orders"), table("lineitem")
    calendar = _calendar(orders, lineitem)
    purchase = "concat('C', l_orderkey, '-', l_suppkey)"
    return {
        "stg_clientes": _versions(table("customer"), "c_custkey % 20 = 0").selectExpr(
            f"{document('c_custkey')} AS documento",
            "CASE version WHEN 2 THEN concat(c_name, ' (2)') ELSE c_name END AS nombre",
            "date_add(DATE'1994-01-01', cast(c_custkey % 365 as int) + 30 * (version - 1))"
            " AS fecha_registro",
            "concat('  ', c_name, '@Example.org ') AS email",
        ),
        "stg_usuarios": _versions(
            table("customer"), "c_custkey % 25 = 0 OR c_custkey % 30 = 0"
        ).selectExpr(
            "CASE WHEN c_custkey % 30 = 0 AND version = 2 THEN concat(' U', c_custkey, ' ')"
            " ELSE concat('u', c_custkey) END AS username",
            "concat(c_name, ' v', version) AS nombre_completo",
            "element_at(array('Administrador', ' vendedor', 'consulta'),"
            " cast(c_custkey % 3 as int) + 1) AS rol",
            "element_at(array('Si', 'NO', ' si ', 'no'), cast(c_custkey % 4 as int) + 1) AS activo",
            "date_add(DATE'1994-06-01', cast(c_custkey % 365 as int) + 10 * (version - 1))"
            " AS fecha_creacion",
        ),
        "stg_ventas_header": orders.selectExpr(
            "concat('F', o_orderkey) AS numero",
            "o_orderdate + make_dt_interval(0, cast(8 + o_orderkey % 11 as int)) AS fecha_hora",
            f"CASE WHEN o_orderkey % 20 <> 0 THEN {document('o_custkey')} END AS cliente_documento",
            "CASE WHEN o_orderkey % 6 = 3 THEN concat('U', o_custkey)"
            " WHEN o_orderkey % 6 <> 5 THEN concat('u', o_custkey) END AS usuario",
            "CASE WHEN o_orderkey % 7 < 3 THEN 'BS' WHEN o_orderkey % 7 < 6 THEN 'USD'"
            " ELSE 'COP' END AS moneda",
        ),
        "stg_ventas_detalle": lineitem.selectExpr(
            "concat('F', l_orderkey) AS numero",
            "concat(CASE WHEN l_partkey % 50 = 0 THEN 'X' ELSE 'P' END, l_partkey) AS product_codigo",
            "l_quantity AS cantidad",
            "l_extendedprice / l_quantity AS precio_unitario",
            "l_extendedprice AS subtotal",
        ),
        "stg_compras_header": lineitem.groupBy("l_orderkey", "l_suppkey")
        .agg(F.min("l_shipdate").alias("fecha_hora"))
        .selectExpr(
            f"{purchase} AS numero",
            "concat(CASE WHEN l_suppkey % 4 = 0 THEN 'NIT-' ELSE 'J-' END, l_suppkey)"
            " AS proveedor_documento",
            "fecha_hora",
        ),
        "stg_compras_detalle": lineitem.selectExpr(
            f"{purchase} AS numero",
            "concat('P', l_partkey) AS product_codigo",
            "l_quantity AS cantidad",
            "0.6D * (l_extendedprice / l_quantity) AS costo_unitario_usd",
            "0.6D * l_extendedprice AS subtotal_usd",
        ),
        "stg_movimientos_inventario": lineitem.selectExpr(
            "l_shipdate + make_dt_interval(0, cast(7 + l_orderkey % 12 as int)) AS fecha_hora",
            "concat('P', l_partkey) AS product_codigo",
            "CASE WHEN l_returnflag = 'R' THEN 'entrada'"
            " WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'import_inicial'"
            " WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'salida'"
            " WHEN l_returnflag = 'A' THEN 'ajuste_manual' ELSE 'venta' END AS tipo",
            "CASE l_linenumber % 3 WHEN 0 THEN ' ' WHEN 1 THEN 'Reposicion' END AS motivo",
            "l_quantity AS cantidad",
            "cast((7 * l_orderkey + 13 * l_linenumber + l_partkey) % 200 as double) AS stock_nuevo",
        ),
        "stg_feriados": _holidays(calendar),
        "stg_productos": _versions(table("part"), "p_partkey % 25 = 0").selectExpr(
            "CASE WHEN p_partkey % 97 = 0 AND version = 1 THEN '  '"
            " WHEN p_partkey % 10 = 0 THEN concat(' P', p_partkey, ' ')"
            " ELSE concat('P', p_partkey) END AS codigo",
            "CASE WHEN p_partkey % 3 = 0 THEN '' ELSE concat('N', p_partkey) END AS nro_original",
            "CASE WHEN p_partkey % 211 = 0 THEN NULL WHEN version = 2 THEN concat('zz ', p_name)"
            " ELSE concat(p_name, ' ', p_partkey) END AS descripcion",
            "CASE WHEN p_partkey % 40 = 0 THEN ' ' ELSE p_brand END AS marca",
            "p_retailprice * CASE version WHEN 2 THEN 0.5D ELSE 0.77D END AS costo_usd",
            "p_retailprice AS precio_venta_usd",
        ),
        "stg_proveedores": _versions(table("supplier"), "s_suppkey % 15 = 0")
        .join(table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "concat(CASE WHEN s_suppkey % 4 = 0 THEN 'NIT-' ELSE 'J-' END, s_suppkey,"
            " CASE WHEN s_suppkey % 7 = 0 THEN ' ' ELSE '' END) AS documento",
            "concat(' ', s_name, ' ', version) AS nombre",
            "CASE WHEN s_suppkey % 9 = 0 THEN 'sin direccion'"
            " ELSE concat('Av ', s_suppkey, ', Ciudad ', n_name, ', Estado') END AS direccion",
            "date_add(DATE'1994-01-01', cast(s_suppkey % 300 as int) + version) AS fecha_registro",
        ),
        "stg_tasas_cambio": calendar.where(F.dayofmonth("fecha") != DAY_WITHOUT_RATE)
        .withColumn("n", F.datediff("fecha", F.lit("1995-01-01").cast("date")))
        .selectExpr(
            "fecha",
            "2.0D + 0.001D * n AS tasa_bs_usd",
            "5.0D + 0.01D * (n % 30) AS cop_por_usd",
            "(2.0D + 0.001D * n) / (5.0D + 0.01D * (n % 30)) AS tasa_bs_cop",
        ),
    }
