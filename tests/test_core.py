"""Dimensions, facts and checks on hand-written dirt."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tallyhouse.plans.quality import quality_checks
from tallyhouse.plans.report import currency_share_pivot, currency_stack_offsets
from tallyhouse.plans.store import Store
from tallyhouse.plans.warehouse import Warehouse
from tallyhouse.sources.specs import SCHEMAS

DAY = date(2024, 5, 1)
NOON = datetime(2024, 5, 1, 12, 30)


def rows(**tables):
    base = {
        "stg_clientes": [
            ("V-1", "Ana", date(2020, 1, 1), " Ana@X.org "),
            ("J-1", "Taller", date(2020, 1, 2), "t@x.org"),
            ("v-2", "Luis", date(2021, 1, 1), "late@x.org"),
            ("v-2", "Luis", date(2020, 1, 1), "early@x.org"),
            (None, "Nobody", DAY, "n@x.org"),
        ],
        "stg_usuarios": [
            ("ana", "Ana", " Vendedor", " si ", DAY),
            ("Ana ", "Ana B", "consulta", "No", DAY),
        ],
        "stg_ventas_header": [
            ("F1", NOON, "V-2", "ana", "BS"),
            ("F2", NOON, "V-1", "Ana", "USD"),
            ("F3", NOON, None, None, "EUR"),
            ("F4", datetime(2024, 5, 9, 9), None, None, "USD"),
        ],
        "stg_ventas_detalle": [
            ("F1", "P1", 2.0, 25.0, 50.0),
            ("F2", "P1", 1.0, 10.0, 10.0),
            ("F3", "P1", 2.6, 7.0, 18.2),
            ("F4", "P1", 1.0, 10.0, 10.0),
            ("F9", "P1", 1.0, 10.0, 10.0),
            ("F1", "PX", 1.0, 10.0, 10.0),
        ],
        "stg_compras_header": [("C1", "NIT-7", NOON), ("C2", "J-404", NOON)],
        "stg_compras_detalle": [("C1", "P1", 5.0, 3.333, 16.665), ("C2", "P1", 1.0, 1.0, 1.0)],
        "stg_movimientos_inventario": [
            (datetime(2024, 5, 1, 11, 0), "P1", "entrada", None, 5.0, 5.0),
            (datetime(2024, 5, 1, 13, 0), "P1", "venta", " ", -5.0, 0.0),
            (datetime(2024, 5, 1, 13, 0), "P1", "ajuste_manual", "Conteo", 2.0, 7.0),
        ],
        "stg_feriados": [],
        "stg_productos": [
            (" P1 ", "", "Filtro aceite", " ", 8.0, 10.0),
            ("P1", "N1", "Zeta", "M", 9.0, 11.0),
            ("  ", None, "Bujia larga", "M", 1.0, 2.0),
            (None, None, "Bujia larga ", "M", 1.0, 2.0),
            ("P2", None, None, "M", 1.0, 2.0),
        ],
        "stg_proveedores": [
            ("NIT-7", " Uno ", "a, San Cristobal, Tachira", DAY),
            ("J-8", "Dos", "solo", DAY),
        ],
        "stg_tasas_cambio": [(DAY, 2.5, 4.0, 0.625)],
    }
    return base | tables


@pytest.fixture
def build(spark, tmp_path):
    def _build(**tables):
        staging = {
            name: spark.createDataFrame(data, SCHEMAS[name]) for name, data in rows(**tables).items()
        }
        return Warehouse(staging, Store(spark, str(tmp_path / "wh")))

    return _build


@pytest.fixture(scope="module")
def usual(spark, tmp_path_factory):
    """The warehouse over the unchanged rows, built once."""
    staging = {name: spark.createDataFrame(data, SCHEMAS[name]) for name, data in rows().items()}
    return Warehouse(staging, Store(spark, str(tmp_path_factory.mktemp("usual"))))


def pick(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_customers(usual):
    w = usual
    assert pick(w["dim_clientes"], "documento", "tipo", "email") == [
        ("1", "J", "t@x.org"),
        ("1", "V", "ana@x.org"),
        ("2", "V", "early@x.org"),
    ]


def test_users_and_suppliers(usual):
    w = usual
    assert pick(w["dim_usuarios"], "username", "rol", "activo") == [
        ("ana", "consulta", False),
        ("ana", "vendedor", True),
    ]
    assert pick(w["dim_proveedor"], "documento", "nombre", "ciudad", "pais") == [
        ("J-8", "Dos", "", "VE"),
        ("NIT-7", "Uno", "San Cristobal", "CO"),
    ]


def test_products(usual):
    w = usual
    assert pick(w["dim_producto"], "codigo", "descripcion", "categoria", "costo_usd") == [
        ("P1", "Filtro aceite", "FILTRO", Decimal("8.00")),
        ("SIN-CODIGO", "Bujia larga", "BUJIA", Decimal("1.00")),
    ]
    first = w["dim_producto"].where("codigo = 'P1'").first()
    assert (first.marca, first.nro_original, first.stock_minimo) == (None, None, 0)


def test_hours_and_movement_types(usual):
    w = usual
    assert [tuple(r) for r in w["dim_hora"].orderBy("sk_hora").collect()] == [
        (1, 13, "tarde"),
        (2, 12, "mediodia"),
        (3, 11, "manana"),
        (4, 9, "manana"),
    ]
    kinds = pick(w["dim_tipo_movimiento"], "codigo", "nombre", "motivo", "signo_stock")
    assert kinds == [
        ("ajuste_manual", "Ajuste Manual", "Conteo", -1),
        ("entrada", "Entrada", "SIN MOTIVO", 1),
        ("venta", "Venta", "SIN MOTIVO", -1),
    ]


def test_sales_convert_drop_and_multiply(usual):
    w = usual
    columns = ("nro_factura", "cantidad", "precio_unit_usd", "subtotal_usd")
    # F1 meets the two users called ana, F2 the two customers whose document is 1,
    # F3 has an unknown currency, F4 has no rate, F9 no header, PX no product.
    assert pick(w["fact_ventas"], *columns) == [
        ("F1", 2, Decimal("10.00"), Decimal("20.00")),
        ("F1", 2, Decimal("10.00"), Decimal("20.00")),
        ("F2", 1, Decimal("10.00"), Decimal("10.00")),
        ("F2", 1, Decimal("10.00"), Decimal("10.00")),
        ("F3", 3, Decimal("7.00"), Decimal("18.20")),
    ]
    assert [r.sk_venta for r in w["fact_ventas"].orderBy("sk_venta").collect()] == [1, 2, 3, 4, 5]
    f2 = w["fact_ventas"].where("nro_factura = 'F2'")
    assert {r.sk_empleado for r in f2.collect()} == {None}
    assert f2.select("sk_cliente").distinct().count() == 2


def test_two_holidays_on_a_day_multiply_facts(build):
    w = build(stg_feriados=[(DAY, "Trabajador"), (DAY, "Extra")])
    assert w["dim_tiempo"].count() == 2
    assert w["fact_ventas"].count() == 10
    assert w["fact_compras"].count() == 2
    kinds = w["p15_ventas_feriado_vs_normal"].collect()
    assert [(k.tipo_dia, k.dias_con_ventas, k.nro_facturas) for k in kinds] == [("FERIADO", 1, 3)]
    holidays = pick(w["p15_ventas_por_feriado"], "nombre_feriado", "nro_facturas", "ingreso_usd")
    assert holidays == [("Extra", 3, Decimal("78.20")), ("Trabajador", 3, Decimal("78.20"))]


def test_zero_rate_gives_null_price_and_is_counted(build):
    w = build(stg_tasas_cambio=[(DAY, 0.0, 4.0, 0.0)])
    assert w["sale_lines"].where("precio_unit_usd IS NULL").count() == 2
    broken = {(r.tabla, r.columna, r.regla): r.filas for r in quality_checks(w).collect()}
    assert broken["fact_ventas", "precio_unit_usd", "no_nulo"] == 2


def test_movements(usual):
    w = usual
    columns = ("cantidad_entrada", "cantidad_salida", "cantidad_neta", "stock_resultante")
    assert pick(w["fact_mov_inventario"], *columns) == [
        (0, 2, -2, 7),
        (0, 5, -5, 0),
        (5, 0, 5, 5),
    ]


def test_dead_stock_classes(usual):
    w = usual
    by_code = {r.codigo: r for r in w["p06_inventario_muerto"].collect()}
    sold, never = by_code["P1"], by_code["SIN-CODIGO"]
    # Two movements at 13:00: the higher resulting stock counts.
    assert (sold.stock_actual, sold.capital_inmovilizado_usd) == (7, Decimal("56.00"))
    assert (sold.dias_sin_vender, sold.clasificacion, sold.es_inventario_muerto) == (0, "ACTIVO", False)
    assert (never.stock_actual, never.dias_sin_vender) == (0, None)
    assert (never.clasificacion, never.es_inventario_muerto) == ("NUNCA VENDIDO", True)


def test_null_brand_is_not_a_subtotal(usual):
    w = usual
    levels = {(r.nivel, r.categoria, r.marca, r.codigo) for r in w["p04_margen"].collect()}
    assert levels == {
        ("PRODUCTO", "FILTRO", None, "P1"),
        ("MARCA", None, None, None),
        ("CATEGORIA", "FILTRO", None, None),
    }


def test_month_without_currency_and_single_month(build):
    w = build(stg_ventas_header=[("F1", NOON, None, None, "USD")])
    month = w["p19_tipo_cambio_mensual"].first()
    assert month.ingreso_usd_cobrado_en_bs is None
    assert month.pct_ingreso_expuesto_a_fx == 0
    assert month.var_pct_ingreso_usd is None
    assert w["p13_evolucion_ventas"].where("ingreso_usd_periodo_anterior IS NOT NULL").count() == 0
    correlation = w["p19_correlacion_fx"].first()
    assert tuple(correlation) == (0, None, None, None, None)


def test_no_sales_at_all(build):
    w = build(stg_ventas_detalle=[])
    assert w["p18_mix_monedas"].count() == 0
    assert w["p01_top_productos"].count() == 0
    assert w["p16_ticket_por_tipo_cliente"].count() == 0
    assert {r.clasificacion for r in w["p06_inventario_muerto"].collect()} == {"NUNCA VENDIDO"}


def test_quality_counts(usual):
    broken = {
        (r.tabla, r.columna, r.regla): r.filas for r in quality_checks(usual).collect() if r.filas
    }
    assert broken == {
        ("dim_clientes", "documento", "clave_repetida"): 1,
        ("dim_usuarios", "username", "clave_repetida"): 1,
        ("stg_ventas_detalle", "numero", "sin_referencia"): 1,
        ("stg_ventas_detalle", "product_codigo", "sin_referencia"): 1,
        ("stg_ventas_header", "fecha_hora", "sin_referencia"): 1,
        ("stg_ventas_header", "usuario", "sin_referencia"): 1,
        ("stg_compras_header", "proveedor_documento", "sin_referencia"): 1,
    }


def test_a_fourth_currency_is_part_of_the_pivot(usual):
    shares = currency_share_pivot(usual)
    assert shares.columns == ["mes_inicio", "bs", "usd", "cop", "eur"]
    (share,) = shares.collect()
    assert share.eur > 0 and share.cop == 0 and abs(sum(share[1:]) - 100) < Decimal("0.05")
    (offset,) = currency_stack_offsets(usual).collect()
    assert offset.base_bs == 0 and offset.base_usd == share.bs
    assert offset.base_eur == share.bs + share.usd + share.cop
    assert offset.tope == sum(share[1:])


def test_descriptions_follow_bytes_or_a_collation(spark, tmp_path):
    texts = ["\u00e1", "B", "a", "z"]
    products = [("P1", None, t, "M", 1.0, 2.0) for t in texts[:3]]
    products += [(f"Q{i}", None, t, "N", 1.0, 2.0) for i, t in enumerate(texts[:3])]
    tables = rows(stg_productos=products)
    tables["stg_ventas_detalle"] = [("F2", f"Q{i}", 1.0, 1.0, 1.0) for i in range(3)]

    def built(collation):
        staging = {
            name: spark.createDataFrame(data, T.StructType.fromDDL(SCHEMAS[name]))
            for name, data in tables.items()
        }
        w = Warehouse(staging, Store(spark, str(tmp_path / str(collation))), collation)
        chosen = w["dim_producto"].where("codigo = 'P1'").first().descripcion
        brand = w["p04_margen"].where("nivel = 'MARCA' AND marca = 'N'").first().descripcion
        return chosen, brand

    assert built(None) == ("B", "\u00e1")  # upper case first, accents last
    assert built("UNICODE") == ("a", "B")  # a, then a with an accent, then b
