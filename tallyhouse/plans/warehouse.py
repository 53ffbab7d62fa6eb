"""Core tables, rollups and marts, each built once and on first use."""

import threading
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from tallyhouse.operators.keys import assign_keys, file_offsets, in_order, with_keys
from tallyhouse.plans import dims, facts, rollups
from tallyhouse.plans.marts import calendar, currencies, customers, products, stock
from tallyhouse.plans.store import Store

# Staging inputs of every dimension and line table, then the tables it looks up.
DIMS: dict[str, tuple[Callable, list[str]]] = {
    "dim_clientes": (dims.customers, ["stg_clientes"]),
    "dim_usuarios": (dims.users, ["stg_usuarios"]),
    "dim_tiempo": (dims.calendar, ["stg_tasas_cambio", "stg_feriados"]),
    "dim_proveedor": (dims.suppliers, ["stg_proveedores"]),
    "dim_moneda": (dims.currencies, ["stg_ventas_header"]),
    "dim_hora": (dims.hours, ["stg_movimientos_inventario", "stg_ventas_header"]),
    "dim_producto": (dims.products, ["stg_productos"]),
    "dim_tipo_movimiento": (dims.movement_types, ["stg_movimientos_inventario"]),
}
LINES: dict[str, tuple[Callable, list[str]]] = {
    "purchase_lines": (
        facts.purchase_lines,
        [
            "stg_compras_header",
            "stg_compras_detalle",
            "dim_tiempo",
            "dim_producto",
            "dim_proveedor",
        ],
    ),
    "sale_lines": (
        facts.sale_lines,
        [
            "stg_ventas_header",
            "stg_ventas_detalle",
            "dim_tiempo",
            "dim_hora",
            "dim_moneda",
            "dim_clientes",
            "dim_usuarios",
            "dim_producto",
        ],
    ),
    "movement_lines": (
        facts.movement_lines,
        [
            "stg_movimientos_inventario",
            "dim_tiempo",
            "dim_hora",
            "dim_producto",
            "dim_tipo_movimiento",
        ],
    ),
}
ROLLUPS: dict[str, tuple[Callable, list[str]]] = {
    "sales_by_invoice": (rollups.sales_by_invoice, ["sale_lines"]),
    "sales_by_day": (rollups.sales_by_day, ["sales_by_invoice"]),
    "sales_by_product": (rollups.sales_by_product, ["sale_lines"]),
    "stock_by_product": (rollups.stock_by_product, ["movement_lines"]),
    "product_totals": (products.product_totals, ["sales_by_product", "dim_producto"]),
}
MARTS: dict[str, Callable[["Warehouse"], DataFrame]] = {
    "p01_top_productos": lambda w: products.top_products(
        w["product_totals"],
        w["sale_lines"],
        w["dim_producto"],
        w.store,
    ),
    "p04_margen": lambda w: products.margin_by_level(
        w["sales_by_product"], w["dim_producto"], w.collation
    ),
    "p06_inventario_muerto": lambda w: stock.dead_stock(
        *w.tables(["dim_producto", "sales_by_product", "stock_by_product"])
    ),
    "p06_inventario_muerto_resumen": lambda w: stock.dead_stock_summary(
        w["p06_inventario_muerto"]
    ),
    "p13_evolucion_ventas": lambda w: calendar.sales_evolution(w["sales_by_day"], w["dim_tiempo"]),
    "p15_ventas_por_dia_semana": lambda w: calendar.sales_by_weekday(
        w["sales_by_day"], w["dim_tiempo"]
    ),
    "p15_ventas_feriado_vs_normal": lambda w: calendar.sales_by_day_type(
        w["sales_by_day"], w["dim_tiempo"]
    ),
    "p15_ventas_por_feriado": lambda w: calendar.sales_by_holiday(
        w["sales_by_day"], w["dim_tiempo"]
    ),
    "p16_ticket_por_tipo_cliente": lambda w: customers.ticket_by_customer_type(
        rollups.invoices_by_type(w["sales_by_invoice"]), w.store
    ),
    "p18_mix_monedas": lambda w: currencies.currency_mix(w["sales_by_day"], w["dim_moneda"]),
    "p18_mix_monedas_mensual": lambda w: currencies.currency_mix_monthly(
        w["sales_by_day"], w["dim_tiempo"], w["dim_moneda"]
    ),
    "p19_tipo_cambio_mensual": lambda w: currencies.fx_monthly(
        w["sales_by_day"], w["dim_tiempo"], w["dim_moneda"]
    ),
    "p19_correlacion_fx": lambda w: currencies.fx_correlation(w["p19_tipo_cambio_mensual"]),
    "p19_margen_por_moneda": lambda w: currencies.margin_by_currency(
        w["sales_by_day"], w["dim_moneda"]
    ),
}
CORE = [*DIMS, *facts.FACT_LINES]


class Warehouse:
    """Tables by name. w["dim_producto"] builds and stores the table the first time.

    Product descriptions are compared by their bytes or, as a database may do, by a collation.
    """

    def __init__(
        self, staging: Mapping[str, DataFrame], store: Store, collation: str | None = None
    ):
        self.staging = staging
        self.store = store
        self.collation = collation
        self._tables: dict[str, DataFrame] = {}
        self._locks: dict[str, threading.RLock] = {}
        self._guard = threading.Lock()

    def __getitem__(self, name: str) -> DataFrame:
        if name in self.staging:
            return self.staging[name]
        with self._guard:
            lock = self._locks.setdefault(name, threading.RLock())
        with lock:
            if name not in self._tables:
                self._tables[name] = self._stored(name)
            return self._tables[name]

    def tables(self, names: list[str], threads: int = 4) -> list[DataFrame]:
        """Tables by name; those that are not there yet are built side by side.

        Most of a dimension's time is that of small jobs, which fill each other's gaps. A
        table waits only for tables it is made from, so no two wait for each other.
        """
        missing = [n for n in names if n not in self.staging and n not in self._tables]
        if len(missing) > 1:
            target = inheritable_thread_target(self.store.spark)(self.__getitem__)
            with ThreadPoolExecutor(threads) as pool:
                list(pool.map(target, missing))
        return [self[n] for n in names]

    def counted(self, name: str) -> DataFrame:
        """A table whose rows are to be counted and not read.

        A fact has the rows of its lines. Where neither is stored, neither is written: Spark
        leaves out of the lines' plan all columns but those that decide how many rows there are.
        """
        if name not in facts.FACT_LINES or name in self._tables:
            return self[name]
        source, _ = facts.FACT_LINES[name]
        return self[source] if source in self._tables else self.lines(source)

    def plan(self, name: str) -> DataFrame:
        """A mart as a lazy query over stored tables, itself not stored."""
        return MARTS[name](self)

    def dimension(self, name: str) -> DataFrame:
        """Dimension rows before keys are assigned."""
        build, inputs = DIMS[name]
        options = {"collation": self.collation} if build is dims.products else {}
        return build(*self.tables(inputs), **options)

    def lines(self, name: str) -> DataFrame:
        build, inputs = LINES[name]
        return build(*self.tables(inputs))

    def fact(self, name: str) -> DataFrame:
        """A fact, stored in the order of its source column, which its keys follow.

        Beside the lines it is written once: a key is the row's place in the stored files.
        """
        source, first = facts.FACT_LINES[name]
        key, *columns = facts.FACT_COLUMNS[name]
        order = [first, *[c for c in columns if c != first]]
        needed = self[source].select(*dict.fromkeys(order))
        written = self.store.save("core", name, in_order(needed, order).select(*columns))
        offsets = self.store.save("work", f"{name}_offsets", file_offsets(written))
        return with_keys(written, offsets, key)

    def _stored(self, name: str) -> DataFrame:
        with self.store.temporary():
            return self._build(name)

    def _build(self, name: str) -> DataFrame:
        if name in DIMS:
            key, order = dims.KEYS[name]
            rows = self.store.keep(f"{name}_rows", self.dimension(name))
            keyed = assign_keys(rows, order, key, self.store, name)
            return self.store.save("core", name, keyed.drop("hora_desc"))
        if name in facts.FACT_LINES:
            return self.fact(name)
        if name in LINES:
            return self.store.save("work", name, self.lines(name))
        if name in ROLLUPS:
            build, inputs = ROLLUPS[name]
            return self.store.save("work", name, build(*self.tables(inputs)))
        return self.store.save("marts", name, self.plan(name))
