"""The constraints of the star schema as counts of offending rows.

Nothing is rejected here: every rule yields one row with the number of rows (or
keys) that break it, so that a rule with zero is visible too.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.money import money, overflows, whole
from tallyhouse.functions.text import after_prefix
from tallyhouse.plans.dims import reason
from tallyhouse.plans.facts import OVERFLOWS

# Mandatory columns, code domains and text lengths of the schema.
NOT_NULL = {
    "dim_clientes": ["documento", "nombre", "fecha_registro", "email"],
    "dim_usuarios": ["username", "nombre_completo", "rol", "activo", "fecha_creacion"],
    "dim_tiempo": ["fecha", "tasa_bs_usd", "cop_por_usd", "tasa_bs_cop"],
    "dim_proveedor": ["documento", "nombre", "pais"],
    "dim_moneda": ["codigo"],
    "dim_hora": ["hora"],
    "dim_producto": ["codigo", "descripcion", "costo_usd", "precio_venta_usd"],
    "dim_tipo_movimiento": ["codigo", "nombre", "motivo"],
    "purchase_lines": ["cantidad", "cost_unt_usd", "subtotal_usd"],
    "sale_lines": ["nro_factura", "cantidad", "precio_unit_usd", "subtotal_usd"],
    "movement_lines": ["cantidad_neta", "stock_resultante"],
}
DOMAINS = {
    "dim_clientes": {"tipo": ["V", "E", "J"]},
    "dim_usuarios": {"rol": ["administrador", "vendedor", "consulta"]},
    "dim_proveedor": {"pais": ["VE", "CO"]},
    "dim_hora": {"franja": ["manana", "mediodia", "tarde"]},
}
MAX_LENGTH = {
    "dim_clientes": {"documento": 50, "nombre": 100, "email": 255},
    "dim_usuarios": {"username": 50, "nombre_completo": 150},
    "dim_tiempo": {"nombre_feriado": 255},
    "dim_proveedor": {"documento": 50, "nombre": 255, "ciudad": 100},
    "dim_moneda": {"codigo": 10},
    "dim_producto": {
        "codigo": 100,
        "nro_original": 100,
        "descripcion": 500,
        "marca": 100,
        "categoria": 100,
    },
    "dim_tipo_movimiento": {"codigo": 50, "nombre": 100, "motivo": 200, "efecto_stock": 10},
    "sale_lines": {"nro_factura": 50},
}
# Keys that must be unique, and natural keys that facts are looked up by: a
# natural key that repeats multiplies the fact rows that refer to it.
UNIQUE = {"dim_tipo_movimiento": ["codigo", "motivo"]}
NATURAL_KEYS = {
    "dim_clientes": "documento",
    "dim_usuarios": "username",
    "dim_proveedor": "documento",
    "dim_producto": "codigo",
    "dim_tiempo": "fecha",
}
FACT_NAMES = {
    "purchase_lines": "fact_compras",
    "sale_lines": "fact_ventas",
    "movement_lines": "fact_mov_inventario",
}
# Rules that stop a load in a database with declared constraints.
STRICT_RULES = ("no_nulo", "dominio", "longitud", "unico", "precision")
# What a rule counts: rows, keys that repeat, rows whose key is not known.
ROWS, REPEATED, MISSING = "rows", "repeated", "missing"
# Values that become NULL because they do not fit their column, told apart from missing ones.
PRECISION: dict[str, dict[str, Callable[[Column], Column]]] = {
    "stg_productos": {
        "costo_usd": lambda c: money(c, 12),
        "precio_venta_usd": lambda c: money(c, 12),
    },
    "stg_ventas_detalle": {"cantidad": whole},
    "stg_compras_detalle": {"cantidad": whole, "costo_unitario_usd": money, "subtotal_usd": money},
    "stg_movimientos_inventario": {"cantidad": whole, "stock_nuevo": whole},
}


class _Rules:
    """All rules by number, and what the rows of each table contribute to them.

    A contribution is (rule, key, rows, parent). Rules about rows have no key; rules
    about keys count per key, references also which keys are known.
    """

    def __init__(self):
        self.rules: list[tuple[str, str, str, str]] = []
        self.parts: dict[str, list[Column]] = {}
        self.counts: dict[str, list[Column]] = {}

    def add(self, table: str, column: str, rule: str, kind: str) -> int:
        self.rules.append((table, column, rule, kind))
        return len(self.rules) - 1

    def count(self, table: str, rule: int, when: Column) -> None:
        part = F.struct(F.lit(rule).alias("rule"), F.count_if(when).alias("rows"))
        self.counts.setdefault(table, []).append(part)

    def give(
        self, table: str, rule: int, when: Column | None, key: Column | None = None, parent: bool = False
    ) -> None:
        part = F.struct(
            F.lit(rule).alias("rule"),
            (F.lit(None) if key is None else key).cast("string").alias("key"),
            F.lit(0 if parent else 1).cast("bigint").alias("rows"),
            F.lit(parent).alias("parent"),
        )
        self.parts.setdefault(table, []).append(part if when is None else F.when(when, part))


def quality_checks(warehouse) -> DataFrame:
    """tabla, columna, regla and the number of rows or keys that break the rule.

    Every table is read once. What its rows contribute to all rules is counted per rule
    and key with map-side combine, in one shuffle for all tables; no tables are joined.
    Tables without a rule about keys are only counted.
    """
    rules = _Rules()
    _column_rules(rules)
    _key_rules(rules)
    _precision_rules(rules)
    _reference_rules(rules)
    given = [
        warehouse[table].select(F.inline(F.array(*parts))).where("rule IS NOT NULL")
        for table, parts in rules.parts.items()
    ]
    per_key = _union(given).groupBy("rule", "key").agg(
        F.sum("rows").alias("rows"), F.max("parent").alias("known")
    )
    kinds = F.array(*[F.lit(kind) for *_, kind in rules.rules])
    kind = F.element_at(kinds, F.col("rule") + 1)
    broken = (
        F.when(kind == REPEATED, (F.col("rows") > 1).cast("bigint"))
        .when((kind == MISSING) & F.col("known"), F.lit(0))
        .otherwise(F.col("rows"))
    )
    counted = per_key.groupBy("rule").agg(F.sum(broken).alias("rows"))
    for table, counts in rules.counts.items():
        found = warehouse[table].agg(F.array(*counts).alias("counts"))
        counted = counted.unionByName(found.select(F.inline("counts")))
    listed = [
        F.struct(
            F.lit(number).alias("rule"),
            F.lit(table).alias("tabla"),
            F.lit(column).alias("columna"),
            F.lit(rule).alias("regla"),
        )
        for number, (table, column, rule, _) in enumerate(rules.rules)
    ]
    # One row per rule: a fixed number.
    names = warehouse.store.spark.range(1).select(F.inline(F.array(*listed)))
    return names.join(F.broadcast(counted), "rule", "left").select(
        "tabla", "columna", "regla", F.coalesce("rows", F.lit(0)).cast("bigint").alias("filas")
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    """Union in halves: every step analyzes its input again, so a chain would be quadratic."""
    if len(frames) == 1:
        return frames[0]
    middle = len(frames) // 2
    return _union(frames[:middle]).union(_union(frames[middle:]))


def _column_rules(rules: _Rules) -> None:
    for table, columns in NOT_NULL.items():
        broken = {(c, "no_nulo"): F.col(c).isNull() for c in columns}
        for c, allowed in DOMAINS.get(table, {}).items():
            broken[c, "dominio"] = ~F.col(c).isin(allowed)
        for c, length in MAX_LENGTH.get(table, {}).items():
            broken[c, "longitud"] = F.length(c) > length
        for c, flag in OVERFLOWS.items() if table == "sale_lines" else ():
            broken[c, "precision"] = F.col(flag)
        for (column, rule), when in broken.items():
            number = rules.add(FACT_NAMES.get(table, table), column, rule, ROWS)
            if table in FACT_NAMES:
                rules.count(table, number, when)
            else:
                rules.give(table, number, when)


def _key_rules(rules: _Rules) -> None:
    keys = [(t, columns, "unico") for t, columns in UNIQUE.items()]
    keys += [(t, [column], "clave_repetida") for t, column in NATURAL_KEYS.items()]
    for table, columns, rule in keys:
        number = rules.add(table, ", ".join(columns), rule, REPEATED)
        rules.give(table, number, None, F.to_json(F.struct(*columns)))


def _precision_rules(rules: _Rules) -> None:
    """Numbers that are there but do not fit; amounts of sales are checked after conversion."""
    for table, columns in PRECISION.items():
        for c, fit in columns.items():
            number = rules.add(table, c, "precision", ROWS)
            rules.give(table, number, overflows(F.col(c), fit(F.col(c))))


def _reference_rules(rules: _Rules) -> None:
    """Staging rows that find no partner: dropped by inner joins, NULL in outer ones."""

    def kind(code: str, motive: Column) -> Column:
        return F.concat_ws("\n", code, motive)

    day, product = F.unix_date(F.to_date("fecha_hora")), F.col("product_codigo")
    customer = after_prefix("cliente_documento")
    number = F.col("numero")
    move = F.when(F.col("tipo").isNotNull(), kind("tipo", reason("motivo")))
    dates, codes = ("dim_tiempo", F.unix_date("fecha")), ("dim_producto", F.col("codigo"))
    # Column, key, parent table and its key, and whether a missing key is allowed.
    references = {
        "stg_ventas_detalle": [
            ("numero", number, ("stg_ventas_header", number), False),
            ("product_codigo", product, codes, False),
        ],
        "stg_ventas_header": [
            ("fecha_hora", day, dates, False),
            ("cliente_documento", customer, ("dim_clientes", F.col("documento")), True),
            ("usuario", F.col("usuario"), ("dim_usuarios", F.col("username")), True),
        ],
        "stg_compras_detalle": [
            ("numero", number, ("stg_compras_header", number), False),
            ("product_codigo", product, codes, False),
        ],
        "stg_compras_header": [
            (
                "proveedor_documento",
                F.col("proveedor_documento"),
                ("dim_proveedor", F.col("documento")),
                False,
            ),
            ("fecha_hora", day, dates, False),
        ],
        "stg_movimientos_inventario": [
            ("product_codigo", product, codes, False),
            ("fecha_hora", day, dates, False),
            (
                "tipo, motivo",
                move,
                ("dim_tipo_movimiento", kind("codigo", F.col("motivo"))),
                False,
            ),
        ],
    }
    for table, listed in references.items():
        for column, key, (parent, parent_key), optional in listed:
            rule = rules.add(table, column, "sin_referencia", MISSING)
            rules.give(table, rule, key.isNotNull() if optional else None, key)
            rules.give(parent, rule, parent_key.isNotNull(), parent_key, parent=True)
