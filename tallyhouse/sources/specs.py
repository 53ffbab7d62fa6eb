"""The staging inputs: which file feeds which table, and with which columns."""

from dataclasses import dataclass, field
from pathlib import PurePosixPath

# Cell texts that count as missing, as spreadsheet readers commonly treat them.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Columns and types of every staging table; other columns stay as they are.
SCHEMAS = {
    "stg_clientes": "documento string, nombre string, fecha_registro date, email string",
    "stg_usuarios": "username string, nombre_completo string, rol string, activo string,"
    " fecha_creacion date",
    "stg_ventas_header": "numero string, fecha_hora timestamp_ntz, cliente_documento string,"
    " usuario string, moneda string",
    "stg_ventas_detalle": "numero string, product_codigo string, cantidad double,"
    " precio_unitario double, subtotal double",
    "stg_compras_header": "numero string, proveedor_documento string, fecha_hora timestamp_ntz",
    "stg_compras_detalle": "numero string, product_codigo string, cantidad double,"
    " costo_unitario_usd double, subtotal_usd double",
    "stg_movimientos_inventario": "fecha_hora timestamp_ntz, product_codigo string, tipo string,"
    " motivo string, cantidad double, stock_nuevo double",
    "stg_feriados": "fecha date, feriado string",
    "stg_productos": "codigo string, nro_original string, descripcion string, marca string,"
    " costo_usd double, precio_venta_usd double",
    "stg_proveedores": "documento string, nombre string, direccion string, fecha_registro date",
    "stg_tasas_cambio": "fecha date, tasa_bs_usd double, cop_por_usd double, tasa_bs_cop double",
    "stg_tasas_cambio_fuentes": "",
}


@dataclass(frozen=True)
class SourceSpec:
    """One input file (or folder) and the staging table it fills."""

    path: str
    table: str
    format: str = "csv"
    options: dict[str, str] = field(default_factory=dict)
    null_tokens: tuple[str, ...] = NULL_TOKENS

    @property
    def file_name(self) -> str:
        return PurePosixPath(self.path).name

    @property
    def schema(self) -> str:
        return SCHEMAS.get(self.table, "")


def folder_manifest(folder: str, format: str = "csv", extension: str | None = None) -> list[SourceSpec]:
    """One source per staging table, named after it."""
    suffix = f".{extension or format}"
    return [
        SourceSpec(f"{folder.rstrip('/')}/{table.removeprefix('stg_')}{suffix}", table, format)
        for table in SCHEMAS
    ]
