"""The same results as SQL for a second engine, straight from the raw test tables.

Nothing here uses the rollups: every measure is recomputed from the lines, and
distinct counts are plain COUNT(DISTINCT), so a mistake in a rollup shows up.
"""

import re

from tallyhouse.plans import quality


def money(x: str, precision: int = 14) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), 2) AS DECIMAL({precision},2))"


def fixed(x: str, places: int = 2) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(38,10)), {places}) AS DECIMAL(18,{places}))"


def ratio(a: str, b: str, places: int = 2) -> str:
    return fixed(f"CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)", places)


def percent(a: str, b: str, places: int = 2) -> str:
    return fixed(f"100 * CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0)", places)


def total(x: str) -> str:
    return f"CAST(SUM({x}) AS DECIMAL(24,2))"


def whole(x: str) -> str:
    return f"CAST({x} AS INTEGER)"


def bigint(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def document(key: str) -> str:
    letter = f"substr('VJE', CAST({key} % 3 AS INT) + 1, 1)"
    number = f"CASE WHEN {key} % 50 = 1 THEN {key} - 1 ELSE {key} END"
    return f"(CASE WHEN {key} % 7 = 0 THEN lower({letter}) ELSE {letter} END) || '-' || ({number})"


def versions(condition: str) -> str:
    return f"UNNEST(CASE WHEN {condition} THEN [1, 2] ELSE [1] END) AS version"


DAYS_SPAN = """
  SELECT min(d) AS a, max(d) AS b
  FROM (SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem)
"""

# Units of the invoice currency that buy one dollar.
UNITS = """nullif(CASE i.moneda WHEN 'BS' THEN c.tasa_bs_usd WHEN 'COP' THEN c.cop_por_usd
      ELSE CAST(1 AS DOUBLE) END, 0)"""

# Common table expressions in dependency order.
CTES: dict[str, str] = {
    "days": f"""
  SELECT CAST(UNNEST(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS fecha
  FROM ({DAYS_SPAN})""",
    "raw_holidays": """
  SELECT fecha, CASE strftime(fecha, '%m-%d') WHEN '01-01' THEN 'Año Nuevo'
    WHEN '05-01' THEN 'Día del Trabajador' WHEN '07-24' THEN 'Natalicio'
    WHEN '12-24' THEN 'Nochebuena' WHEN '12-31' THEN 'Fin de Año' END AS feriado
  FROM days WHERE strftime(fecha, '%m-%d') IN ('01-01', '05-01', '07-24', '12-24', '12-31')
  UNION ALL SELECT fecha, 'Día Extra' FROM days WHERE fecha = DATE '1998-05-01'""",
    "raw_rates": """
  SELECT fecha, CAST(2 AS DOUBLE) + CAST(0.001 AS DOUBLE) * n AS bs,
    CAST(5 AS DOUBLE) + CAST(0.01 AS DOUBLE) * (n % 30) AS cop
  FROM (SELECT fecha, date_diff('day', DATE '1995-01-01', fecha) AS n FROM days)
  WHERE day(fecha) <> 31""",
    "raw_customers": f"""
  SELECT {document("c_custkey")} AS documento,
    CASE version WHEN 2 THEN c_name || ' (2)' ELSE c_name END AS nombre,
    DATE '1994-01-01' + CAST(c_custkey % 365 AS INT) + 30 * (version - 1) AS fecha_registro,
    '  ' || c_name || '@Example.org ' AS email
  FROM (SELECT *, {versions("c_custkey % 20 = 0")} FROM customer)""",
    "raw_users": f"""
  SELECT CASE WHEN c_custkey % 30 = 0 AND version = 2 THEN ' U' || c_custkey || ' '
      ELSE 'u' || c_custkey END AS username,
    c_name || ' v' || version AS nombre_completo,
    ['Administrador', ' vendedor', 'consulta'][CAST(c_custkey % 3 AS INT) + 1] AS rol,
    ['Si', 'NO', ' si ', 'no'][CAST(c_custkey % 4 AS INT) + 1] AS activo,
    DATE '1994-06-01' + CAST(c_custkey % 365 AS INT) + 10 * (version - 1) AS fecha_creacion
  FROM (SELECT *, {versions("c_custkey % 25 = 0 OR c_custkey % 30 = 0")} FROM customer)""",
    "raw_products": f"""
  SELECT CASE WHEN p_partkey % 97 = 0 AND version = 1 THEN '  '
      WHEN p_partkey % 10 = 0 THEN ' P' || p_partkey || ' ' ELSE 'P' || p_partkey END AS codigo,
    CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'N' || p_partkey END AS nro_original,
    CASE WHEN p_partkey % 211 = 0 THEN NULL WHEN version = 2 THEN 'zz ' || p_name
      ELSE p_name || ' ' || p_partkey END AS descripcion,
    CASE WHEN p_partkey % 40 = 0 THEN ' ' ELSE p_brand END AS marca,
    p_retailprice * CASE version WHEN 2 THEN CAST(0.5 AS DOUBLE) ELSE CAST(0.77 AS DOUBLE) END AS costo,
    p_retailprice AS precio
  FROM (SELECT *, {versions("p_partkey % 25 = 0")} FROM part)""",
    "raw_suppliers": f"""
  SELECT (CASE WHEN s_suppkey % 4 = 0 THEN 'NIT-' ELSE 'J-' END) || s_suppkey
      || (CASE WHEN s_suppkey % 7 = 0 THEN ' ' ELSE '' END) AS documento,
    ' ' || s_name || ' ' || version AS nombre,
    CASE WHEN s_suppkey % 9 = 0 THEN 'sin direccion'
      ELSE 'Av ' || s_suppkey || ', Ciudad ' || n_name || ', Estado' END AS direccion,
    DATE '1994-01-01' + CAST(s_suppkey % 300 AS INT) + version AS fecha_registro
  FROM (SELECT *, {versions("s_suppkey % 15 = 0")} FROM supplier) s
  JOIN nation ON n_nationkey = s.s_nationkey""",
    "raw_invoices": f"""
  SELECT 'F' || o_orderkey AS numero, o_orderdate + to_hours(8 + o_orderkey % 11) AS fecha_hora,
    CASE WHEN o_orderkey % 20 <> 0 THEN {document("o_custkey")} END AS cliente,
    CASE WHEN o_orderkey % 6 = 3 THEN 'U' || o_custkey
      WHEN o_orderkey % 6 <> 5 THEN 'u' || o_custkey END AS usuario,
    CASE WHEN o_orderkey % 7 < 3 THEN 'BS' WHEN o_orderkey % 7 < 6 THEN 'USD' ELSE 'COP' END AS moneda
  FROM orders""",
    "raw_invoice_lines": """
  SELECT 'F' || l_orderkey AS numero,
    (CASE WHEN l_partkey % 50 = 0 THEN 'X' ELSE 'P' END) || l_partkey AS producto,
    l_quantity AS cantidad, l_extendedprice / l_quantity AS precio, l_extendedprice AS subtotal
  FROM lineitem""",
    "raw_purchases": """
  SELECT 'C' || l_orderkey || '-' || l_suppkey AS numero,
    (CASE WHEN l_suppkey % 4 = 0 THEN 'NIT-' ELSE 'J-' END) || l_suppkey AS proveedor,
    min(l_shipdate) AS fecha_hora
  FROM lineitem GROUP BY l_orderkey, l_suppkey""",
    "raw_purchase_lines": """
  SELECT 'C' || l_orderkey || '-' || l_suppkey AS numero, 'P' || l_partkey AS producto,
    l_quantity AS cantidad,
    CAST(0.6 AS DOUBLE) * (l_extendedprice / l_quantity) AS costo,
    CAST(0.6 AS DOUBLE) * l_extendedprice AS subtotal
  FROM lineitem""",
    "raw_moves": """
  SELECT l_shipdate + to_hours(7 + l_orderkey % 12) AS fecha_hora, 'P' || l_partkey AS producto,
    CASE WHEN l_returnflag = 'R' THEN 'entrada'
      WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'import_inicial'
      WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'salida'
      WHEN l_returnflag = 'A' THEN 'ajuste_manual' ELSE 'venta' END AS tipo,
    CASE l_linenumber % 3 WHEN 0 THEN ' ' WHEN 1 THEN 'Reposicion' END AS motivo,
    l_quantity AS cantidad, (7 * l_orderkey + 13 * l_linenumber + l_partkey) % 200 AS stock
  FROM lineitem""",
    # Dimensions, numbered in the order that the key assignment promises.
    "customers": """
  SELECT row_number() OVER (ORDER BY documento, tipo, fecha_registro, nombre, email) AS sk_cliente, *
  FROM (SELECT substr(documento, 3) AS documento, upper(substr(documento, 1, 1)) AS tipo, nombre,
      fecha_registro, lower(trim(email)) AS email
    FROM raw_customers WHERE documento IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY documento ORDER BY fecha_registro, nombre, email) = 1)""",
    "users": """
  SELECT row_number() OVER (ORDER BY username, fecha_creacion, nombre_completo, rol, activo) AS sk_usuario, *
  FROM (SELECT lower(trim(username)) AS username, nombre_completo, lower(trim(rol)) AS rol,
      upper(trim(activo)) = 'SI' AS activo, fecha_creacion
    FROM raw_users u WHERE username IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY u.username
      ORDER BY u.fecha_creacion, u.nombre_completo, u.rol, u.activo) = 1)""",
    "calendar": """
  SELECT row_number() OVER (ORDER BY r.fecha, h.feriado, bs, cop) AS sk_fecha, r.fecha,
    CAST(quarter(r.fecha) AS INTEGER) AS trimestre, CAST(isodow(r.fecha) AS INTEGER) AS dia_semana,
    isodow(r.fecha) > 5 AS es_fin_de_semana, h.feriado IS NOT NULL AS es_feriado,
    h.feriado AS nombre_feriado, bs AS tasa_bs_usd, cop AS cop_por_usd, bs / cop AS tasa_bs_cop
  FROM raw_rates r LEFT JOIN raw_holidays h USING (fecha)""",
    "suppliers": """
  SELECT row_number() OVER (ORDER BY documento, nombre, ciudad, pais) AS sk_proveedor, *
  FROM (SELECT trim(documento) AS documento, trim(nombre) AS nombre,
      trim(split_part(direccion, ',', -2)) AS ciudad,
      CASE WHEN starts_with(documento, 'NIT') THEN 'CO' ELSE 'VE' END AS pais
    FROM raw_suppliers s
    QUALIFY row_number() OVER (PARTITION BY s.documento ORDER BY s.fecha_registro, s.nombre, s.direccion) = 1)""",
    "currencies": """
  SELECT row_number() OVER (ORDER BY codigo) AS sk_moneda, codigo
  FROM (SELECT moneda AS codigo FROM raw_invoices GROUP BY moneda)""",
    "hours": """
  SELECT row_number() OVER (ORDER BY hora DESC) AS sk_hora, hora,
    CASE WHEN hora = 12 THEN 'mediodia' WHEN hora > 12 THEN 'tarde' ELSE 'manana' END AS franja
  FROM (SELECT CAST(hour(fecha_hora) AS INTEGER) AS hora FROM raw_moves
    UNION SELECT CAST(hour(fecha_hora) AS INTEGER) FROM raw_invoices)""",
    "products": f"""
  SELECT row_number() OVER (ORDER BY codigo, descripcion, marca, nro_original, costo_usd, precio_venta_usd)
      AS sk_producto, *
  FROM (SELECT coalesce(nullif(trim(codigo), ''), 'SIN-CODIGO') AS codigo,
      nullif(trim(nro_original), '') AS nro_original, trim(descripcion) AS descripcion,
      nullif(trim(marca), '') AS marca, upper(split_part(trim(descripcion), ' ', 1)) AS categoria,
      {money("costo", 12)} AS costo_usd, {money("precio", 12)} AS precio_venta_usd
    FROM raw_products p WHERE p.descripcion IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY coalesce(nullif(trim(p.codigo), ''), trim(p.descripcion))
      ORDER BY p.descripcion, p.codigo, p.nro_original, p.marca, p.costo, p.precio) = 1)""",
    "movement_types": """
  SELECT row_number() OVER (ORDER BY codigo, motivo) AS sk_tipo_movimiento, codigo,
    CASE WHEN codigo = 'import_inicial' THEN 'Carga inicial'
      ELSE array_to_string(list_transform(string_split(replace(codigo, '_', ' '), ' '),
        lambda w: upper(w[1]) || lower(w[2:])), ' ') END AS nombre,
    motivo, CASE WHEN inbound THEN 'ENTRADA' ELSE 'SALIDA' END AS efecto_stock,
    CAST(CASE WHEN inbound THEN 1 ELSE -1 END AS SMALLINT) AS signo_stock
  FROM (SELECT DISTINCT tipo AS codigo, coalesce(nullif(trim(motivo), ''), 'SIN MOTIVO') AS motivo,
      tipo IN ('entrada', 'import_inicial') AS inbound FROM raw_moves WHERE tipo IS NOT NULL)""",
    # Lines of the facts with everything the marts look at.
    "sales": f"""
  SELECT c.sk_fecha, h.sk_hora, p.sk_producto, cu.sk_cliente, u.sk_usuario AS sk_empleado, m.sk_moneda,
    l.numero AS nro_factura, {whole("l.cantidad")} AS cantidad,
    {money(f"l.precio / {UNITS}")} AS precio_unit_usd, {money(f"l.subtotal / {UNITS}")} AS subtotal_usd,
    l.precio / {UNITS} AS precio_origen, l.subtotal / {UNITS} AS subtotal_origen,
    c.fecha, c.dia_semana, c.es_fin_de_semana, c.es_feriado, c.nombre_feriado,
    i.moneda, cu.tipo, p.costo_usd, p.precio_venta_usd, p.codigo, p.descripcion, p.marca, p.categoria
  FROM raw_invoice_lines l
  JOIN raw_invoices i ON i.numero = l.numero
  JOIN calendar c ON c.fecha = CAST(i.fecha_hora AS DATE)
  JOIN hours h ON h.hora = hour(i.fecha_hora)
  JOIN currencies m ON m.codigo = i.moneda
  JOIN products p ON p.codigo = l.producto
  LEFT JOIN customers cu ON cu.documento = substr(i.cliente, 3)
  LEFT JOIN users u ON u.username = i.usuario""",
    "purchases": f"""
  SELECT l.numero, c.sk_fecha, p.sk_producto, s.sk_proveedor, {whole("l.cantidad")} AS cantidad,
    {money("l.costo")} AS cost_unt_usd, {money("l.subtotal")} AS subtotal_usd
  FROM raw_purchase_lines l
  JOIN raw_purchases h ON h.numero = l.numero
  JOIN suppliers s ON s.documento = h.proveedor
  JOIN products p ON p.codigo = l.producto
  JOIN calendar c ON c.fecha = CAST(h.fecha_hora AS DATE)""",
    "moves": f"""
  SELECT v.fecha_hora, c.fecha, c.sk_fecha, h.sk_hora, p.sk_producto, t.sk_tipo_movimiento,
    CASE t.signo_stock WHEN 1 THEN abs({whole("v.cantidad")}) ELSE 0 END AS cantidad_entrada,
    CASE t.signo_stock WHEN -1 THEN abs({whole("v.cantidad")}) ELSE 0 END AS cantidad_salida,
    {whole(f"t.signo_stock * abs({whole('v.cantidad')})")} AS cantidad_neta,
    {whole("v.stock")} AS stock_resultante
  FROM raw_moves v
  JOIN products p ON p.codigo = v.producto
  JOIN calendar c ON c.fecha = CAST(v.fecha_hora AS DATE)
  JOIN hours h ON h.hora = hour(v.fecha_hora)
  JOIN movement_types t ON t.codigo = v.tipo
    AND t.motivo = coalesce(nullif(trim(v.motivo), ''), 'SIN MOTIVO')""",
    # Marts that other results read.
    "product_sales": f"""
  SELECT codigo, descripcion, marca, categoria, {bigint("SUM(cantidad)")} AS unidades_vendidas,
    {total("subtotal_usd")} AS monto_vendido_usd, COUNT(DISTINCT nro_factura) AS nro_facturas,
    {fixed("SUM(CAST(CAST(subtotal_usd AS DOUBLE) / nullif(cantidad, 0) AS DECIMAL(24,10))) / COUNT(nullif(cantidad, 0))")}
      AS precio_prom_usd
  FROM sales GROUP BY ALL""",
    "top": """
  SELECT *, ranking_por_cantidad <= 10 AS top10_por_cantidad, ranking_por_monto <= 10 AS top10_por_monto
  FROM (SELECT rank() OVER (ORDER BY unidades_vendidas DESC) AS ranking_por_cantidad,
      rank() OVER (ORDER BY monto_vendido_usd DESC) AS ranking_por_monto, * FROM product_sales)
  WHERE least(ranking_por_cantidad, ranking_por_monto) <= 10""",
    "margin_sums": " UNION ALL ".join(
        f"""
  SELECT '{level}' AS nivel, {columns}, max(descripcion) AS descripcion, {bigint("SUM(cantidad)")} AS units,
    {total("subtotal_usd")} AS revenue, {total("cantidad * costo_usd")} AS cost
  FROM sales GROUP BY {keys}"""
        for level, columns, keys in (
            ("PRODUCTO", "categoria, marca, codigo", "categoria, marca, codigo"),
            ("MARCA", "NULL AS categoria, marca, NULL AS codigo", "marca"),
            ("CATEGORIA", "categoria, NULL AS marca, NULL AS codigo", "categoria"),
        )
    ),
    "margins": f"""
  SELECT nivel, categoria, marca, codigo, descripcion, units AS unidades_vendidas,
    revenue AS ingreso_usd, cost AS costo_mercancia_usd,
    CAST(revenue - cost AS DECIMAL(24,2)) AS margen_usd,
    {percent("revenue - cost", "revenue")} AS margen_pct_sobre_ingreso,
    {percent("revenue - cost", "cost")} AS markup_pct_sobre_costo
  FROM margin_sums""",
    "stock_rows": f"""
  SELECT p.codigo, p.descripcion, p.marca, p.categoria, CAST(NULL AS VARCHAR) AS ubicacion,
    p.costo_usd, p.precio_venta_usd, coalesce(v.stock, 0) AS stock_actual,
    CAST(coalesce(v.stock, 0) * p.costo_usd AS DECIMAL(24,2)) AS capital_inmovilizado_usd,
    v.last_move AS fecha_ultimo_movimiento, s.last_sale AS fecha_ultima_venta,
    coalesce(s.units, 0) AS unidades_vendidas_hist,
    (SELECT max(fecha) FROM sales) AS fecha_corte,
    {whole("date_diff('day', coalesce(s.last_sale, v.first_move), (SELECT max(fecha) FROM sales))")}
      AS dias_sin_vender
  FROM products p
  LEFT JOIN (SELECT sk_producto, max(fecha) AS last_sale, {bigint("SUM(cantidad)")} AS units
    FROM sales GROUP BY 1) s ON s.sk_producto = p.sk_producto
  LEFT JOIN (SELECT sk_producto, min(fecha) AS first_move, max(fecha) AS last_move,
      (max(ROW(fecha_hora, stock_resultante)))[2] AS stock
    FROM moves GROUP BY 1) v ON v.sk_producto = p.sk_producto""",
    "stock": """
  SELECT *, CASE WHEN fecha_ultima_venta IS NULL THEN 'NUNCA VENDIDO'
      WHEN dias_sin_vender < 30 THEN 'ACTIVO' WHEN dias_sin_vender < 90 THEN 'ATENCIÓN (30-89 días)'
      WHEN dias_sin_vender < 180 THEN 'LENTA ROTACIÓN (90-179 días)'
      ELSE 'INVENTARIO MUERTO (180+ días)' END AS clasificacion,
    fecha_ultima_venta IS NULL OR dias_sin_vender >= 180 AS es_inventario_muerto
  FROM stock_rows""",
    "evolution_sums": " UNION ALL ".join(
        f"""
  SELECT '{tag}' AS granularidad, strftime(fecha, '{pattern}') AS periodo,
    CAST(min(date_trunc('{unit}', fecha)) AS DATE) AS periodo_inicio,
    COUNT(DISTINCT nro_factura) AS nro_facturas, COUNT(DISTINCT fecha) AS dias_con_ventas,
    {bigint("SUM(cantidad)")} AS unidades_vendidas, {total("subtotal_usd")} AS ingreso_usd,
    {total("subtotal_usd - cantidad * costo_usd")} AS margen_usd
  FROM sales GROUP BY 2"""
        for tag, unit, pattern in (
            ("DIA", "day", "%Y-%m-%d"),
            ("SEMANA", "week", "%G-S%V"),
            ("MES", "month", "%Y-%m"),
            ("ANIO", "year", "%Y"),
        )
    ),
    "evolution": f"""
  SELECT *, {ratio("ingreso_usd", "nro_facturas")} AS ticket_promedio_usd,
    before AS ingreso_usd_periodo_anterior,
    {percent("ingreso_usd - before", "before")} AS variacion_pct_vs_periodo_anterior
  FROM (SELECT *, lag(ingreso_usd) OVER w AS before,
      CAST(SUM(ingreso_usd) OVER (w ROWS UNBOUNDED PRECEDING) AS DECIMAL(24,2)) AS ingreso_acumulado_usd
    FROM evolution_sums WINDOW w AS (PARTITION BY granularidad ORDER BY periodo_inicio))""",
    "weekdays": f"""
  SELECT dia_semana,
    ['Lunes', 'Martes', 'Miércoles', 'Jueves', 'Viernes', 'Sábado', 'Domingo'][dia_semana] AS nombre_dia,
    weekend AS es_fin_de_semana, days AS dias_con_ventas, invoices AS nro_facturas,
    units AS unidades_vendidas, revenue AS ingreso_usd,
    {ratio("revenue", "days")} AS ingreso_prom_por_dia_usd,
    {ratio("revenue", "invoices")} AS ticket_promedio_usd,
    {percent("revenue", "SUM(revenue) OVER ()")} AS pct_del_ingreso_total,
    rank() OVER (ORDER BY revenue DESC) AS ranking_ingreso_total,
    rank() OVER (ORDER BY CAST(revenue AS DOUBLE) / days DESC) AS ranking_ingreso_promedio
  FROM (SELECT dia_semana, bool_or(es_fin_de_semana) AS weekend, COUNT(DISTINCT fecha) AS days,
      COUNT(DISTINCT nro_factura) AS invoices, {bigint("SUM(cantidad)")} AS units,
      {total("subtotal_usd")} AS revenue FROM sales GROUP BY 1)""",
    "day_types": f"""
  SELECT tipo_dia, days AS dias_con_ventas, invoices AS nro_facturas, units AS unidades_vendidas,
    revenue AS ingreso_usd, {ratio("revenue", "days")} AS ingreso_prom_por_dia_usd,
    {ratio("revenue", "invoices")} AS ticket_promedio_usd,
    {percent("revenue", "SUM(revenue) OVER ()")} AS pct_del_ingreso_total
  FROM (SELECT CASE WHEN es_feriado THEN 'FERIADO' WHEN es_fin_de_semana THEN 'FIN DE SEMANA'
        ELSE 'DIA LABORABLE' END AS tipo_dia, COUNT(DISTINCT fecha) AS days,
      COUNT(DISTINCT nro_factura) AS invoices, {bigint("SUM(cantidad)")} AS units,
      {total("subtotal_usd")} AS revenue FROM sales GROUP BY 1)""",
    "tickets": f"""
  SELECT codigo_tipo, CASE codigo_tipo WHEN 'J' THEN 'Taller / Empresa (jurídico)'
      WHEN 'V' THEN 'Particular (venezolano)' WHEN 'E' THEN 'Extranjero'
      ELSE 'Sin cliente identificado' END AS tipo_cliente,
    COUNT(DISTINCT nro_factura) AS nro_facturas, {total("amount")} AS ingreso_total_usd,
    {bigint("SUM(units)")} AS unidades_vendidas, {ratio("SUM(amount)", "COUNT(*)")} AS ticket_promedio_usd,
    {fixed("quantile_cont(CAST(amount AS DOUBLE), 0.5)")} AS ticket_mediano_usd,
    min(amount) AS ticket_minimo_usd, max(amount) AS ticket_maximo_usd,
    {ratio("SUM(n)", "COUNT(*)")} AS lineas_promedio_por_factura,
    {ratio("SUM(units)", "COUNT(*)")} AS unidades_promedio_por_factura,
    {percent("SUM(amount)", "SUM(SUM(amount)) OVER ()")} AS pct_del_ingreso_total
  FROM (SELECT nro_factura, coalesce(tipo, 'SD') AS codigo_tipo, COUNT(*) AS n, SUM(cantidad) AS units,
      {total("subtotal_usd")} AS amount FROM sales GROUP BY 1, 2)
  GROUP BY 1, 2""",
    "mix": f"""
  SELECT moneda, CASE moneda WHEN 'BS' THEN 'Bolívares' WHEN 'USD' THEN 'Dólares'
      WHEN 'COP' THEN 'Pesos colombianos' ELSE moneda END AS moneda_nombre,
    invoices AS nro_facturas, units AS unidades_vendidas, revenue AS ingreso_usd,
    {ratio("revenue", "invoices")} AS ticket_promedio_usd,
    {percent("revenue", "SUM(revenue) OVER ()")} AS pct_por_monto,
    {percent("invoices", "SUM(invoices) OVER ()")} AS pct_por_nro_facturas,
    {percent("units", "SUM(units) OVER ()")} AS pct_por_unidades
  FROM (SELECT moneda, COUNT(DISTINCT nro_factura) AS invoices, {bigint("SUM(cantidad)")} AS units,
      {total("subtotal_usd")} AS revenue FROM sales GROUP BY 1)""",
    "mix_monthly": f"""
  SELECT strftime(mes_inicio, '%Y-%m') AS mes, mes_inicio, moneda, nro_facturas, ingreso_usd,
    {percent("ingreso_usd", "SUM(ingreso_usd) OVER (PARTITION BY mes_inicio)")} AS pct_del_mes
  FROM (SELECT CAST(date_trunc('month', fecha) AS DATE) AS mes_inicio, moneda,
      COUNT(DISTINCT nro_factura) AS nro_facturas, {total("subtotal_usd")} AS ingreso_usd
    FROM sales GROUP BY 1, 2)""",
    "fx_sums": f"""
  SELECT strftime(mes_inicio, '%Y-%m') AS mes, *, CAST(ingreso_usd - costo_usd AS DECIMAL(24,2)) AS margen_usd,
    {percent("ingreso_usd - costo_usd", "ingreso_usd")} AS margen_pct,
    {percent("exposed", "ingreso_usd")} AS pct_ingreso_expuesto_a_fx
  FROM (SELECT CAST(date_trunc('month', fecha) AS DATE) AS mes_inicio,
      COUNT(DISTINCT nro_factura) AS nro_facturas, {bigint("SUM(cantidad)")} AS unidades_vendidas,
      {total("subtotal_usd")} AS ingreso_usd, {total("cantidad * costo_usd")} AS costo_usd,
      {total("CASE moneda WHEN 'BS' THEN subtotal_usd END")} AS ingreso_usd_cobrado_en_bs,
      {total("CASE moneda WHEN 'USD' THEN subtotal_usd END")} AS ingreso_usd_cobrado_en_usd,
      {total("CASE moneda WHEN 'COP' THEN subtotal_usd END")} AS ingreso_usd_cobrado_en_cop,
      {total("CASE moneda WHEN 'USD' THEN 0 ELSE subtotal_usd END")} AS exposed
    FROM sales GROUP BY 1)
  JOIN (SELECT CAST(date_trunc('month', fecha) AS DATE) AS mes_inicio,
      {fixed("AVG(tasa_bs_usd)", 4)} AS tasa_bs_usd_prom, {fixed("MIN(tasa_bs_usd)", 4)} AS tasa_bs_usd_min,
      {fixed("MAX(tasa_bs_usd)", 4)} AS tasa_bs_usd_max, {fixed("AVG(cop_por_usd)", 4)} AS cop_por_usd_prom
    FROM calendar GROUP BY 1) USING (mes_inicio)""",
    "fx": "SELECT * EXCLUDE (exposed), "
    + ", ".join(
        f"{percent(f'{c} - lag({c}) OVER w', f'lag({c}) OVER w')} AS {name}"
        for c, name in (
            ("tasa_bs_usd_prom", "var_pct_tasa_bs_usd"),
            ("cop_por_usd_prom", "var_pct_tasa_cop_usd"),
            ("ingreso_usd", "var_pct_ingreso_usd"),
            ("margen_usd", "var_pct_margen_usd"),
        )
    )
    + f""",
    CAST(margen_pct - lag(margen_pct) OVER w AS DECIMAL(18,2)) AS delta_puntos_margen_pct,
    {percent("tasa_bs_usd_max - tasa_bs_usd_min", "tasa_bs_usd_min")} AS amplitud_pct_tasa_bs_en_el_mes
  FROM fx_sums WINDOW w AS (ORDER BY mes_inicio)""",
}


def with_ctes(sql: str) -> str:
    """Prefix the query with the expressions it needs, directly or not."""
    needed: set[str] = set()
    pending = [sql]
    while pending:
        text = pending.pop()
        for name in CTES:
            if name not in needed and re.search(rf"\b(FROM|JOIN) {name}\b", text):
                needed.add(name)
                pending.append(CTES[name])
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in CTES if n in needed) + "\n" + sql


def fact(table: str, key: str, first: str, columns: list[str]) -> str:
    order = ", ".join([first, *[c for c in columns if c != first]])
    return f"SELECT row_number() OVER (ORDER BY {order}) AS {key}, {', '.join(columns)} FROM {table}"


def largest(sql: str, order: str, n: int) -> str:
    return f"{sql} ORDER BY {order} LIMIT {n}"


PRODUCT_MARGINS = """SELECT codigo, descripcion, marca, unidades_vendidas, ingreso_usd, margen_usd,
  margen_pct_sobre_ingreso FROM margins WHERE nivel = 'PRODUCTO'"""
TOP_LIST = """SELECT {rank} AS rk, codigo, descripcion, marca, unidades_vendidas, monto_vendido_usd,
  nro_facturas FROM top WHERE {rank} <= 10"""
PERIOD = """SELECT periodo, {extra} nro_facturas, unidades_vendidas, ingreso_usd, margen_usd,
  ticket_promedio_usd, variacion_pct_vs_periodo_anterior FROM evolution WHERE granularidad = '{tag}'"""
PIVOT = """SELECT mes_inicio, coalesce(max(CASE moneda WHEN 'BS' THEN pct_del_mes END), 0) AS bs,
  coalesce(max(CASE moneda WHEN 'USD' THEN pct_del_mes END), 0) AS usd,
  coalesce(max(CASE moneda WHEN 'COP' THEN pct_del_mes END), 0) AS cop FROM mix_monthly GROUP BY 1"""


def quality_sql() -> str:
    tables = {
        "dim_clientes": "customers",
        "dim_usuarios": "users",
        "dim_tiempo": "calendar",
        "dim_proveedor": "suppliers",
        "dim_moneda": "currencies",
        "dim_hora": "hours",
        "dim_producto": "products",
        "dim_tipo_movimiento": "movement_types",
        "purchase_lines": "purchases",
        "sale_lines": "sales",
        "movement_lines": "moves",
    }
    rows = []

    def rule(table: str, column: str, name: str, source: str) -> None:
        rows.append(
            f"SELECT '{table}' AS tabla, '{column}' AS columna, '{name}' AS regla, COUNT(*) AS filas FROM {source}"
        )

    for table, columns in quality.NOT_NULL.items():
        shown = quality.FACT_NAMES.get(table, table)
        for c in columns:
            rule(shown, c, "no_nulo", f"{tables[table]} WHERE {c} IS NULL")
        for c, allowed in quality.DOMAINS.get(table, {}).items():
            rule(shown, c, "dominio", f"{tables[table]} WHERE {c} NOT IN {tuple(allowed)}")
        for c, n in quality.MAX_LENGTH.get(table, {}).items():
            rule(shown, c, "longitud", f"{tables[table]} WHERE length({c}) > {n}")
    repeated = "(SELECT {keys} FROM {source} GROUP BY {keys} HAVING COUNT(*) > 1)"
    for table, columns in quality.UNIQUE.items():
        keys = ", ".join(columns)
        rule(table, keys, "unico", repeated.format(keys=keys, source=tables[table]))
    for table, column in quality.NATURAL_KEYS.items():
        rule(table, column, "clave_repetida", repeated.format(keys=column, source=tables[table]))
    # Numbers of n digits before the point, or whole numbers of 32 bits.
    for table, column, source, value, limit in (
        ("fact_ventas", "precio_unit_usd", "sales", "precio_origen", "999999999999.995"),
        ("fact_ventas", "subtotal_usd", "sales", "subtotal_origen", "999999999999.995"),
        ("stg_productos", "costo_usd", "raw_products", "costo", "9999999999.995"),
        ("stg_productos", "precio_venta_usd", "raw_products", "precio", "9999999999.995"),
        ("stg_ventas_detalle", "cantidad", "raw_invoice_lines", "cantidad", "2147483647.5"),
        ("stg_compras_detalle", "cantidad", "raw_purchase_lines", "cantidad", "2147483647.5"),
        ("stg_compras_detalle", "costo_unitario_usd", "raw_purchase_lines", "costo", "999999999999.995"),
        ("stg_compras_detalle", "subtotal_usd", "raw_purchase_lines", "subtotal", "999999999999.995"),
        ("stg_movimientos_inventario", "cantidad", "raw_moves", "cantidad", "2147483647.5"),
        ("stg_movimientos_inventario", "stock_nuevo", "raw_moves", "stock", "2147483647.5"),
    ):
        rule(table, column, "precision", f"{source} WHERE abs({value}) >= {limit}")
    day = "CAST(r.fecha_hora AS DATE)"
    for table, column, source, key, parents, parent_key, given in (
        ("stg_ventas_detalle", "numero", "raw_invoice_lines", "r.numero", "raw_invoices", "numero", ""),
        ("stg_ventas_detalle", "product_codigo", "raw_invoice_lines", "r.producto", "products", "codigo", ""),
        ("stg_ventas_header", "fecha_hora", "raw_invoices", day, "calendar", "fecha", ""),
        ("stg_ventas_header", "cliente_documento", "raw_invoices", "substr(r.cliente, 3)", "customers", "documento", "r.cliente IS NOT NULL AND"),
        ("stg_ventas_header", "usuario", "raw_invoices", "r.usuario", "users", "username", "r.usuario IS NOT NULL AND"),
        ("stg_compras_detalle", "numero", "raw_purchase_lines", "r.numero", "raw_purchases", "numero", ""),
        ("stg_compras_detalle", "product_codigo", "raw_purchase_lines", "r.producto", "products", "codigo", ""),
        ("stg_compras_header", "proveedor_documento", "raw_purchases", "r.proveedor", "suppliers", "documento", ""),
        ("stg_compras_header", "fecha_hora", "raw_purchases", day, "calendar", "fecha", ""),
        ("stg_movimientos_inventario", "product_codigo", "raw_moves", "r.producto", "products", "codigo", ""),
        ("stg_movimientos_inventario", "fecha_hora", "raw_moves", day, "calendar", "fecha", ""),
        ("stg_movimientos_inventario", "tipo, motivo", "raw_moves",
         "r.tipo || '/' || coalesce(nullif(trim(r.motivo), ''), 'SIN MOTIVO')",
         "movement_types", "codigo || '/' || p.motivo", ""),
    ):
        rule(
            table,
            column,
            "sin_referencia",
            f"{source} r WHERE {given} NOT EXISTS (SELECT 1 FROM {parents} p WHERE p.{parent_key} = {key})",
        )
    return "\nUNION ALL ".join(rows)


ORACLE: dict[str, str] = {
    # Staging operators over the raw tables.
    "stg_normalized_columns": "SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_orderstatus AS status, o_totalprice AS total_price FROM orders",
    "stg_drop_empty_rows": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus <> 'P'",
    "stg_audit_columns": "SELECT o_orderkey, 'orders.parquet' AS etl_source_file, TRUE AS stamped FROM orders",
    "stg_safe_casts": """SELECT l_orderkey, l_linenumber, l_partkey,
        CASE WHEN l_returnflag <> 'N' AND (l_returnflag <> 'R' OR l_linenumber NOT IN (1, 2, 3))
          THEN CAST(l_linenumber AS DOUBLE) * CASE WHEN l_returnflag = 'R' AND l_linenumber = 4 THEN 100 ELSE 1 END END AS numero,
        CAST(TRY_CAST(CASE l_returnflag WHEN 'A' THEN strftime(l_shipdate, '%d/%m/%Y') ELSE strftime(l_shipdate, '%Y-%m-%d') END AS TIMESTAMP) AS DATE) AS dia
        FROM lineitem""",
    "stg_null_tokens": "SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segmento FROM customer",
    # Dimensions and facts.
    "dim_customer": "SELECT * FROM customers",
    "dim_user": "SELECT * FROM users",
    "dim_date": "SELECT * FROM calendar",
    "dim_supplier": "SELECT * FROM suppliers",
    "dim_currency": "SELECT * FROM currencies",
    "dim_hour": "SELECT * FROM hours",
    "dim_product": "SELECT *, CAST(NULL AS VARCHAR) AS ubicacion, 0 AS stock_minimo FROM products",
    "dim_movement_type": "SELECT * FROM movement_types",
    "fact_purchases": fact("purchases", "sk_compra", "numero", ["sk_fecha", "sk_producto", "sk_proveedor", "cantidad", "cost_unt_usd", "subtotal_usd"]),
    "fact_sales": fact("sales", "sk_venta", "nro_factura", ["sk_fecha", "sk_hora", "sk_producto", "sk_cliente", "sk_empleado", "sk_moneda", "nro_factura", "cantidad", "precio_unit_usd", "subtotal_usd"]),
    "fact_inventory_moves": fact("moves", "sk_movimiento", "fecha_hora", ["sk_fecha", "sk_hora", "sk_producto", "sk_tipo_movimiento", "cantidad_entrada", "cantidad_salida", "cantidad_neta", "stock_resultante"]),
    "assign_keys": """SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice) AS sk_linea,
        l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice FROM lineitem""",
    "quality_checks": quality_sql(),
    # Marts.
    "top_products": "SELECT * FROM top",
    "margin_by_level": "SELECT * FROM margins",
    "dead_stock": "SELECT * FROM stock",
    "dead_stock_summary": f"""SELECT clasificacion, COUNT(*) AS nro_productos, {bigint("SUM(stock_actual)")} AS unidades_en_stock,
        {total("capital_inmovilizado_usd")} AS capital_inmovilizado_usd,
        {percent("SUM(capital_inmovilizado_usd)", "SUM(SUM(capital_inmovilizado_usd)) OVER ()")} AS pct_del_capital_total,
        {ratio("SUM(dias_sin_vender)", "COUNT(dias_sin_vender)", 1)} AS dias_sin_vender_prom FROM stock GROUP BY 1""",
    "sales_evolution": "SELECT * EXCLUDE (before) FROM evolution",
    "sales_by_weekday": "SELECT * FROM weekdays",
    "sales_by_day_type": "SELECT * FROM day_types",
    "sales_by_holiday": f"""SELECT nombre_feriado, COUNT(DISTINCT fecha) AS dias_con_ventas, min(fecha) AS primera_fecha,
        max(fecha) AS ultima_fecha, COUNT(DISTINCT nro_factura) AS nro_facturas, {bigint("SUM(cantidad)")} AS unidades_vendidas,
        {total("subtotal_usd")} AS ingreso_usd, {ratio("SUM(subtotal_usd)", "COUNT(DISTINCT fecha)")} AS ingreso_prom_por_dia_usd
        FROM sales WHERE es_feriado GROUP BY 1""",
    "ticket_by_customer_type": "SELECT * FROM tickets",
    "currency_mix": "SELECT * FROM mix",
    "currency_mix_monthly": "SELECT * FROM mix_monthly",
    "fx_monthly": "SELECT * FROM fx",
    "fx_correlation": "SELECT COUNT(var_pct_tasa_bs_usd) AS meses_comparables, "
    + ", ".join(
        f"{fixed(f'corr(CAST(var_pct_tasa_bs_usd AS DOUBLE), CAST({c} AS DOUBLE))', 4)} AS {name}"
        for c, name in (
            ("var_pct_ingreso_usd", "corr_devaluacion_vs_var_ingreso"),
            ("var_pct_margen_usd", "corr_devaluacion_vs_var_margen"),
            ("delta_puntos_margen_pct", "corr_devaluacion_vs_delta_margen_pct"),
            ("pct_ingreso_expuesto_a_fx", "corr_devaluacion_vs_exposicion_fx"),
        )
    )
    + " FROM fx",
    "margin_by_currency": f"""SELECT moneda, COUNT(DISTINCT nro_factura) AS nro_facturas, {bigint("SUM(cantidad)")} AS unidades_vendidas,
        {total("subtotal_usd")} AS ingreso_usd, {total("cantidad * costo_usd")} AS costo_usd,
        {total("subtotal_usd - cantidad * costo_usd")} AS margen_usd,
        {percent("SUM(subtotal_usd - cantidad * costo_usd)", "SUM(subtotal_usd)")} AS margen_pct,
        {percent("SUM(subtotal_usd - cantidad * precio_venta_usd)", "SUM(cantidad * precio_venta_usd)")} AS desvio_pct_vs_precio_lista_usd
        FROM sales GROUP BY 1""",
    # Report sets.
    "sales_totals": f"""SELECT COUNT(*) AS lineas, COUNT(DISTINCT nro_factura) AS facturas, {bigint("SUM(cantidad)")} AS unidades,
        {total("subtotal_usd")} AS ingreso_usd, min(fecha) AS desde, max(fecha) AS hasta FROM sales""",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS tabla, COUNT(*) AS filas FROM {cte}"
        for name, cte in (
            ("dim_producto", "products"),
            ("dim_clientes", "customers"),
            ("dim_proveedor", "suppliers"),
            ("dim_usuarios", "users"),
            ("dim_tiempo", "calendar"),
            ("fact_ventas", "sales"),
            ("fact_compras", "purchases"),
            ("fact_mov_inventario", "moves"),
        )
    ),
    "global_margin": f"""SELECT {total("subtotal_usd")} AS ingreso, {total("cantidad * costo_usd")} AS costo,
        {total("subtotal_usd - cantidad * costo_usd")} AS margen,
        {percent("SUM(subtotal_usd - cantidad * costo_usd)", "SUM(subtotal_usd)")} AS margen_pct FROM sales""",
    "top_by_units": TOP_LIST.format(rank="ranking_por_cantidad"),
    "top_by_revenue": TOP_LIST.format(rank="ranking_por_monto"),
    "top_overlap": """SELECT count_if(top10_por_cantidad AND top10_por_monto)::BIGINT AS en_ambos,
        count_if(top10_por_cantidad AND NOT top10_por_monto)::BIGINT AS solo_cantidad,
        count_if(top10_por_monto AND NOT top10_por_cantidad)::BIGINT AS solo_monto FROM top""",
    "rank_gaps": largest("""SELECT codigo, descripcion, unidades_vendidas, monto_vendido_usd, ranking_por_cantidad,
        ranking_por_monto, abs(ranking_por_cantidad - ranking_por_monto) AS brecha FROM top""", "brecha DESC, codigo, descripcion", 6),
    "margin_top_categories": largest("""SELECT categoria, unidades_vendidas, ingreso_usd, costo_mercancia_usd, margen_usd,
        margen_pct_sobre_ingreso FROM margins WHERE nivel = 'CATEGORIA'""", "margen_usd DESC, categoria", 12),
    "margin_top_brands": largest("""SELECT marca, unidades_vendidas, ingreso_usd, margen_usd, margen_pct_sobre_ingreso
        FROM margins WHERE nivel = 'MARCA'""", "margen_usd DESC, marca", 12),
    "margin_top_products": largest(PRODUCT_MARGINS, "margen_usd DESC, codigo, descripcion, marca", 10),
    "margin_losses": largest(f"{PRODUCT_MARGINS} AND margen_usd < 0", "margen_usd, codigo, descripcion, marca", 10),
    "margin_stats": f"""SELECT COUNT(*) AS productos, count_if(margen_usd < 0)::BIGINT AS con_perdida,
        count_if(margen_pct_sobre_ingreso BETWEEN 22.5 AND 23.5)::BIGINT AS en_banda,
        min(margen_pct_sobre_ingreso) AS pct_min, max(margen_pct_sobre_ingreso) AS pct_max,
        {ratio("SUM(margen_pct_sobre_ingreso)", "COUNT(margen_pct_sobre_ingreso)")} AS pct_prom,
        {fixed("stddev_pop(CAST(margen_pct_sobre_ingreso AS DOUBLE))")} AS pct_desv,
        {total("CASE WHEN margen_usd < 0 THEN margen_usd END")} AS perdida_usd FROM margins WHERE nivel = 'PRODUCTO'""",
    "margin_level_counts": "SELECT nivel, COUNT(*) AS filas FROM margins GROUP BY 1",
    "margin_band_share": f"""SELECT n AS en_banda, m AS productos, m - n AS fuera_de_banda, {percent("n", "m", 1)} AS pct_en_banda
        FROM (SELECT count_if(margen_pct_sobre_ingreso BETWEEN 22.5 AND 23.5)::BIGINT AS n, COUNT(*) AS m
          FROM margins WHERE nivel = 'PRODUCTO')""",
    "dead_stock_top": largest("""SELECT codigo, descripcion, marca, stock_actual, costo_usd, capital_inmovilizado_usd, fecha_ultima_venta,
        dias_sin_vender, clasificacion FROM stock WHERE es_inventario_muerto AND capital_inmovilizado_usd > 0""",
        "capital_inmovilizado_usd DESC, codigo, descripcion", 15),
    "dead_stock_kpi": f"""SELECT count_if(es_inventario_muerto)::BIGINT AS productos_muertos,
        {total("CASE WHEN es_inventario_muerto THEN capital_inmovilizado_usd END")} AS capital_muerto,
        {total("capital_inmovilizado_usd")} AS capital_total, max(dias_sin_vender) AS dias_max, max(fecha_corte) AS fecha_corte FROM stock""",
    "dead_capital_share": f"""SELECT d AS capital_muerto, t AS capital_total, {percent("d", "t", 1)} AS pct_capital_muerto
        FROM (SELECT {total("CASE WHEN es_inventario_muerto THEN capital_inmovilizado_usd END")} AS d,
          {total("capital_inmovilizado_usd")} AS t FROM stock)""",
    "evolution_yearly": PERIOD.format(extra="", tag="ANIO"),
    "evolution_monthly": PERIOD.format(extra="periodo_inicio,", tag="MES"),
    "evolution_stats": f"""SELECT granularidad, COUNT(*) AS periodos, {ratio("SUM(ingreso_usd)", "COUNT(*)")} AS promedio,
        min(ingreso_usd) AS minimo, max(ingreso_usd) AS maximo FROM evolution GROUP BY 1""",
    "first_last_half_year": f"""SELECT {ratio("SUM(ingreso_usd) FILTER (a <= 6)", "COUNT(*) FILTER (a <= 6)")} AS promedio_primer_semestre,
        {ratio("SUM(ingreso_usd) FILTER (b <= 6)", "COUNT(*) FILTER (b <= 6)")} AS promedio_ultimo_semestre
        FROM (SELECT ingreso_usd, row_number() OVER (ORDER BY periodo_inicio) AS a,
          row_number() OVER (ORDER BY periodo_inicio DESC) AS b FROM evolution WHERE granularidad = 'MES')""",
    "best_worst_month": f"""SELECT first(periodo ORDER BY ingreso_usd DESC, periodo) AS mejor_mes, max(ingreso_usd) AS mejor_ingreso_usd,
        first(periodo ORDER BY ingreso_usd, periodo) AS peor_mes, min(ingreso_usd) AS peor_ingreso_usd,
        {ratio("SUM(ingreso_usd)", "COUNT(*)")} AS promedio_usd FROM evolution WHERE granularidad = 'MES'""",
    "weekday_uplift": f"""SELECT *, {percent("mejor_prom_usd - peor_prom_usd", "peor_prom_usd")} AS ventaja_pct
        FROM (SELECT first(nombre_dia ORDER BY ingreso_prom_por_dia_usd DESC, dia_semana) AS mejor_dia,
          max(ingreso_prom_por_dia_usd) AS mejor_prom_usd,
          first(nombre_dia ORDER BY ingreso_prom_por_dia_usd, dia_semana) AS peor_dia,
          min(ingreso_prom_por_dia_usd) AS peor_prom_usd FROM weekdays)""",
    "holiday_vs_workday": f"""SELECT *, {percent("feriado_usd - laborable_usd", "laborable_usd")} AS diferencia_pct
        FROM (SELECT max(ingreso_prom_por_dia_usd) FILTER (tipo_dia = 'FERIADO') AS feriado_usd,
          max(ingreso_prom_por_dia_usd) FILTER (tipo_dia = 'DIA LABORABLE') AS laborable_usd FROM day_types)""",
    "ticket_spread": f"""SELECT min(ticket_promedio_usd) AS ticket_min_usd, max(ticket_promedio_usd) AS ticket_max_usd,
        {fixed("median(CAST(ticket_mediano_usd AS DOUBLE))")} AS mediana_usd FROM tickets""",
    "currency_share_pivot": PIVOT,
    "currency_stack_offsets": f"""SELECT mes_inicio, CAST(0 AS DECIMAL(18,2)) AS base_bs, bs AS base_usd,
        CAST(bs + usd AS DECIMAL(18,2)) AS base_cop, CAST(bs + usd + cop AS DECIMAL(18,2)) AS tope FROM ({PIVOT})""",
    "devaluation_total": f"""SELECT a AS tasa_inicial, b AS tasa_final, {percent("b - a", "a")} AS devaluacion_pct
        FROM (SELECT arg_min(tasa_bs_usd_prom, mes_inicio) AS a, arg_max(tasa_bs_usd_prom, mes_inicio) AS b FROM fx)""",
    "fx_first_last": f"""SELECT arg_min(margen_pct, mes_inicio) AS margen_pct_inicial, arg_max(margen_pct, mes_inicio) AS margen_pct_final,
        {ratio("SUM(pct_ingreso_expuesto_a_fx)", "COUNT(pct_ingreso_expuesto_a_fx)")} AS exposicion_promedio_pct FROM fx""",
    "formatted_kpis": f"""
        SELECT UNNEST(['lineas', 'facturas', 'unidades', 'ingreso', 'margen']) AS kpi,
          UNNEST([format('{{:,}}', n), format('{{:,}}', i), format('{{:,}}', u), format('{{:,.0f}}', CAST(r AS DOUBLE)),
            format('{{:,.1f}}%', CAST(m AS DOUBLE))]) AS texto
        FROM (SELECT COUNT(*) AS n, COUNT(DISTINCT nro_factura) AS i, {bigint("SUM(cantidad)")} AS u, SUM(subtotal_usd) AS r,
          {percent("SUM(subtotal_usd - cantidad * costo_usd)", "SUM(subtotal_usd)")} AS m FROM sales)
        UNION ALL
        SELECT UNNEST(['capital_muerto', 'dias_max']), UNNEST([format('{{:,.2f}}', CAST(d AS DOUBLE)), format('{{:,}}', x)])
        FROM (SELECT SUM(capital_inmovilizado_usd) FILTER (es_inventario_muerto) AS d, max(dias_sin_vender) AS x FROM stock)""",
    "formatted_top_products": """SELECT format('{:,}', ranking_por_cantidad) AS puesto, codigo,
        CASE WHEN length(descripcion) > 12 THEN left(descripcion, 11) || '…' ELSE descripcion END AS descripcion,
        format('{:,}', unidades_vendidas) AS unidades, format('{:,.0f}', CAST(monto_vendido_usd AS DOUBLE)) AS monto
        FROM top WHERE top10_por_cantidad""",
    "formatted_currency_mix": """SELECT moneda_nombre || ' (' || moneda || ')' AS etiqueta,
        format('{:,.2f}', CAST(ingreso_usd AS DOUBLE)) AS ingreso, format('{:,.2f}%', CAST(pct_por_monto AS DOUBLE)) AS monto FROM mix""",
}


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(sql) for name, sql in ORACLE.items()}
