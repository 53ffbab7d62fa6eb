"""Every query equals its SQL twin, on the test tables and on small skewed ones."""

from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry
from checks import oracle_sql as twins
from checks.compare import TABLES, connect, difference
from tallyhouse.plans.report import DATASETS

SMALL = "/root/testdata/sf0.001"
NAMES = sorted(twins.oracle_sql())


def test_every_query_has_a_twin():
    assert set(entry.warehouse_queries()) == set(twins.oracle_sql())


def skewed_tables(folder, seed):
    """Tables in which one order, one part and one customer hold about half the rows."""
    rng = np.random.default_rng(seed)

    def hot(n, high):
        return np.where(rng.random(n) < 0.45, 1, rng.integers(0, high, n))

    def days(n):
        picked = rng.choice(pd.date_range("1998-04-25", "1998-09-05"), n)
        return pd.Series(picked).astype("datetime64[us]")

    n_lines, n_orders, n_parts, n_customers = 900, 130, 215, 64
    orders = pd.DataFrame(
        {
            "o_orderkey": np.arange(n_orders),
            "o_custkey": hot(n_orders, n_customers),
            "o_orderstatus": rng.choice(["O", "F", "P"], n_orders),
            "o_totalprice": rng.integers(1, 10**6, n_orders) / 100,
            "o_orderdate": days(n_orders),
            "o_orderpriority": "5-LOW",
        }
    )
    quantity = rng.integers(1, 51, n_lines).astype(float)
    lines = pd.DataFrame(
        {
            "l_orderkey": hot(n_lines, n_orders),
            "l_partkey": hot(n_lines, n_parts),
            "l_suppkey": hot(n_lines, 40),
            "l_linenumber": rng.integers(1, 8, n_lines).astype("int32"),
            "l_quantity": quantity,
            "l_extendedprice": rng.integers(100, 10**7, n_lines) / 100,
            "l_discount": 0.0,
            "l_tax": 0.0,
            "l_returnflag": rng.choice(["R", "A", "N"], n_lines),
            "l_linestatus": rng.choice(["O", "F"], n_lines),
            "l_shipdate": days(n_lines),
        }
    )
    parts = np.arange(n_parts)
    customers = np.arange(n_customers)
    frames = {
        "region": pd.DataFrame({"r_regionkey": [0], "r_name": ["R"]}),
        "nation": pd.DataFrame(
            {"n_nationkey": np.arange(3, dtype="int32"), "n_name": list("ABC"), "n_regionkey": 0}
        ),
        "customer": pd.DataFrame(
            {
                "c_custkey": customers,
                "c_name": [f"Customer#{k}" for k in customers],
                "c_nationkey": 0,
                "c_acctbal": 0.0,
                "c_mktsegment": rng.choice(["BUILDING", "OTHER"], n_customers),
            }
        ),
        "supplier": pd.DataFrame(
            {
                "s_suppkey": np.arange(40),
                "s_name": [f"Supplier#{k}" for k in range(40)],
                "s_nationkey": rng.integers(0, 3, 40).astype("int32"),
                "s_acctbal": 0.0,
            }
        ),
        "part": pd.DataFrame(
            {
                "p_partkey": parts,
                "p_name": rng.choice(["small ring", "red widget", "ñandú bolt"], n_parts),
                "p_brand": rng.choice(["Brand#1", "Brand#2", "Brand#3"], n_parts),
                "p_type": "T",
                "p_size": rng.integers(1, 50, n_parts).astype("int32"),
                "p_retailprice": rng.integers(10000, 10**6, n_parts) / 100,
            }
        ),
        "orders": orders,
        "lineitem": lines,
    }
    for name in TABLES:
        frames[name].to_parquet(folder / f"{name}.parquet", index=False)
    return str(folder)


@pytest.fixture(scope="module")
def small():
    return SMALL, connect(SMALL)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = skewed_tables(tmp_path_factory.mktemp("skewed"), seed=7)
    return folder, connect(folder)


@pytest.mark.parametrize("name", NAMES)
def test_query_on_test_tables(spark, small, name):
    folder, con = small
    assert difference(spark, con, name, folder) is None


@pytest.mark.parametrize("name", sorted(set(NAMES) - set(DATASETS)))
def test_query_on_skewed_tables(spark, skewed, name):
    folder, con = skewed
    assert difference(spark, con, name, folder) is None


def test_skew_is_there(skewed):
    folder, con = skewed
    hot = {"l_orderkey": "lineitem", "l_partkey": "lineitem", "o_custkey": "orders"}
    for column, table in hot.items():
        counts = Counter(v for (v,) in con.execute(f"SELECT {column} FROM {table}").fetchall())
        assert counts.most_common(1)[0][1] > counts.total() / 3


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.count() == 3
    assert df.schema == entry.entry(spark).schema


def test_invariants(spark):
    w = entry.warehouse(spark, SMALL)
    con = duckdb.connect()
    evolution = w["p13_evolucion_ventas"].toPandas()
    margins = w["p04_margen"].toPandas()
    con.register("evolution", evolution)
    con.register("margins", margins)
    per_granularity = con.execute(
        "SELECT DISTINCT SUM(ingreso_usd) FROM evolution GROUP BY granularidad"
    ).fetchall()
    per_level = con.execute(
        "SELECT DISTINCT SUM(ingreso_usd), SUM(margen_usd) FROM margins GROUP BY nivel"
    ).fetchall()
    assert len(per_granularity) == 1 and len(per_level) == 1
    assert per_granularity[0][0] == per_level[0][0]
    final = evolution.sort_values("periodo_inicio").groupby("granularidad").tail(1)
    assert set(final.ingreso_acumulado_usd) == {per_granularity[0][0]}
    for mart, share in (
        ("p15_ventas_por_dia_semana", "pct_del_ingreso_total"),
        ("p16_ticket_por_tipo_cliente", "pct_del_ingreso_total"),
        ("p18_mix_monedas", "pct_por_nro_facturas"),
        ("p06_inventario_muerto_resumen", "pct_del_capital_total"),
    ):
        shares = w[mart].toPandas()[share]
        assert abs(float(shares.sum()) - 100) <= 0.01 * len(shares)
    moves = w["fact_mov_inventario"]
    assert moves.where("cantidad_entrada + cantidad_salida <> abs(cantidad_neta)").count() == 0
    summary = w["p06_inventario_muerto_resumen"].toPandas()
    assert summary.nro_productos.sum() == w["dim_producto"].count()
