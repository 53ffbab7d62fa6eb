"""The physical plans are the ones that hold at scale."""

import contextlib
import io
import re
import threading

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyhouse.plans import rollups
from tallyhouse.plans.quality import quality_checks
from tallyhouse.plans.report import table_counts
from tallyhouse.plans.store import Store
from tallyhouse.plans.warehouse import DIMS, LINES, MARTS, Warehouse
from tallyhouse.sources import testbed

SMALL = "/root/testdata/sf0.001"
FACTS = ["fact_compras", "fact_mov_inventario", "fact_ventas"]


def plan(df):
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        df.explain("simple")
    return shown.getvalue()


@pytest.fixture(scope="module")
def warehouse(spark):
    return entry.warehouse(spark, SMALL)


@pytest.fixture
def nothing_is_small(spark):
    """As if every table were too large to broadcast."""
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in settings:
        spark.conf.set(key, "-1")
    yield
    for key in settings:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", ["dim_clientes", "dim_usuarios", "dim_proveedor", "dim_producto"])
def test_dedup_is_limited_before_the_shuffle(warehouse, name):
    text = plan(warehouse.dimension(name))
    assert text.count("WindowGroupLimit") == 2
    assert "SinglePartition" not in text


@pytest.mark.parametrize("name", [*LINES, *MARTS])
def test_no_nested_loops_or_python(warehouse, name):
    text = plan(warehouse.lines(name) if name in LINES else warehouse.plan(name))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "Python" not in text and "ArrowEval" not in text


@pytest.mark.parametrize("name", list(LINES))
def test_lines_of_any_size(nothing_is_small, warehouse, name):
    """Only the hours (24 at most) are broadcast without a look at their size."""
    text = plan(warehouse.lines(name))
    hinted = 1 if name != "purchase_lines" else 0
    assert text.count("BroadcastHashJoin") == hinted
    assert "SinglePartition" not in text


def test_document_lines_are_never_broadcast(warehouse):
    for name in ("sale_lines", "purchase_lines"):
        text = plan(warehouse.lines(name))
        merge = re.search(r"SortMergeJoin \[numero#\d+\], \[numero#\d+\]", text)
        assert merge, text


def test_rollups_combine_before_the_shuffle(warehouse):
    lines = warehouse["sale_lines"]
    for df in (rollups.sales_by_invoice(lines), rollups.sales_by_product(lines)):
        text = plan(df)
        assert "partial_sum" in text
        assert "SinglePartition" not in text
    # Files without repeated invoices are skipped when those are looked for.
    days = plan(rollups.sales_by_day(warehouse["sales_by_invoice"]))
    assert "EqualTo(repetida,true)" in days


def test_latest_stock_is_found_without_sorting(warehouse):
    text = plan(rollups.stock_by_product(warehouse["movement_lines"]))
    assert "HashAggregate" in text and "SortAggregate" not in text and "Sort " not in text


def test_only_invoices_of_several_days_have_rows_of_their_own(warehouse):
    days = warehouse["sales_by_day"].where("nro_repetida IS NOT NULL")
    several = (
        warehouse["sale_lines"]
        .groupBy("nro_factura")
        .agg(F.count_distinct("sk_fecha", "sk_moneda").alias("n"))
        .where("n > 1")
    )
    assert days.select("nro_repetida").distinct().count() == several.count()


def test_quality_checks_read_every_table_once(warehouse):
    text = plan(quality_checks(warehouse))
    assert "SortMergeJoin" not in text and "ShuffledHashJoin" not in text
    shuffles = text.count("Exchange hashpartitioning")
    # Derived staging tables bring shuffles of their own; the checks add two.
    derived = plan(warehouse["stg_compras_header"]).count("Exchange hashpartitioning")
    assert shuffles == derived + 2


def test_scans_are_pruned(warehouse):
    text = plan(rollups.sales_by_product(warehouse["sale_lines"]))
    read = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in re.split(r",(?=\w+:)", read)} == {
        "fecha",
        "sk_producto",
        "cantidad",
        "subtotal_usd",
    }


def test_coarser_margins_add_up_products(warehouse):
    text = plan(warehouse.plan("p04_margen"))
    assert "Expand" not in text


def test_marts_read_rollups_only(warehouse):
    heavy = {"p01_top_productos"}
    for name in set(MARTS) - heavy:
        assert "sale_lines" not in plan(warehouse.plan(name))


def test_core_tables_cut_the_lineage(warehouse):
    for name in DIMS:
        assert "lineitem" not in plan(warehouse[name])


def test_rows_are_counted_without_writing_the_facts(spark, warehouse):
    fresh = Warehouse(testbed.staging(spark, SMALL), Store.scratch(spark))
    counts = {r.tabla: r.filas for r in table_counts(fresh).collect()}
    made = [*fresh.store.files.names(f"{fresh.store.root}/core"), *fresh.store.files.names(f"{fresh.store.root}/work")]
    assert not {*FACTS, *LINES} & set(made)
    assert {f: counts[f] for f in FACTS} == {f: warehouse[f].count() for f in FACTS}
    # Where they are stored, they are what is counted.
    assert "numero" not in plan(table_counts(warehouse))


def test_missing_inputs_are_built_side_by_side(spark):
    fresh = Warehouse(testbed.staging(spark, SMALL), Store.scratch(spark))
    both = threading.Barrier(2, timeout=60)
    build = fresh._stored

    def stored(name):
        both.wait()
        return build(name)

    fresh._stored = stored
    moneda, hora = fresh.tables(["dim_moneda", "dim_hora"])
    assert (moneda.columns[0], hora.columns[0]) == ("sk_moneda", "sk_hora")
