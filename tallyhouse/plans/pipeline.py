"""The whole run: staging, then core, then marts. A failed stage stops the next."""

import logging
import time
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from tallyhouse.plans.facts import FACT_COLUMNS, FACT_LINES
from tallyhouse.plans.quality import STRICT_RULES, quality_checks
from tallyhouse.plans.store import Store
from tallyhouse.plans.warehouse import DIMS, LINES, MARTS, ROLLUPS, Warehouse
from tallyhouse.sources.specs import SourceSpec
from tallyhouse.sources.staging import load_staging

log = logging.getLogger(__name__)

# Stages in order; the tables of one stage do not depend on each other's order.
STAGES = [
    ("core", list(DIMS)),
    ("work", list(LINES)),
    ("core", list(FACT_LINES)),
    ("work", list(ROLLUPS)),
    ("marts", list(MARTS)),
]


class QualityError(RuntimeError):
    """A constraint of the star schema is broken."""


def build_tables(warehouse: Warehouse, names: Iterable[str], threads: int = 4) -> None:
    """Build tables side by side, so that small jobs fill the gaps of large ones."""

    def build(name: str) -> None:
        started = time.perf_counter()
        warehouse[name]
        log.info("built %s in %.2fs", name, time.perf_counter() - started)

    target = inheritable_thread_target(warehouse.store.spark)(build)
    with ThreadPoolExecutor(threads) as pool:
        list(pool.map(target, names))


def run_pipeline(
    spark: SparkSession,
    specs: Iterable[SourceSpec],
    root: str,
    publish: bool = True,
    on_violation: str = "fail",
    safe_casts: bool = False,
    threads: int = 4,
    collation: str | None = None,
) -> Warehouse:
    """Rebuild the warehouse under root and return it.

    Tables are replaced one by one, each when its new version is complete, so a
    run that fails leaves what it has not replaced, and a second run with the same
    input leaves the same tables. With publish they are also registered as
    staging.*, core.* and marts.* for SQL. on_violation="fail" stops before the
    marts when a declared constraint is broken; "report" only logs the counts. A
    run that ends drops earlier versions and tables that it no longer has. A collation
    orders product descriptions as a database with it would.
    """
    if on_violation not in ("report", "fail"):
        raise ValueError("on_violation is 'report' or 'fail'")
    store = Store(spark, root)
    staging = load_staging(spark, specs, store, safe_casts)
    warehouse = Warehouse(staging, store, collation)
    if publish:
        for name, df in staging.items():
            store.publish("staging", name, df)
    for layer, names in STAGES:
        if layer == "marts":
            check_quality(warehouse, on_violation)
        build_tables(warehouse, names, threads)
        if publish and layer != "work":
            for name in names:
                _publish(warehouse, layer, name)
    layers: dict[str, set[str]] = {"staging": set(staging)}
    for layer, names in STAGES:
        layers.setdefault(layer, set()).update(names)
    layers["work"].update(["quality_checks", *[f"{name}_offsets" for name in FACT_LINES]])
    store.prune(layers, publish)
    return warehouse


def _publish(warehouse: Warehouse, layer: str, name: str) -> None:
    """Facts are published as views, which add the keys to the stored rows."""
    if name in FACT_LINES:
        key, *columns = FACT_COLUMNS[name]
        warehouse.store.publish_keyed(layer, name, f"{name}_offsets", key, columns)
    else:
        warehouse.store.publish(layer, name, warehouse[name])


def check_quality(warehouse: Warehouse, on_violation: str) -> None:
    checks = warehouse.store.save("work", "quality_checks", quality_checks(warehouse))
    # One row per rule, a fixed number.
    broken = checks.where("filas > 0").collect()
    for row in broken:
        log.warning("%s.%s: %s, %d", row.tabla, row.columna, row.regla, row.filas)
    strict = [r for r in broken if r.regla in STRICT_RULES]
    if strict and on_violation == "fail":
        listed = ", ".join(f"{r.tabla}.{r.columna} {r.regla} ({r.filas})" for r in strict)
        raise QualityError(f"broken constraints: {listed}")
