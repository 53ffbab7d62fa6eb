"""The whole run from files to SQL tables."""

import pytest
from pyspark.sql import functions as F

from tallyhouse.__main__ import main
from tallyhouse.plans.facts import FACT_LINES
from tallyhouse.plans.pipeline import QualityError, run_pipeline
from tallyhouse.plans.report import DATASETS, READS, report_datasets
from tallyhouse.plans.store import Store, shared_folder
from tallyhouse.plans.warehouse import DIMS, MARTS, Warehouse
from tallyhouse.sources.specs import SCHEMAS, folder_manifest
from tallyhouse.sources.staging import StagingError
from tallyhouse.sources.testbed import staging

LOAD_TIMES = {"fecha_creacion", "etl_loaded_at"}


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """The staging inputs as CSV, with untidy headers."""
    folder = tmp_path_factory.mktemp("inputs")
    frames = staging(spark, "/root/testdata/sf0.001")
    frames["stg_tasas_cambio_fuentes"] = spark.createDataFrame([("BCV",)], "fuente string")
    for table, df in frames.items():
        untidy = df.toDF(*[f" {c.upper().replace('_', ' ')} " for c in df.columns])
        options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        untidy.write.options(**options).csv(str(folder / f"{table.removeprefix('stg_')}.csv"))
    return str(folder)


def snapshot(df):
    columns = [c for c in df.columns if c not in LOAD_TIMES]
    whole = df.select(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.count(F.lit(1))).first()
    return tuple(whole)


def test_run_publish_and_rerun(spark, inputs, tmp_path):
    root = str(tmp_path / "wh")
    specs = folder_manifest(inputs, "csv")
    run_pipeline(spark, specs, root, on_violation="report")
    names = (
        [f"staging.{t}" for t in SCHEMAS]
        + [f"core.{t}" for t in (*DIMS, *FACT_LINES)]
        + [f"marts.{t}" for t in MARTS]
    )
    first = {name: snapshot(spark.table(name)) for name in names}
    assert all(rows > 0 for name, (_, rows) in first.items())

    spark.sql("CREATE TABLE marts.p99_gone USING parquet AS SELECT 1 AS x")
    again = main([inputs, root, "--report", "--lenient"])
    assert {name: snapshot(spark.table(name)) for name in names} == first

    # Tables that are no longer made are gone, and so are earlier versions.
    assert not spark.catalog.tableExists("marts.p99_gone")
    assert all(len(list((tmp_path / "wh" / "marts" / m).iterdir())) == 1 for m in MARTS)

    # Reading the CSV copy gives the same warehouse as the tables themselves.
    direct = Warehouse(staging(spark, "/root/testdata/sf0.001"), Store.scratch(spark))
    for mart in ("p04_margen", "p18_mix_monedas", "p19_tipo_cambio_mensual"):
        assert snapshot(direct[mart]) == snapshot(spark.table(f"marts.{mart}"))

    stored = spark.read.parquet(again.store.path("report", "currency_share_pivot"))
    assert stored.columns == ["mes_inicio", "bs", "usd", "cop"] and stored.count() > 0

    sets = report_datasets(again)
    assert set(sets) == set(DATASETS) | set(READS)
    months = [r.mes_inicio for r in sets["p19_mes"].collect()]
    assert months == sorted(months)
    shares = [r.pct_por_monto for r in sets["p18"].collect()]
    assert shares == sorted(shares, reverse=True)
    assert [r.granularidad for r in sets["evolution_stats"].collect()] == ["DIA", "SEMANA", "MES", "ANIO"]


def test_failed_staging_stops_the_run(spark, tmp_path):
    with pytest.raises(StagingError):
        run_pipeline(spark, folder_manifest(str(tmp_path / "none")), str(tmp_path / "wh"))
    assert not (tmp_path / "wh" / "core").exists()


def test_broken_constraint_stops_before_the_marts(spark, inputs, tmp_path):
    bad = tmp_path / "clientes.csv"
    bad.write_text("documento,nombre,fecha_registro,email\nX-1,Ana,2024-01-01,a@x.org\n")
    specs = [
        s if s.table != "stg_clientes" else type(s)(str(bad), "stg_clientes")
        for s in folder_manifest(inputs, "csv")
    ]
    with pytest.raises(QualityError, match="dim_clientes.tipo dominio"):
        run_pipeline(spark, specs, str(tmp_path / "wh"), publish=False)
    assert (tmp_path / "wh" / "core").exists()
    assert not (tmp_path / "wh" / "marts").exists()


def test_a_failed_rebuild_leaves_the_old_table(spark, store):
    old = store.save("core", "t", spark.range(9))
    bad = spark.range(9).select(F.raise_error(F.concat(F.lit("no "), F.col("id"))).alias("id"))
    with pytest.raises(Exception, match="no "):
        store.save("core", "t", bad)
    assert old.count() == 9
    assert spark.read.parquet(store.path("core", "t")).count() == 9
    # A store that is opened later finds the same version.
    assert spark.read.parquet(Store(spark, store.root).path("core", "t")).count() == 9


def test_kept_parts_go_when_the_table_is_stored(spark, store):
    with store.temporary():
        kept = store.keep("part", spark.range(5))
        assert kept.count() == 5
    assert store.files.names(f"{store.root}/work/_parts") == []


def test_ordered_reads(spark):
    import __spark_entry__ as entry

    sets = report_datasets(entry.warehouse(spark, "/root/testdata/sf0.001"))
    dead = sets["p6_orden"].collect()
    keys = [
        (
            r.fecha_ultima_venta is not None,
            r.dias_sin_vender is None,
            -(r.dias_sin_vender or 0),
            r.capital_inmovilizado_usd is not None,
            -(r.capital_inmovilizado_usd or 0),
        )
        for r in dead
    ]
    assert keys == sorted(keys) and len({k[0] for k in keys}) == 2
    levels = [(r.nivel, -r.margen_usd) for r in sets["p4_orden"].collect()]
    assert levels == sorted(levels)
    periods = [(r.granularidad, r.periodo_inicio) for r in sets["p13_orden"].collect()]
    assert periods == sorted(periods)
    best = [(r.ranking_por_cantidad, r.ranking_por_monto) for r in sets["p1_orden"].collect()]
    assert best == sorted(best)


class FakeSession:
    """Stands in for a session without a named folder."""

    def __init__(self, master, **settings):
        self.conf = settings
        self.sparkContext = type("Context", (), {"master": master})


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(FakeSession("yarn", **{"spark.checkpoint.dir": "s3a://b/x/"})) == "s3a://b/x"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(FakeSession("yarn"))
    assert "tallyhouse-" in shared_folder(FakeSession("local[2]"))
