"""Readers, cleaning, typing and error collection."""

import gzip
from datetime import date, datetime

import pytest

from tallyhouse.plans.store import Files
from tallyhouse.sources.specs import SourceSpec, folder_manifest
from tallyhouse.sources.staging import (
    StagingError,
    add_audit_columns,
    drop_empty_rows,
    header_census,
    load_staging,
    normalize_columns,
    read_source,
)


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_normalize_is_idempotent_and_rejects_collisions(spark):
    df = spark.createDataFrame([(1, 2)], ["  Fecha Hora ", "TIPO"])
    once = normalize_columns(df)
    assert once.columns == ["fecha_hora", "tipo"] == normalize_columns(once).columns
    with pytest.raises(ValueError, match="a_b"):
        normalize_columns(spark.createDataFrame([(1, 2)], ["a b", "A_B"]))


def test_only_fully_empty_rows_are_dropped(spark):
    df = spark.createDataFrame(
        [(None, None), ("", None), (None, float("nan")), ("x", 1.0)], "a string, b double"
    )
    assert sorted(r.a for r in drop_empty_rows(df).collect()) == ["", "x"]


def test_audit_columns(spark):
    row = add_audit_columns(spark.createDataFrame([(1,)], "a int"), "f.csv").first()
    assert row.etl_source_file == "f.csv"
    assert abs((datetime.now() - row.etl_loaded_at).total_seconds()) < 24 * 3600


def test_csv_with_untidy_header_blanks_and_missing_tokens(spark, tmp_path):
    path = write(
        tmp_path / "clientes.csv",
        " Documento ,NOMBRE,Fecha Registro,Email,Notas\n"
        "V-1,Ana,2024-01-31,a@x.org,ok\n"
        ",,,,\n"
        "V-2,NA,,null,N/A\n",
    )
    rows = read_source(spark, SourceSpec(path, "stg_clientes")).orderBy("documento").collect()
    assert [(r.documento, r.nombre, r.fecha_registro, r.email, r.notas) for r in rows] == [
        ("V-1", "Ana", date(2024, 1, 31), "a@x.org", "ok"),
        ("V-2", None, None, None, None),
    ]
    assert {r.etl_source_file for r in rows} == {"clientes.csv"}


def test_bad_values_fail_or_become_null(spark, tmp_path, store):
    path = write(tmp_path / "feriados.csv", "fecha,feriado\n31/12/2024,Fin\n2024-01-01,Nuevo\n")
    spec = SourceSpec(path, "stg_feriados")
    safe = read_source(spark, spec, safe=True).orderBy("feriado").collect()
    assert [r.fecha for r in safe] == [None, date(2024, 1, 1)]
    with pytest.raises(StagingError, match="stg_feriados"):
        load_staging(spark, [spec], store)


@pytest.mark.parametrize("kind", ["json", "parquet", "orc"])
def test_other_formats(spark, tmp_path, kind):
    path = str(tmp_path / f"detalle.{kind}")
    names = ["Numero", "Product Codigo", "Cantidad", "Precio Unitario", "Subtotal"]
    df = spark.createDataFrame([("F1", "P1", 2.0, 1.5, 3.0)], names)
    df.write.format(kind).save(path)
    row = read_source(spark, SourceSpec(path, "stg_ventas_detalle", kind)).first()
    assert (row.numero, row.product_codigo, row.cantidad, row.subtotal) == ("F1", "P1", 2.0, 3.0)


def test_files_of_a_folder_are_read_by_name(spark, tmp_path, store):
    folder = tmp_path / "clientes"
    folder.mkdir()
    write(folder / "a.csv", "documento,nombre,fecha_registro,email\nV-1,Ana,2024-01-01,a@x.org\n")
    write(folder / "b.csv", "nombre,documento,fecha_registro,email\nEva,V-2,2024-01-01,e@x.org\n")
    write(folder / "c.csv", " Nombre ,DOCUMENTO,Email,Fecha Registro,Nota\nLuz,V-3,l@x.org,2024-01-02,n\n")
    write(folder / "d.csv", "")
    tables = load_staging(spark, [SourceSpec(str(folder), "stg_clientes")], store)
    rows = tables["stg_clientes"].orderBy("documento").collect()
    assert [(r.documento, r.nombre, r.email, r.nota) for r in rows] == [
        ("V-1", "Ana", "a@x.org", None),
        ("V-2", "Eva", "e@x.org", None),
        ("V-3", "Luz", "l@x.org", "n"),
    ]


def test_headers_of_many_files_come_from_one_job(spark, tmp_path):
    folder = tmp_path / "many files"
    folder.mkdir()
    headers = ["fecha,feriado", "Feriado,Fecha", " FECHA ,feriado,nota"]
    for i in range(60):
        write(folder / f"f+ {i}%20ñ.csv", headers[i % 3] + "\n" + "2024-01-01,x,y\n" * (5000 if i == 7 else i))
    write(folder / "empty.csv", "")
    write(folder / "_hidden.csv", "no,header\n")
    spark.sparkContext.setJobGroup("census", "headers")
    found = header_census(spark, str(folder))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("census")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1
    assert {h: len(paths) for h, paths in found.items()} == {h: 20 for h in headers}
    assert spark.read.text(found[headers[0]]).count() == sum(1 + i for i in range(0, 60, 3))
    # The session at hand keeps its settings.
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_headers_are_not_read_on_the_driver(spark, tmp_path, monkeypatch):
    opened = []
    real = open

    def counted(file, *args, **kwargs):
        opened.append(str(file))
        return real(file, *args, **kwargs)

    folder = tmp_path / "feriados"
    folder.mkdir()
    for i in range(5):
        write(folder / f"{i}.csv", f"fecha,feriado\n2024-01-0{i + 1},x\n")
    monkeypatch.setattr("builtins.open", counted)
    monkeypatch.setattr(Files, "_at", lambda *_: pytest.fail("the driver touches a file"))
    assert read_source(spark, SourceSpec(str(folder), "stg_feriados")).count() == 5
    assert not [f for f in opened if f.endswith(".csv")]


def test_gzipped_files_have_headers_too(spark, tmp_path):
    folder = tmp_path / "packed"
    folder.mkdir()
    with gzip.open(folder / "a.csv.gz", "wt") as file:
        file.write("fecha,feriado\n2024-01-01,Nuevo\n")
    write(folder / "b.csv", "feriado,fecha\nTrabajo,2024-05-01\n")
    rows = read_source(spark, SourceSpec(str(folder), "stg_feriados")).collect()
    assert {(r.fecha, r.feriado) for r in rows} == {(date(2024, 1, 1), "Nuevo"), (date(2024, 5, 1), "Trabajo")}


@pytest.mark.parametrize("row", ["2024-01-01,Nuevo,surplus", "2024-01-01"])
def test_a_row_of_another_width_is_refused(spark, tmp_path, store, row):
    path = write(tmp_path / "feriados.csv", f"fecha,feriado\n2024-05-01,Trabajo\n{row}\n")
    with pytest.raises(StagingError, match="stg_feriados"):
        load_staging(spark, [SourceSpec(path, "stg_feriados")], store)


def test_json_is_read_without_a_job_for_its_schema(spark, tmp_path):
    path = write(tmp_path / "d.json", '{"Numero": "F1", "Product Codigo": "P1", "Cantidad": 2}\n')
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("json-schema", "planning only")
    df = read_source(spark, SourceSpec(path, "stg_ventas_detalle", "json"))
    assert tracker.getJobIdsForGroup("json-schema") == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    row = df.first()
    assert (row.numero, row.product_codigo, row.cantidad, row.subtotal) == ("F1", "P1", 2.0, None)


@pytest.mark.parametrize("text", ["12d", "12f", "0x1p3", "1_000", "NaN", ""])
def test_numbers_are_decimal_numbers(spark, tmp_path, store, text):
    header = "numero,product_codigo,cantidad,precio_unitario,subtotal\n"
    path = write(tmp_path / "d.csv", f'{header}F1,P1,"{text}",1.5e1,+.5\n')
    row = read_source(spark, SourceSpec(path, "stg_ventas_detalle"), safe=True).first()
    assert (row.cantidad, row.precio_unitario, row.subtotal) == (None, 15.0, 0.5)
    if text not in ("", "NaN"):  # these two stand for a missing cell
        with pytest.raises(StagingError):
            load_staging(spark, [SourceSpec(path, "stg_ventas_detalle")], store)


def test_all_sources_are_tried_before_the_error(spark, tmp_path, store):
    good = SourceSpec(write(tmp_path / "a.csv", "fecha,feriado\n2024-01-01,Nuevo\n"), "stg_feriados")
    gone = SourceSpec(str(tmp_path / "missing.csv"), "stg_clientes")
    narrow = SourceSpec(write(tmp_path / "b.csv", "username\nana\n"), "stg_usuarios")
    with pytest.raises(StagingError) as caught:
        load_staging(spark, [gone, narrow, good], store)
    assert set(caught.value.failures) == {"stg_clientes", "stg_usuarios"}
    assert "PATH_NOT_FOUND" in str(caught.value.failures["stg_clientes"])
    assert "rol" in str(caught.value.failures["stg_usuarios"])
    assert spark.read.parquet(store.path("staging", "stg_feriados")).count() == 1


def test_manifest_covers_all_inputs():
    specs = folder_manifest("/data/", "csv")
    assert len(specs) == 12
    assert specs[0].path == "/data/clientes.csv" and specs[0].file_name == "clientes.csv"
