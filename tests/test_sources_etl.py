"""Readers, sinks and ETL jobs on files in the reference's input shapes."""

import json
import os

import pytest
from pyspark.sql import types as T

from paylens.operators import legislative as leg
from paylens.operators import sync
from paylens.operators import unify
from paylens.sources import drift, readers, sinks


def _write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode(encoding))


def test_header_probe_semicolon(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t.csv")
    _write(p, "col1;col2\nval1;val2\n")
    assert readers.read_header(spark, p, encoding="UTF-8") == ["col1", "col2"]


BULK = (
    "organismo_nombre;Año;Mes;mes;Nombres;Paterno;Materno;Tipo cargo;remuliquida_mensual\n"
    "Org A;2024;Marzo;x;María José;Muñoz;Pérez;Jefe;$ 1.000,50\n"
    "Org A;1999;Marzo;x;Ana;Soto;;Jefe;100\n"
    "Org B;2000;Abril;x;Luis;Díaz;Rojas;\"Jefe; área\";2.002,5\n"
    "Org B;2050;Mayo;x;Eva\n"
    "Org C;2051;Mayo;x;Eva;Paz;Lo;Cargo;1;extra;more\n"
    "Org C;texto;Mayo;x;Eva;Paz;Lo;Cargo;1\n"
    "Org C;;Mayo;x;Eva;Paz;Lo;Cargo;1\n"
    "Org D;2030;Junio;x;I\u00f1aki;N\u00fa\u00f1ez;S\u00e1;Jefe;3,5;sobra;sobra\n"
)


def test_bulk_ingest_latin1(spark, tmp_dir):
    src = os.path.join(tmp_dir, "TA_PersonalContratohonorarios.csv")
    _write(src, BULK, "latin-1")
    out = os.path.join(tmp_dir, "pq")
    df = leg.ingest_bulk_csv(spark, [src], out, num_files=2)
    rows = {r.Nombres: r for r in df.collect()}
    # year sanity keeps 2000 and 2050 only (text, empty, 1999, 2051 dropped)
    assert sorted(r.anyo for r in rows.values()) == [2000, 2024, 2030, 2050]
    r = rows["María José"]
    assert r.remuliquida_mensual == 1001 and r.Mes == "Marzo"  # 'Mes' wins over 'mes'
    assert r.search_vector == "maria jose munoz perez"  # full fold, trimmed
    assert r.origen == "Honorarios" and r.remuneracionbruta_mensual is None
    assert rows["Luis"].cargo == "Jefe; área" and rows["Luis"].remuliquida_mensual == 2003
    assert rows["Eva"].Paterno is None  # short row padded with NULL
    # decomposed accents fold like composed ones; an over-long row keeps its
    # first columns and drops the overflow
    d = rows["I\u00f1aki"]
    assert d.search_vector == "inaki nunez sa" and d.remuliquida_mensual == 4 and d.cargo == "Jefe"
    # partitioned by origen / anyo, ZSTD
    assert os.path.isdir(os.path.join(out, "origen=Honorarios", "anyo=2024", "Mes=Marzo"))


def test_audit_view_two_sources(spark):
    a = spark.createDataFrame([("Ana", "Soto", "2024", "Enero", "Org", "1.000")],
                              "Nombre string, paterno string, Year string, Month string, Institucion string, `Sueldo Liquido` string")
    b = spark.createDataFrame([("Eva", 2024, "Enero", 5)],
                              "nombres string, anyo int, Mes string, remuneracionbruta int")
    v = unify.audit_view([("Planta", a), ("Contrata", b)]).collect()
    assert {r.Origen: r.sueldo for r in v} == {"Planta": "1.000", "Contrata": "5"}
    assert all(isinstance(r.anyo, str) for r in v)


ITEM = T.StructType([T.StructField("ano", T.IntegerType()), T.StructField("mes", T.IntegerType()),
                     T.StructField("rut", T.StringType()), T.StructField("nombre", T.StringType()),
                     T.StructField("appaterno", T.StringType()), T.StructField("apmaterno", T.StringType()),
                     T.StructField("dieta", T.LongType()), T.StructField("deducciones", T.LongType()),
                     T.StructField("saldo", T.LongType())])
EXP = T.StructType([T.StructField("ano", T.IntegerType()), T.StructField("mes", T.IntegerType()),
                    T.StructField("nombre", T.StringType()), T.StructField("appaterno", T.StringType()),
                    T.StructField("apmaterno", T.StringType()),
                    T.StructField("gastos_operacionales", T.StringType()), T.StructField("monto", T.LongType())])


def test_senate_envelopes_and_consolidation(spark, tmp_dir):
    pay_dir = os.path.join(tmp_dir, "dietas")
    a = {"ano": 2024, "mes": 3, "rut": "1-9", "nombre": "José", "appaterno": "Pérez",
         "apmaterno": None, "dieta": 100, "deducciones": 10, "saldo": 90}
    b = dict(a, rut="2-7", nombre="Ana", appaterno="Soto", apmaterno="Lagos", mes=13)
    _write(os.path.join(pay_dir, "2024", "03.json"), json.dumps(
        {"data": {"data": [{"id": 1, "attributes": a}], "meta": {"pagination": {"page": 1}}}}, indent=2))
    _write(os.path.join(pay_dir, "2024", "13.json"), json.dumps({"data": [b]}, indent=2))
    _write(os.path.join(pay_dir, "2024", "bad.json"), "{not json")
    exp_dir = os.path.join(tmp_dir, "gastos")
    items = [{"ano": 2024, "mes": 3, "nombre": " josé ", "appaterno": "PÉREZ", "apmaterno": None,
              "gastos_operacionales": "TELEFONIA", "monto": 7},
             {"ano": 2024, "mes": 3, "nombre": "José", "appaterno": "Pérez", "apmaterno": "",
              "gastos_operacionales": "OFICINA", "monto": 5}]
    _write(os.path.join(exp_dir, "2024", "03.json"), json.dumps({"data": {"data": items}}))
    pay = readers.read_envelopes(spark, f"{pay_dir}/*/*.json", ITEM)
    spent = readers.read_envelopes(spark, f"{exp_dir}/*/*.json", EXP)
    assert pay.count() == 2  # the corrupt document yields nothing
    extract, app, detail = leg.consolidate_senate(pay, spent)
    got = {r.llave_senador: r for r in extract.collect()}
    assert got["JOSÉ PÉREZ"].total_gastos_operacionales == 12
    assert got["JOSÉ PÉREZ"].costo_total_mensual == 112
    assert got["ANA SOTO LAGOS"].total_gastos_operacionales == 0  # no expenses
    rows = {r.Nombres: r for r in app.collect()}
    assert rows["ANA"].Mes == "Enero"  # unknown month -> Enero
    assert rows["JOSÉ"].Materno == "" and rows["JOSÉ"].search_vector == "jose perez"
    assert detail.count() == 2


def test_chamber_monthly_drops(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    _write(f"{raw}/personal_apoyo/2024_03.csv", "Nombre,Cargo,Sueldo,Diputada a cargo\nAna,,$ 1.000,Dip. X\n,Asesor,5,Dip. Y\n")
    _write(f"{raw}/personal_apoyo/2024_04.csv", "Nombre,Sueldo\nEva,2.000\nIn\u0303aki Nu\u0301n\u0303ez,1\n")
    _write(f"{raw}/personal_apoyo/notes.csv", "Nombre,Sueldo\nZed,1\n")
    _write(f"{raw}/personal_planta/2024_03.csv", "Nombre Completo,Función,Remuneración Bruta\nLuis,Chofer,1.500.000\n")
    _write(f"{raw}/personal_contrata/2024_03.csv", "")
    _write(f"{raw}/personal_honorarios/2024_03.csv", "Cargo,Honorario\nX,10\n")
    _write(f"{raw}/diputados_dieta/2024_03.csv",
           "ID_Diputado,Nombre,Cargo,Sueldo Bruto,Sueldo Liquido,Mes,Ano\n7,Rosa Paz,Diputada,100,90,3,2024\n")
    _write(f"{raw}/diputados_dieta/2024_04.csv",
           "ID_Diputado,Nombre,Cargo,Sueldo Bruto,Sueldo Liquido,Mes,Ano\n7,Rosa Paz Lo,Diputada,100,90,4,2024\n")
    _write(f"{raw}/gastos_operacionales/7_2024_04.csv", "Concepto,Monto,ID_Diputado\nOficina,$ 3.000,7\n")
    _write(f"{raw}/gastos_operacionales/8_2024_04.csv", "Concepto,Monto,ID_Diputado\nLuz,10,8\n")
    app = {r.Nombres: r for r in leg.consolidate_chamber(spark, raw).collect()}
    assert set(app) == {"ANA", "EVA", "LUIS", "ROSA PAZ", "ROSA PAZ LO", "IN\u0303AKI NU\u0301N\u0303EZ"}  # blank, unnamed dropped
    assert app["IN\u0303AKI NU\u0301N\u0303EZ"].search_vector == "inaki nunez"  # decomposed input folds like composed
    assert app["ANA"].cargo == "Asesor de Dip. X" and app["ANA"].remuliquida_mensual == 1000
    assert app["EVA"].cargo == "Asesor de Diputado" and app["EVA"].Mes == "Abril"
    assert app["LUIS"].cargo == "Chofer" and app["LUIS"].remuliquida_mensual == 1500000
    assert app["ROSA PAZ"].remuneracionbruta_mensual == 100
    spent = {r.llave_senador: r.monto for r in leg.read_chamber_expenses(spark, raw).collect()}
    assert spent == {"ROSA PAZ LO": 3000, None: 10}  # latest name wins; unknown id -> NULL


def test_manifest_diff_cases(spark):
    remote = spark.createDataFrame([
        ("new", 10, "Mon, 05 Feb 2024 08:00:00 GMT"), ("resized", 11, "Mon, 05 Feb 2024 08:00:00 GMT"),
        ("newer", 10, "Mon, 05 Feb 2024 08:00:00 GMT"), ("same", 10, "Mon, 01 Jan 2024 08:00:00 GMT"),
        ("unknown", 0, None)], "name string, size long, last_modified string")
    local = spark.createDataFrame([
        ("resized", 10, "Sat, 03 Feb 2024 00:00:00 GMT"), ("newer", 10, "Sat, 03 Feb 2024 00:00:00 GMT"),
        ("same", 10, "Sat, 03 Feb 2024 00:00:00 GMT"), ("unknown", 5, "Sat, 03 Feb 2024 00:00:00 GMT"),
        ("gone", 1, "Sat, 03 Feb 2024 00:00:00 GMT")], "name string, size long, last_modified string")
    got = {r.name: r.action for r in sync.manifest_diff(local, remote).collect()}
    assert got == {"new": "download", "resized": "download", "newer": "download",
                   "same": "up_to_date", "unknown": "skip", "gone": "gone"}


def test_report_csv_roundtrip_latin1(spark, tmp_dir):
    df = spark.createDataFrame([("Muñoz", "$ 1.000")], "Nombre string, Monto string")
    out = os.path.join(tmp_dir, "rep")
    sinks.write_report_csv(df, out)
    data = b"".join(open(os.path.join(out, f), "rb").read() for f in os.listdir(out) if f.endswith(".csv"))
    assert "Muñoz".encode("latin-1") in data
    back = readers.read_lenient_csv(spark, out)
    assert back.first()[0] == "Muñoz"


def test_existing_paths(spark, tmp_dir):
    p = os.path.join(tmp_dir, "x.csv")
    _write(p, "a\n1\n")
    assert readers.existing_paths(spark, [("a", p), ("b", p + ".missing")]) == [("a", p)]


def test_monthly_items_roundtrip(spark, tmp_dir):
    items = spark.createDataFrame([("dietas", 2024, 3, "a", 1), ("dietas", 2024, 3, "b", 2),
                                   ("dietas", 2024, 4, "c", 3)],
                                  "category string, ano int, mes int, nombre string, monto long")
    out = os.path.join(tmp_dir, "items")
    sinks.write_monthly_items(items, out)
    again = spark.createDataFrame([("dietas", 2024, 4, "d", 9)], items.schema)
    sinks.write_monthly_items(again, out)  # replaces April only
    back = {(r.mes, r.nombre) for r in spark.read.json(out).collect()}
    assert back == {(3, "a"), (3, "b"), (4, "d")}


def test_headers_of_any_number_of_files(spark, tmp_dir):
    for n in (3, 60):
        root = os.path.join(tmp_dir, f"drops año {n} [x]%41")
        heads = ["Nombre,Sueldo", "nombre_completo,Remuneración", "Sueldo,Nombre"]
        for i in range(n):
            _write(os.path.join(root, f"2024_{i + 1:02d}.csv"), heads[i % 3] + "\n" + "".join(f"p{j},{j}\n" for j in range(5)))
        _write(os.path.join(root, "2024_99.csv"), "")
        _write(os.path.join(root, "notes.txt"), "x\n")
        found = readers.headers_of(spark, root, pattern=r"\.csv$")
        assert {h: len(p) for h, p in found.items()} == {h: n // 3 for h in heads}
        assert found[heads[0]][0] == "file:" + os.path.join(root, "2024_01.csv") or found[heads[0]][0].endswith("2024_01.csv")


def test_three_column_orders_and_odd_names(spark, tmp_dir):
    root = os.path.join(tmp_dir, "runs", "2024_03", "a%41 b")
    _write(f"{root}/2019_07.csv", "Nombre,Cargo,Sueldo\nAna,Jefa,1\n")
    _write(f"{root}/2019_08.csv", "Sueldo,Nombre,Cargo\n2,Eva,Jefa\n")
    _write(f"{root}/2019_09.csv", "Cargo,Sueldo,Nombre\r\nJefa,3,Luz\r\n")
    frames = readers.read_keyed_groups(spark, root, leg.MONTH_FILE, ["anyo", "mes"])
    rows = sorted((r.anyo, r.mes, r.Nombre, r.Cargo, r.Sueldo) for r in unify.ragged_concat(frames).collect())
    assert rows == [(2019, 7, "Ana", "Jefa", "1"), (2019, 8, "Eva", "Jefa", "2"), (2019, 9, "Luz", "Jefa", "3")]
    assert readers.read_keyed_groups(spark, root + "_none", leg.MONTH_FILE, ["anyo", "mes"]) == []


def test_files_of_different_headers_are_not_read_by_position(spark, tmp_dir):
    a, b = os.path.join(tmp_dir, "a.csv"), os.path.join(tmp_dir, "b.csv")
    _write(a, "x;y\n1;2\n")
    _write(b, "y;x\n2;1\n")
    with pytest.raises(ValueError, match="different headers"):
        readers.read_lenient_csv(spark, [a, b])
    assert readers.read_lenient_csv(spark, [a, a]).count() == 2


def test_numbers_in_any_writing(spark, tmp_dir):
    a = {"ano": "2024", "mes": 3.0, "rut": "1-9", "nombre": "Ana", "appaterno": "Soto", "apmaterno": None,
         "dieta": 1000.0, "deducciones": "x", "saldo": " 900 "}
    _write(os.path.join(tmp_dir, "d", "p.json"), json.dumps({"data": [a]}))
    row = readers.read_envelopes(spark, os.path.join(tmp_dir, "d", "*.json"), ITEM, rejected="bad").first()
    assert (row.ano, row.mes, row.dieta, row.saldo, row.deducciones, row.bad) == (2024, 3, 1000, 900, None, 1)


def test_drops_of_one_month_add_up_and_replace_themselves(spark, tmp_dir):
    head = "organismo_nombre;anyo;Mes;Nombres;remuliquida_mensual\n"
    out, a, b = (os.path.join(tmp_dir, n) for n in ("lake", "TA_PersonalPlanta_a.csv", "TA_PersonalPlanta_b.csv"))
    _write(a, head + "O;2024;Marzo;Ana;1\nO;2024;Abril;Ana;2\n")
    _write(b, head + "O;2024;Marzo;Eva;3\n")
    skipped = []
    leg.ingest_bulk_csv(spark, [a, a + ".none"], out, skipped=skipped)
    assert skipped == [(a + ".none", "missing")]
    assert leg.ingest_bulk_csv(spark, [b], out).count() == 3
    _write(a, head + "O;2024;Marzo;Ana;9\n")  # without April now
    rows = sorted((r.drop[-5], r.Mes, r.Nombres, r.remuliquida_mensual) for r in leg.ingest_bulk_csv(spark, [a], out).collect())
    assert rows == [("a", "Marzo", "Ana", 9), ("b", "Marzo", "Eva", 3)]


def test_base_pay_with_gaps_and_without_columns(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    _write(f"{raw}/diputados_dieta/2019_07.csv", "ID_Diputado,Nombre,Cargo,Sueldo Bruto,Sueldo Liquido\n7,Rosa,D,100,90.0\n8,Luz,D,100,\n")
    _write(f"{raw}/diputados_dieta/2019_08.csv", "ID_Diputado,Nombre\n7,Rosa\n")
    rows = {r.Nombres: r for r in leg.consolidate_chamber(spark, raw).collect()}
    assert rows["ROSA"].remuliquida_mensual == 90 and rows["LUZ"].remuliquida_mensual == 0 and len(rows) == 2


def test_quarantine_column_flags_ragged_rows(spark, tmp_dir):
    p = os.path.join(tmp_dir, "q.csv")
    _write(p, "a;b;c\n1;2;3\n4;5\n6;7;8;9\n", "latin-1")
    df = readers.read_lenient_csv(spark, p, corrupt_column="_corrupt").cache()
    rows = sorted(df.collect(), key=lambda r: r[0])
    assert [r[0] for r in rows] == ["1", "4", "6"]
    assert [r._corrupt is not None for r in rows] == [False, True, True]


def test_parquet_sources_skip_missing(spark, tmp_dir):
    a = os.path.join(tmp_dir, "a")
    spark.createDataFrame([(1, "x")], "id int, v string").write.parquet(a)
    b = os.path.join(tmp_dir, "b")
    spark.createDataFrame([(2,)], "id int").write.parquet(b)
    df = readers.read_parquet_sources(spark, [("A", a), ("B", b), ("C", a + "_missing")])
    got = sorted((r.id, r.v, r.origen_fuente) for r in df.collect())
    assert got == [(1, "x", "A"), (2, None, "B")]
    assert readers.read_parquet_sources(spark, [("C", a + "_missing")]) is None


def test_senate_job_writes_all_outputs(spark, tmp_dir):
    cache = os.path.join(tmp_dir, "cache")
    a = {"ano": 2024, "mes": 3, "rut": "1-9", "nombre": "José", "appaterno": "Pérez",
         "apmaterno": None, "dieta": 100, "deducciones": 10, "saldo": 90}
    _write(os.path.join(cache, "dietas", "2024", "03.json"), json.dumps({"data": {"data": [{"attributes": a}]}}))
    _write(os.path.join(cache, "gastos_operacionales", "2024", "03.json"), json.dumps(
        {"data": [{"ano": 2024, "mes": 3, "nombre": "JOSE", "appaterno": "PÉREZ", "apmaterno": None,
                   "gastos_operacionales": "LUZ", "monto": 7}]}))
    outs = leg.senate_job(spark, cache, os.path.join(tmp_dir, "out"))
    app = spark.read.parquet(outs["pay"]).first()
    assert (app.origen, app.Mes, app.remuliquida_mensual) == ("Senado", "Marzo", 90)
    assert spark.read.parquet(outs["detail"]).count() == 1
    extract = spark.read.option("header", True).csv(outs["extract"]).first()
    # 'JOSE' and 'JOSÉ' are different keys, as in the published job (no folding in the key)
    assert extract.llave_senador == "JOSÉ PÉREZ" and extract.total_gastos_operacionales == "0"
    # no expense endpoint cached at all: zero expenses, no detail table
    only_pay = os.path.join(tmp_dir, "cache2")
    _write(os.path.join(only_pay, "dietas", "2024", "03.json"), json.dumps({"data": [a]}))
    outs2 = leg.senate_job(spark, only_pay, os.path.join(tmp_dir, "out2"))
    row = spark.read.option("header", True).csv(outs2["extract"]).first()
    assert row.total_gastos_operacionales == "0" and row.costo_total_mensual == "100"
    assert not os.path.exists(outs2["detail"])


def test_chamber_and_catalogue_jobs(spark, tmp_dir):
    from paylens.operators import catalogue
    raw = os.path.join(tmp_dir, "raw")
    _write(f"{raw}/personal_apoyo/2024_03.csv", "Nombre,Cargo,Sueldo,Diputada a cargo\nAna,,$ 1.000,Dip. X\n")
    _write(f"{raw}/diputados_dieta/2024_03.csv",
           "ID_Diputado,Nombre,Cargo,Sueldo Bruto,Sueldo Liquido,Mes,Ano\n7,Rosa Paz,Diputada,100,90,3,2024\n")
    _write(f"{raw}/gastos_operacionales/7_2024_03.csv", "Concepto,Monto,ID_Diputado\nOficina,$ 3.000,7\n")
    outs = leg.chamber_job(spark, raw, os.path.join(tmp_dir, "out"))
    pay = spark.read.parquet(outs["pay"])
    assert sorted(r.Nombres for r in pay.collect()) == ["ANA", "ROSA PAZ"]
    assert spark.read.parquet(outs["detail"]).first().llave_senador == "ROSA PAZ"
    cat = {r.dataset: r for r in catalogue.catalogue_job(spark, outs["pay"], os.path.join(tmp_dir, "cat")).collect()}
    assert cat["Cámara de Diputados"].anios == [2024]
    assert cat["Todas (Búsqueda Global)"].organismos == ["Cámara de Diputadas y Diputados"]


def test_pay_table_overwrite_replaces_only_present_partitions(spark, tmp_dir):
    out = os.path.join(tmp_dir, "pay")
    cols = "origen string, anyo int, Mes string, search_vector string, v int"
    first = spark.createDataFrame([("Planta", 2023, "Enero", "a", 1), ("Planta", 2024, "Enero", "b", 2)], cols)
    sinks.write_pay_parquet(first, out, num_files=2)
    again = spark.createDataFrame([("Planta", 2024, "Enero", "c", 3)], cols)
    sinks.write_pay_parquet(again, out, num_files=2)
    got = sorted((r.anyo, r.search_vector) for r in spark.read.parquet(out).collect())
    assert got == [(2023, "a"), (2024, "c")]


# ---------------------------------------------------------- committed generations

HEAD = "organismo_nombre;anyo;Mes;Nombres;remuliquida_mensual\n"


def _held(spark, out):
    from paylens.sources import generations
    return sorted((r.drop, r.Mes, r.Nombres, r.remuliquida_mensual) for r in generations.read(spark, out).collect())


def test_a_write_that_fails_changes_nothing(spark, tmp_dir, monkeypatch):
    out, a, b = (os.path.join(tmp_dir, n) for n in ("lake", "TA_PersonalPlanta.csv", "TA_PersonalContrata.csv"))
    _write(a, HEAD + "O;2024;Marzo;Ana;1\nO;2024;Abril;Ana;2\n")
    leg.ingest_bulk_csv(spark, [a], out, root=tmp_dir)
    before = _held(spark, out)
    _write(a, HEAD + "O;2024;Marzo;Eva;9\n")
    _write(b, HEAD + "O;2024;Marzo;Luz;3\n")
    whole = sinks.write_pay_parquet

    def broken(df, path, **options):
        whole(df, path, **options)
        raise RuntimeError("lost")

    monkeypatch.setattr(sinks, "write_pay_parquet", broken)
    with pytest.raises(RuntimeError, match="lost"):
        leg.ingest_bulk_csv(spark, [a, b], out, root=tmp_dir)
    assert _held(spark, out) == before
    assert spark.read.parquet(out).count() == 2  # nothing is left of it
    monkeypatch.undo()
    leg.ingest_bulk_csv(spark, [a, b], out, root=tmp_dir)
    assert _held(spark, out) == [("TA_PersonalContrata.csv", "Marzo", "Luz", 3), ("TA_PersonalPlanta.csv", "Marzo", "Eva", 9)]


def test_a_driver_lost_before_its_commit_changes_nothing(spark, tmp_dir, monkeypatch):
    from paylens.sources import generations
    out, a = os.path.join(tmp_dir, "lake"), os.path.join(tmp_dir, "TA_PersonalPlanta.csv")
    _write(a, HEAD + "O;2024;Marzo;Ana;1\n")
    leg.ingest_bulk_csv(spark, [a], out, root=tmp_dir)
    _write(a, HEAD + "O;2024;Marzo;Eva;9\n")

    def lost(*args):
        raise KeyboardInterrupt

    monkeypatch.setattr(generations._Folder, "publish", lost)
    monkeypatch.setattr(generations._Folder, "drop_generation", lambda *args: None)
    with pytest.raises(KeyboardInterrupt):
        leg.ingest_bulk_csv(spark, [a], out, root=tmp_dir)
    monkeypatch.undo()
    assert _held(spark, out) == [("TA_PersonalPlanta.csv", "Marzo", "Ana", 1)]
    assert spark.read.parquet(out).count() == 2
    assert generations.vacuum(spark, out) == 1
    assert spark.read.parquet(out).count() == 1 and len(_held(spark, out)) == 1


def test_same_names_in_two_folders_and_an_empty_drop(spark, tmp_dir):
    from paylens.sources import generations
    out = os.path.join(tmp_dir, "lake")
    a, b, c = (os.path.join(tmp_dir, n) for n in ("2024/TA_Planta a%41 =.csv", "2025/TA_Planta a%41 =.csv", "x/aTA.csv"))
    _write(a, HEAD + "O;2024;Marzo;Ana;1\n")
    _write(b, HEAD + "O;2025;Marzo;Ana;2\n")
    for root in (tmp_dir, None):
        lake = out + str(root is None)
        _write(a, HEAD + "O;2024;Marzo;Ana;1\n")
        leg.ingest_bulk_csv(spark, [a], lake, root=root)
        assert leg.ingest_bulk_csv(spark, [b], lake, root=root).count() == 2
        _write(c, HEAD + "O;2025;Marzo;Eva;3\n")
        for empty in ("", HEAD):
            _write(a, empty)
            skipped = []
            rows = leg.ingest_bulk_csv(spark, [a, c], lake, skipped=skipped, root=root)
            assert skipped == [(a, "empty")]
            assert sorted((r.Nombres, r.remuliquida_mensual) for r in rows.collect()) == [("Ana", 1), ("Ana", 2), ("Eva", 3)]
        assert generations.vacuum(spark, lake) == 1 and generations.vacuum(spark, lake) == 0
        assert generations.read(spark, lake).count() == 3
    # a name that ends like another one is a drop of its own
    _write(os.path.join(tmp_dir, "x/TA.csv"), "")
    skipped = []
    leg.bulk_pay(spark, [c, os.path.join(tmp_dir, "x/TA.csv")], skipped=skipped)
    assert skipped == [(os.path.join(tmp_dir, "x/TA.csv"), "empty")]


def test_two_writers_commit_one_after_the_other(spark, tmp_dir, monkeypatch):
    from paylens.sources import generations
    out, a, b = (os.path.join(tmp_dir, n) for n in ("lake", "TA_a.csv", "TA_b.csv"))
    _write(a, HEAD + "O;2024;Marzo;Ana;1\n")
    _write(b, HEAD + "O;2024;Marzo;Eva;2\n")
    publish, calls = generations._Folder.publish, []

    def slow(self, name, text):
        calls.append(name)
        if len(calls) == 1:  # another run commits first
            leg.ingest_bulk_csv(spark, [b], out, root=tmp_dir)
        return publish(self, name, text)

    monkeypatch.setattr(generations._Folder, "publish", slow)
    leg.ingest_bulk_csv(spark, [a], out, root=tmp_dir)
    assert [c[-6:-5] for c in calls] == ["1", "1", "2"]
    assert [r[2] for r in _held(spark, out)] == ["Ana", "Eva"]


# ---------------------------------------------------------- headers

def test_the_header_probe_reads_a_block_of_each_file(spark, tmp_dir, monkeypatch):
    root = os.path.join(tmp_dir, "big [x]%41 b")
    _write(f"{root}/2024_01.csv", "a;b\r\n" + "1;2\r\n" * 2_000_000)
    _write(f"{root}/2024_02.csv", "﻿a;b")
    _write(f"{root}/2024_03.csv", "\n1;2\n")
    _write(f"{root}/2024_04.csv", "x" * 200_000 + ";y\n1;2\n")
    found = readers.headers_of(spark, root)
    assert sorted((len(h), len(p)) for h, p in found.items()) == [(3, 2), (200_002, 1)]

    class Counted:
        def __init__(self, file):
            self.file, self.bytes = file, 0

        def read(self, n):
            block = self.file.read(n)
            self.bytes += len(block)
            return block

    with readers.open_file(f"file:{root}/2024_01.csv") as file:
        counted = Counted(file)
        assert readers.first_line(counted) == b"a;b" and counted.bytes == readers.HEADER_BLOCK
    # what Arrow cannot open is scanned by Spark, with the same result
    seen = readers.scanned(spark, [root], "UTF-8").filter("head is not null").collect()
    assert {r["path"][-6:] for r in seen} >= {"01.csv", "02.csv", "04.csv"}


def test_repeated_and_case_twin_headers(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    _write(f"{raw}/personal_planta/2019_07.csv", "Nombre,Cargo,Sueldo,Sueldo\nAna,Jefa,1,8\n")
    _write(f"{raw}/personal_planta/2019_08.csv", "Nombre,nombre,Mes,mes,Sueldo\nEva,x,1,2,3\n")
    _write(f"{raw}/personal_planta/2019_09.csv", "Nombre,Sueldo\nLuz,4\n")
    rows = sorted((r.Nombres, r.remuliquida_mensual, r.Mes) for r in leg.consolidate_chamber(spark, raw).collect())
    assert rows == [("ANA", 1, "Julio"), ("EVA", 3, "Agosto"), ("LUZ", 4, "Septiembre")]
    assert readers.apart(["a", "A", "a", "b", "a.1"]) == ["a", "A.1", "a.2", "b", "a.1.1"]


def test_expenses_without_a_name_list(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    _write(f"{raw}/gastos_operacionales/7_2024_03.csv", "Concepto,Monto,ID_Diputado\nOficina,$ 3.000,7\n")
    rows = [(r.llave_senador, r.gastos_operacionales, r.monto) for r in leg.read_chamber_expenses(spark, raw).collect()]
    assert rows == [(None, "Oficina", 3000)]
    _write(f"{raw}/diputados_dieta/2024_03.csv", "ID_Diputado,Nombre\n8,Rosa Paz\n")
    assert leg.read_chamber_expenses(spark, raw).first().llave_senador is None


def test_drifting_json_is_read_and_reported(spark):
    item = T.StructType([T.StructField("n", T.LongType()), T.StructField("name", T.StringType()),
                         T.StructField("x", T.DoubleType())])
    texts = ['{"data":{"data":[{"id":"1","attributes":{"n":1000.0,"name":"a","x":"1.5"}},{"id":"2","attributes":{"n":"?","x":null}}]}}',
             '{"data":[{"n":7,"name":5},{"n":[1],"name":{"a":1}},8,{"attributes":"none"}]}',
             '{"data":[]}', '{"data":{"other":1}}', '{"data":[{"n":1}', '{"data":[{"n":1,"n":2}]}', "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "file int, value string")
    checked = drift.checked_envelopes(docs, item)
    assert sorted(map(tuple, drift.good_items(checked).collect()), key=str) == [
        (0, 1000, "a", 1.5), (0, None, None, None), (1, 7, "5", None), (1, None, None, None)]
    bad = sorted((r["file"], r["path"], r["expected"], r["found"], r["value"]) for r in drift.quarantine(checked).collect()
                 if r["file"] != 7)
    assert bad == [
        (0, "$.data.data[1].attributes.n", "bigint", "STRING", "?"),
        (1, "$.data[1].n", "bigint", "ARRAY", "[1]"), (1, "$.data[1].name", "string", "OBJECT", '{"a":1}'),
        (1, "$.data[2]", "OBJECT", "BIGINT", "8"), (1, "$.data[3].attributes", "OBJECT", "STRING", "none"),
        (3, "$.data", "ARRAY", "OBJECT", texts[3]), (4, "$", "JSON", "no JSON", texts[4]),
        (5, "$", "JSON", "no JSON", texts[5]), (6, "$", "JSON", "no JSON", "")]
    assert drift.quarantine(checked).filter("file = 7").count() == 1
    assert drift.checked_envelopes(docs.limit(0), item).count() == 0


def _above_the_explode(df):
    """The optimized plan's steps on single items, as lines."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
    return lines[:next(k for k, line in enumerate(lines) if "Generate explode(coalesce" in line)]


def _pages_of_items(spark):
    item = T.StructType([T.StructField("n", T.LongType())])
    texts = ['{"data":{"data":[' + ",".join(f'{{"n":{k if k % 3 else "[]"}}}' for k in range(30)) + "]}}",
             '{"data":[' + ",".join(f'{{"attributes":{{"n":{k}}}}}' for k in range(20)) + "]}", "{"]
    return drift.checked_envelopes(spark.createDataFrame(list(enumerate(texts)), "page int, value string"), item)


def test_quarantine_reads_a_document_once_for_all_its_items(spark):
    bad = drift.quarantine(_pages_of_items(spark))
    # what is taken from a whole document stays below the explode, and no filter repeats an item's checks
    steps = _above_the_explode(bad)
    assert not any("ArrayType(VariantType" in line or "_doc" in line for line in steps)
    assert not any("Filter" in line and "variant" in line.lower() for line in steps)
    assert sorted(map(tuple, bad.collect())) == sorted(
        [(0, f"$.data.data[{k}].n", "bigint", "ARRAY", "[]") for k in range(0, 30, 3)] + [(2, "$", "JSON", "no JSON", "{")])
    # a column of the documents may have a report's name
    named = drift.quarantine(_pages_of_items(spark).withColumnRenamed("page", "path"))
    assert named.columns == ["path", "path", "expected", "found", "value"] and named.count() == 11


def test_good_items_read_a_document_once_for_all_its_items(spark):
    good = drift.good_items(_pages_of_items(spark))
    steps = _above_the_explode(good)
    assert not any("ArrayType(VariantType" in line or "_doc" in line for line in steps)
    assert sorted(map(tuple, good.collect()), key=str) == sorted(
        [(0, k if k % 3 else None) for k in range(30)] + [(1, k) for k in range(20)], key=str)


def test_good_items_parse_a_document_once(spark):
    good = drift.good_items(_pages_of_items(spark))
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    # no filter below the steps parses it again, and an item's kind needs no schema of all of it
    assert plan.count("parseJson") == 1
    assert plan.count("schemaOfVariant") == 1  # of the one field


def test_fields_of_any_name_and_type_are_found(spark):
    item = T.StructType([T.StructField("a`b", T.LongType()), T.StructField("it's", T.BooleanType()),
                         T.StructField("c.d", T.ArrayType(T.LongType())), T.StructField("N", T.StringType())])
    texts = ['{"data":[{"a`b":"1","it\'s":true,"c.d":[1,2],"n":"other"},{"a`b":null,"it\'s":[],"c.d":{"x":1},"N":5},null,[1]]}']
    checked = drift.checked_envelopes(spark.createDataFrame([(t,) for t in texts], "value string"), item)
    assert sorted(map(tuple, drift.good_items(checked).collect()), key=str) == [
        (1, True, [1, 2], None), (None, None, None, "5")]
    assert sorted(map(tuple, drift.quarantine(checked).collect())) == [
        ("$.data[1].c.d", "array<bigint>", "OBJECT", '{"x":1}'), ("$.data[1].it's", "boolean", "ARRAY", "[]"),
        ("$.data[2]", "OBJECT", "VOID", None), ("$.data[3]", "OBJECT", "ARRAY", "[1]")]


def test_keys_are_taken_from_each_path_once(spark, tmp_path):
    names = ["a b", "c%20d", "e+f", "ñandú", "g=h"]
    for k, name in enumerate(names):
        (tmp_path / name).mkdir()
        for month in (1, 12):
            _write(f"{tmp_path}/{name}/{k}_2024_{month:02d}.csv", f"Concepto,Monto\nx{k},{month}\nÑ,\n")
    _write(f"{tmp_path}/a b/99999999999_2024_01.csv", "Concepto,Monto\nlong,1\n")
    frames = readers.read_keyed_groups(spark, str(tmp_path), leg.ID_MONTH_FILE, ["id", "anyo", "Mes"])
    assert len(frames) == 1 and dict(frames[0].dtypes)["Mes"] == "int"
    assert sorted(map(tuple, frames[0].collect()), key=str) == sorted(
        [(f"x{k}", str(m), k, 2024, m) for k in range(len(names)) for m in (1, 12)]
        + [("Ñ", None, k, 2024, m) for k in range(len(names)) for m in (1, 12)] + [("long", "1", None, 2024, 1)], key=str)
    # no row is matched against the pattern: only the list of files is
    plan = frames[0]._jdf.queryExecution().optimizedPlan()
    assert "regexp_extract" not in "\n".join(
        line for line in plan.toString().split("\n") if "_p0" in line or "file_path" in line)
