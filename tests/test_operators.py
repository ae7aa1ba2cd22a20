"""Operators on small literal frames: the decisions of SURVEY section 1.4."""

import pytest
from pyspark.sql import functions as F

from paylens.operators import audits, catalogue, expenses, pages, search, summary, sync


def _pay(spark, rows):
    return spark.createDataFrame(rows, "nombre_completo string, organismo string, Origen string, "
                                       "anyo int, Mes string, sueldo_num bigint")


def test_multi_employment_counts_distinct_orgs(spark):
    df = _pay(spark, [("A", "o1", "Planta", 2024, "Enero", 10), ("A", "o2", "Contrata", 2024, "Enero", 5),
                      ("A", None, "Planta", 2024, "Enero", 1), ("B", "o1", "Planta", 2024, "Enero", 99),
                      ("B", "o1", "Planta", 2024, "Enero", 1), ("A", "o3", "Planta", 2024, "Marzo", 7)])
    got = audits.multi_employment(df, 2024, "Enero").collect()
    assert len(got) == 1
    r = got[0]
    assert (r.nombre_completo, r.num_empleos, r.sueldo_total) == ("A", 2, 16)
    assert r.lista_organismos == ["o1", "o2"] and r.tipos_contrato == ["Contrata", "Planta"]


def test_ranking_and_concentration(spark):
    df = spark.createDataFrame(
        [("o1", "X", f"P{i}", 2024, "Enero", 100 + i, "SOTO" if i < 3 else "LARRAIN", "c") for i in range(8)]
        + [("o1", "X", "N", 2024, "Enero", None, "LI", "c")],
        "organismo string, Origen string, nombre_completo string, anyo int, Mes string, "
        "sueldo_num bigint, Paterno string, cargo string")
    top = audits.pay_ranking(df, 2024, "Enero", limit=3).collect()
    assert [r.sueldo_num for r in top] == [107, 106, 105]
    conc = audits.surname_concentration(df, 2024, "Enero", min_count=3).collect()
    assert [(r.apellido, r.cantidad_personas) for r in conc] == [("LARRAIN", 5)]  # SOTO excluded, LI too short


def test_outliers_three_sigma(spark):
    rows = [("o", f"p{i}", "E", 500000 + i) for i in range(20)] + [("o", "big", "E", 3000000),
                                                                    ("o", "small", "F", 3000000)]
    df = spark.createDataFrame(rows, "organismo string, nombre string, estamento string, sueldo_num bigint")
    got = audits.pay_outliers(df).collect()
    assert [r.nombre for r in got] == ["big"]  # group F has too few rows for statistics
    assert str(got[0].veces_promedio) == "4.8" and got[0].promedio_estamento == 619057


def test_search_conditions(spark):
    df = spark.createDataFrame([("juan perez soto", 2020, "Marzo", "Org"), ("ana perez", 2021, "Abril", "Org")],
                               "search_vector string, anyo int, Mes string, organismo_nombre string")
    cols = ("search_vector",)
    assert search.search(df, person=" Pérez ", columns=cols).count() == 2
    assert search.search(df, person="PEREZ juan", columns=cols).count() == 1
    assert search.search(df, person="", years=(2021, 2021), columns=cols).count() == 1
    assert search.search(df, month="Todos", years=(None, 2020), columns=cols).count() == 2
    with pytest.raises(ValueError):
        search.search(df, years=("x", 2020), columns=cols)
    assert search.last_record(df, "   ", columns=cols).count() == 0


def test_last_record_orders_by_month_number(spark):
    df = spark.createDataFrame([("ana", 2021, "Abril", "A"), ("ana", 2021, "Diciembre", "B"),
                                ("ana", 2020, "Diciembre", "C")],
                               "search_vector string, anyo int, Mes string, organismo_nombre string")
    one = search.last_record(df, "Ana", columns=("organismo_nombre",)).collect()
    assert one[0].organismo_nombre == "B"
    many = search.last_records(df, "search_vector", columns=("organismo_nombre",)).collect()
    assert many[0].organismo_nombre == "B"


def test_profiles_and_flags(spark):
    df = spark.createDataFrame([("Ana ", "Soto", None, "o2", "c1"), ("Ana", "Soto", "", "o1", "c1"),
                                ("Eva", "Paz", "Lo", "o1", None)],
                               "Nombres string, Paterno string, Materno string, organismo_nombre string, cargo string")
    prof = {r.Nombres: r for r in search.profiles(df).collect()}
    assert prof["Ana"].organismo_nombre == "o1 | o2" and prof["Eva"].cargo == ""
    assert search.select_profile(df, {"Nombres": "Ana", "Paterno": "Soto"}).count() == 2
    assert not search.result_flags(df, limit=3).first().truncated  # all three rows are shown
    flags = search.result_flags(df, limit=2).first()
    assert (flags.n_profiles, flags.ambiguous, flags.truncated) == (2, True, True)


def test_histogram_edges(spark):
    df = spark.createDataFrame([(0,), (5,), (10,), (None,)], "x long")
    got = {r.bin: r.n for r in summary.histogram(df, "x", bins=2).collect()}
    assert got == {1: 1, 2: 2}  # the maximum falls in the last bin
    flat = spark.createDataFrame([(3,), (3,)], "x long")
    assert [(r.bin, r.n) for r in summary.histogram(flat, "x").collect()] == [(1, 2)]


def test_kpis_label_and_top_pay(spark):
    one = spark.createDataFrame([("A", "B", "c" * 120, 1500)],
                                "Nombres string, Paterno string, cargo string, remuliquida_mensual long")
    k = summary.kpis(one, "remuliquida_mensual").first()
    assert k.etiqueta_total == "Gasto Total (Mes)" and k.gasto_total_txt == "$ 1.500"
    t = summary.top_pay(one, "remuliquida_mensual").first()
    assert t["Cargo / Función"].endswith("...") and len(t["Cargo / Función"]) == 103 and t.Sueldo == "$ 1.500"


def test_display_table_order(spark):
    df = spark.createDataFrame([(1, "x", 2024, "Enero", 5)],
                               "zz int, search_vector string, anyo int, Mes string, remuliquida_mensual long")
    out = summary.display_table(summary.with_month_number(df))
    assert out.columns == ["anyo", "Mes", "remuliquida_mensual", "zz"]


def test_expense_breakdown_and_share(spark):
    keys = "anyo int, Mes int, llave_senador string"
    people = spark.createDataFrame([(2024, 3, "ANA"), (2024, 3, "NOBODY")], keys)
    a = spark.createDataFrame([(2024, 3, "ANA", "Luz", 10), (2024, 4, "ANA", "Luz", 99)],
                              keys + ", gastos_operacionales string, monto long")
    b = spark.createDataFrame([(2024, 3, "ANA", "Luz", 5), (2024, 3, "ANA", "Agua", 0)],
                              keys + ", gastos_operacionales string, monto long")
    bd = expenses.expense_breakdown(people, a, b)
    assert {r.Concepto: r.Monto for r in bd.collect()} == {"Luz": 15, "Agua": 0}
    share = {r.Concepto: r.share for r in expenses.expense_share(bd).collect()}
    assert share == {"Luz": 1.0}


def test_catalogue_with_global_row(spark):
    df = spark.createDataFrame([("P", 2023, "b"), ("P", 2024, "a"), ("C", 2022, None), (None, 2020, "z")],
                               "origen string, anyo int, organismo_nombre string")
    cat = {r.dataset: r for r in catalogue.build_catalogue(df).collect()}
    assert cat["P"].anios == [2024, 2023] and cat["P"].organismos == ["a", "b"]
    assert cat["Todas (Búsqueda Global)"].anios == [2024, 2023, 2022]
    miss = catalogue.available_years(catalogue.build_catalogue(df), "missing").first()
    assert miss.anios == catalogue.DEFAULT_YEARS


def test_pages_tables_links_headings(spark):
    html = ("<h2>Diputada Ana  Soto</h2><table><tr><th>A</th><th>B</th></tr><tr><td>1 &amp; 2</td>"
            "<td><b>x</b></td></tr></table><table><tr><td>other</td></tr></table>"
            '<a href="detalle/mociones.aspx?prmID=12">Ana</a><a href="detalle/mociones.aspx?prmID=12">Ana</a>'
            '<a href="x">  </a>')
    df = spark.createDataFrame([(1, html), (2, "<p>no table</p>")], "page_id long, html string")
    rows = pages.table_rows(df).orderBy("row_no").collect()
    assert [r.cells for r in rows] == [["A", "B"], ["1 & 2", "x"]]
    links = pages.links(df, href_pattern=r"prmID=(\d+)").collect()
    assert [(r.link_id, r.text) for r in links] == [("12", "Ana")]
    heads = {r.page_id: r.title for r in pages.heading(df, tag="h2").collect()}
    assert heads == {1: "Ana  Soto", 2: ""}


TIDY = "<table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table>"


@pytest.mark.parametrize("html,rows", [
    (TIDY, [["a", "b"], ["c"]]),
    ("<table><tr><td>a<td>b<tr><td>c", [["a", "b"], ["c"]]),
    ("<TABLE><TBODY><TR ><TH>a<TH\n>b</TR><TR><TD/>c</TABLE> tail", [["a", "b"], ["c"]]),
    ("<table>x<td>a<td>b<tr>y<td>c</tr>z</table>", [["a", "b"], ["c"]]),
    ("<table><tr><td>a</td>junk<td>b</tr><td>c</table>", [["a", "b"], ["c"]]),
    ("<!-- <table><tr><td>no</td></tr></table> -->" + TIDY, [["a", "b"], ["c"]]),
    ("<script>'<table><tr><td>no'</script></table></td>" + TIDY, [["a", "b"], ["c"]]),
    ("<table><tr><td>a<td>b</tr><!-- <tr><td>no --><tr><td>c</table><table><tr><td>d", [["a", "b"], ["c"]]),
    ("<table><tr><td>a <table><tr><td>in<td>ner</table> z<td>b", [["a    in ner  z", "b"]]),
    ("<table><tr></tr><tr><td></td></tr></table>", [[], [""]]),
    ("<table><tr><td colspan=2>a<td colspan='0'>b<th COLSPAN = \"3\">c", [["a", "a", "b", "c", "c", "c"]]),
    ("<table><tr><td>&aacute;&#225;&#xE1; &amp;lt; &nbsp;&nope; &#128512; &#0; &copy", [["ááá &lt;  &nope; 😀 &#0; &copy"]]),
    ("<tablet><tr><td>no</tablet>", []), ("<p>none", []), ("", []), (None, []),
])
def test_lenient_tables(spark, html, rows):
    df = spark.createDataFrame([(1, html), (1, TIDY)], "page_id long, html string")
    found = pages.table_rows(df.limit(1)).orderBy("row_no").collect()
    assert [r.cells for r in found] == rows
    assert [r.row_no for r in found] == list(range(len(rows)))


def test_tables_of_a_large_page_and_of_repeated_keys(spark):
    many = "<table>" + "".join(f"<tr><td>{k}<td>x" for k in range(20_000)) + "</table>" + TIDY * 500
    df = spark.createDataFrame([(1, many), (2, TIDY), (2, TIDY)], "page_id long, html string")
    rows = pages.table_rows(df, first_table_only=False)
    assert rows.filter("page_id = 1").count() == 21_000 and rows.filter("page_id = 2").count() == 4
    assert rows.filter("page_id = 1 and table_no = 0").agg({"row_no": "max"}).first()[0] == 19_999
    assert rows.agg({"table_no": "max"}).first()[0] == 500


def test_coverage_gaps(spark):
    present = spark.createDataFrame([("s", 2024, 1), ("s", 2024, 3)], "source string, anyo int, mes int")
    gaps = sync.coverage_gaps(present, present, (2024, 2024)).collect()
    assert sorted(r.mes for r in gaps) == [2] + list(range(4, 13))


def test_footprint_long_to_wide(spark):
    k = "llave string, anyo int, mes int, amount long"
    parts = {"pagos": spark.createDataFrame([("a", 2024, 1, 5), ("a", 2024, 1, 5)], k),
             "vuelos": spark.createDataFrame([("a", 2024, 2, 7)], k)}
    got = {(r.anyo, r.mes): (r.pagos, r.vuelos, r.total)
           for r in expenses.footprint(parts, ["llave", "anyo", "mes"]).collect()}
    assert got == {(2024, 1): (10, 0, 10), (2024, 2): (0, 7, 7)}


def test_folded_link_blank_names_never_link(spark):
    from paylens.operators.joins import folded_link
    left = spark.createDataFrame([(1, "José Pérez"), (2, "  "), (3, None), (4, "Nadie")], "id int, n string")
    right = spark.createDataFrame([(10, "JOSE PEREZ"), (11, ""), (12, None)], "rid int, m string")
    got = {r.id: (r.rid, r._name_key) for r in folded_link(left, right, "n", "m").collect()}
    assert got == {1: (10, "jose perez"), 2: (None, None), 3: (None, None), 4: (None, "nadie")}
    inner = folded_link(left, right, "n", "m", how="inner").collect()
    assert [(r.id, r.rid) for r in inner] == [(1, 10)]


def test_legislative_source_predicate(spark):
    from paylens.functions.text import legislative
    df = spark.createDataFrame([("Senado", "x"), ("Planta", "CÁMARA de Diputados"), ("Planta", "Min")],
                               "origen string, organismo_nombre string")
    got = [r.l for r in df.select(legislative(F.col("origen"), F.col("organismo_nombre")).alias("l")).collect()]
    assert got == [True, True, False]


def test_surname_concentration_fold_option(spark):
    rows = [("o", s, 1) for s in ["GONZÁLEZ"] * 6 + [" Gonzalez "] * 2 + ["Peña"] * 5 + ["PENA"]]
    df = spark.createDataFrame(rows, "organismo string, Paterno string, sueldo_num long")
    plain = {r.apellido: r.cantidad_personas for r in audits.surname_concentration(df, min_count=1).collect()}
    assert plain == {"GONZÁLEZ": 6, " GONZALEZ ": 2, "PEÑA": 5, "PENA": 1}  # published behaviour
    folded = {r.apellido: r.cantidad_personas
              for r in audits.surname_concentration(df, min_count=1, fold=True).collect()}
    assert folded == {"PENA": 6}


def test_defaults_columns_and_dates(spark):
    from paylens.operators import unify
    df = spark.createDataFrame([("Ana", None)], "Nombres string, cargo string")
    out = unify.with_defaults(df, {"cargo": "Funcionario/a", "remuliquida_mensual": 0}).first()
    assert out.cargo == "Funcionario/a" and out.remuliquida_mensual == 0
    cols = ["Nombre Completo", "Función", "Remuneración Bruta", "Diputada a cargo"]
    assert unify.find_column(cols, "nombre") == "Nombre Completo"
    assert unify.find_column(cols, "cargo", "función") == "Función"
    assert unify.find_column(cols, regex=r"(?i)diputad") == "Diputada a cargo"
    assert unify.find_column(cols, "sueldo") is None
    dates = spark.createDataFrame([("Wed, 21 Oct 2015 07:28:00 GMT",), ("garbage",), (None,)], "d string")
    got = [r.t for r in dates.select(sync.parse_http_date(F.col("d")).alias("t")).collect()]
    assert got[0] is not None and got[1] is None and got[2] is None


def test_audits_accept_text_years_with_junk(spark):
    view = spark.createDataFrame(
        [("Planta", "Ana", "Soto", None, "2024", "Enero", "Org", "$ 1.000", "E", "c"),
         ("Planta", "Eva", "Paz", "Lo", "texto", "Enero", "Org", "2.000", "E", "c"),
         ("Contrata", "Ana", "Soto", None, "2024", "Enero", "Otra", "500", "E", "c")],
        "Origen string, Nombres string, Paterno string, Materno string, anyo string, Mes string, "
        "organismo string, sueldo string, estamento string, cargo string")
    rows = audits.audit_rows(view)
    multi = audits.multi_employment(rows, 2024, "Enero").collect()
    assert [(r.nombre_completo, r.num_empleos, r.sueldo_total) for r in multi] == [("ANA SOTO ", 2, 1500)]
    # a text year column is compared through a strict cast: junk is no match
    raw = view.withColumn("sueldo_num", F.lit(1)).withColumn("nombre_completo", F.col("Nombres"))
    assert audits.pay_ranking(raw, 2024, "Enero").count() == 2


def test_word_index_equals_a_scan(spark, tmp_path):
    from paylens.operators import search, word_index

    names = ["jose perez soto", "maria jose  tapia", "", None, "perez\nperez", "ana  perezosa jose", "soto", " "]
    rows = spark.createDataFrame([(k, n, k % 3) for k, n in enumerate(names * 3)], "id int, search_vector string, word int")
    path = str(tmp_path / "index")
    word_index.write_word_index(rows, "id", "search_vector", path, buckets=4)
    for person in ("José Pérez", "perez", "ere jos jos", "nobody", "soto nobody", "z", "", None):
        scan = search.search(rows, person=person, columns=("id", "word"), order=("id",), limit=None)
        found = word_index.indexed_search(rows, "id", path, person, columns=("id", "word"), order=("id",), limit=None)
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, scan.collect())), person
    limited = word_index.indexed_search(rows, "id", path, "perez", columns=("id",), order=("id",), limit=2)
    assert [r["id"] for r in limited.collect()] == [0, 4]
    plan = word_index.indexed_keys(spark, path, "soto")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    word_index.write_word_index(rows.limit(0), "id", "search_vector", path + "0", buckets=4)
    nothing = word_index.indexed_search(rows, "id", path + "0", "perez", columns=("id",), order=("id",))
    assert nothing.count() == 0
