"""Driver queries: every library operator run over the driver's tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame; the
matching DuckDB SQL lives in :mod:`paylens.plans.oracle` under the same
name and produces the same column names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.functions import money as mny
from paylens.functions import months as mon
from paylens.functions import text as txt
from paylens.functions.text import fold_text, unaccent_lower
from paylens.operators import audits
from paylens.operators import catalogue as cat
from paylens.operators import expenses as exp
from paylens.operators import legislative as leg
from paylens.operators import pages as pg
from paylens.operators import partials as prt
from paylens.operators import search as srch
from paylens.operators import summary as summ
from paylens.operators import sync as syn
from paylens.operators import unify as uni
from paylens.operators import word_index as widx
from paylens.operators.joins import folded_link, spread_folded_link
from paylens.plans import views
from paylens.session import scratch_path, spread_narrow, table
from paylens.sources import drift, generations
from paylens.sources import readers as rd
from paylens.sources import sinks as sk
from paylens.streaming.file_ingest import ingest_mixed_drops, ingest_new_files

REGISTRY: dict = {}


def register(name: str):
    def wrap(fn):
        REGISTRY[name] = fn
        return fn
    return wrap


def _join_list(c: str) -> F.Column:
    return F.array_join(F.col(c).cast("array<string>"), ",")


# ---------------------------------------------------------------- audits

@register("multi_employment")
def multi_employment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.lineitem_jobs(spark, sf_dir, 1998, 3)
    out = audits.multi_employment(rows, 1998, "Marzo")
    return out.withColumns({"lista_organismos": _join_list("lista_organismos"),
                            "tipos_contrato": _join_list("tipos_contrato")})


@register("pay_ranking")
def pay_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.order_pay(spark, sf_dir, 1998, 3)
    return audits.pay_ranking(rows, 1998, "Marzo",
                              tie=("nombre_completo", "organismo", "Origen", "cargo"))


@register("surname_concentration")
def surname_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.surname_concentration(views.part_staff(spark, sf_dir), min_count=5)


@register("pay_outliers")
def pay_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.pay_outliers(views.event_pay(spark, sf_dir), stats_floor=0, result_floor=0)


@register("pay_outliers_documents")
def pay_outliers_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audits.pay_outliers(views.document_pay(spark, sf_dir), stats_floor=0, result_floor=0)


# ---------------------------------------------------------------- search


def text_table(spark, sf_dir, name):
    """A table whose rows carry whole texts: folds and regexes over them are
    CPU-bound, so a narrow scan is spread over the cores first."""
    return spread_narrow(table(spark, sf_dir, name))


@register("person_search")
def person_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search words in whole texts: the fold is a plain column, and several
    words read it once (not bound in a lambda, so the filter stays compiled)."""
    docs = text_table(spark, sf_dir, "documents").withColumn("search_vector", fold_text(F.col("text")))
    return srch.search(docs, person="des ELLE", columns=("doc_id", "lang", "source", "n_chars"),
                       org_col="lang", order=("doc_id",))


@register("indexed_search")
def indexed_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search of person_search through a word index: written once, then read
    by the buckets of its words."""
    docs = text_table(spark, sf_dir, "documents")
    path = scratch_path(spark, "word_index")
    widx.write_word_index(docs, "doc_id", fold_text(F.col("text")), path, buckets=32)
    return widx.indexed_search(table(spark, sf_dir, "documents"), "doc_id", path, "des ELLE",
                               columns=("doc_id", "lang", "source", "n_chars"), order=("doc_id",))


@register("search_filters")
def search_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.order_rows(spark, sf_dir)
    return srch.search(rows, organization="1-URGENT", years=(1996, 1997), month="Marzo",
                       columns=("o_orderkey", "organismo_nombre", "anyo", "Mes", "origen",
                                "remuliquida_mensual"), order=("o_orderkey",))


@register("accent_fold")
def accent_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text_table(spark, sf_dir, "documents")
    return docs.select("doc_id", unaccent_lower(F.col("text")).alias("folded"))


# Characters that fold to other letters, to several, or to none.
FOLD_SAMPLES = "ﬁ½㎏⑩№Ⅷ𝐀𝟗ßŁ日ñ"


@register("accent_fold_special")
def accent_fold_special(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with ligatures, fractions, units and letters above U+FFFF."""
    c = table(spark, sf_dir, "customer")
    mixed = F.translate("c_name", "0123456789", FOLD_SAMPLES[2:])
    return c.select("c_custkey", fold_text(F.concat(mixed, F.lit(FOLD_SAMPLES))).alias("folded"))


@register("accent_fold_full")
def accent_fold_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = text_table(spark, sf_dir, "documents")
    return docs.select("doc_id", fold_text(F.col("text")).alias("folded"))


def _named_orders(spark, sf_dir):
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), fold_text(F.col("c_name"), strip=True).alias("search_vector"))
    return views.order_rows(spark, sf_dir).join(cust, "o_custkey")


@register("last_record")
def last_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return srch.last_record(_named_orders(spark, sf_dir), "Customer#000000007",
                            tie=("o_orderdate", "o_orderkey"))


@register("last_record_per_person")
def last_record_per_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    return srch.last_records(views.order_rows(spark, sf_dir), "o_custkey",
                             tie=("o_orderdate", "o_orderkey"))


@register("profiles")
def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return srch.profiles(views.part_people(spark, sf_dir))


@register("profile_select")
def profile_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = {"Nombres": "small", "Paterno": "ring", "Materno": None}
    return srch.select_profile(views.part_people(spark, sf_dir), chosen)


@register("profile_flags")
def profile_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return srch.result_flags(views.part_people(spark, sf_dir), limit=500)


# ---------------------------------------------------------------- summary

@register("kpis")
def kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.order_rows(spark, sf_dir)
    return summ.kpis(rows, "remuliquida_mensual").withColumn("promedio", F.round("promedio", 2))


@register("chronological_table")
def chronological_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.order_rows(spark, sf_dir).drop("o_orderdate", "o_custkey")
    return summ.display_table(summ.chronological(rows))


@register("pay_histogram")
def pay_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.order_rows(spark, sf_dir)
    return summ.histogram(rows, "remuliquida_mensual", bins=20)


@register("top_pay")
def top_pay(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    rows = c.select(F.col("c_name").alias("Nombres"), F.col("c_mktsegment").alias("Paterno"),
                    F.repeat(F.concat(F.col("c_mktsegment"), F.lit(" ")), 12).alias("cargo"),
                    mny.to_cents(F.col("c_acctbal")).alias("remuliquida_mensual"))
    return summ.top_pay(rows, "remuliquida_mensual", 10)


# ---------------------------------------------------------------- expenses

def _breakdown(spark, sf_dir):
    lines = views.line_expenses(spark, sf_dir)
    open_src = lines.filter(F.col("l_linestatus") == "O").drop("l_linestatus")
    done_src = lines.filter(F.col("l_linestatus") == "F").drop("l_linestatus")
    return open_src, done_src


@register("expense_breakdown")
def expense_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = views.order_rows(spark, sf_dir).filter(
        (F.col("organismo_nombre") == "1-URGENT") & (F.col("anyo") == 1996))
    people = o.select("anyo", F.month("o_orderdate").alias("Mes"),
                      F.col("o_custkey").alias("llave_senador"))
    return exp.expense_breakdown(people, *_breakdown(spark, sf_dir))


@register("expense_share")
def expense_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    open_src, done_src = _breakdown(spark, sf_dir)
    both = open_src.unionByName(done_src)
    per = both.groupBy(F.col("gastos_operacionales").alias("Concepto")).agg(F.sum("monto").alias("Monto"))
    return exp.expense_share(per)


# ---------------------------------------------------------------- catalogue

def _catalogue(spark, sf_dir):
    rows = views.order_rows(spark, sf_dir).select(
        F.col("organismo_nombre").alias("origen"), "anyo",
        F.col("origen").alias("organismo_nombre"))
    return cat.build_catalogue(rows)


@register("catalogue")
def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalogue(spark, sf_dir).withColumns({"anios": _join_list("anios"),
                                                 "organismos": _join_list("organismos")})


@register("catalogue_lookup")
def catalogue_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10 then S11: the catalogue is written once, lookups read the copy."""
    out = scratch_path(spark, "catalogue")
    sk.write_catalogue(_catalogue(spark, sf_dir), out)
    c = spark.read.schema("dataset string, anios array<int>, organismos array<string>").json(out)
    years = cat.available_years(c, "3-MEDIUM").unionByName(cat.available_years(c, "missing"))
    return cat.year_bounds(years).join(
        cat.organizations(c, "3-MEDIUM").unionByName(cat.organizations(c, "missing"))
        .select("dataset", F.size("organismos").alias("n_orgs")), "dataset")


# ---------------------------------------------------------------- money, text, months


def _order_money(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    cents = mny.to_cents(F.col("o_totalprice"))
    return o.select("o_orderkey", "o_orderstatus", cents.alias("cents"),
                    views.money_text(cents).alias("texto"))


@register("money_clean")
def money_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _order_money(spark, sf_dir)
    return t.select("o_orderkey", "texto", mny.clean_money(F.col("texto")).alias("x1"),
                    mny.clean_money(F.translate("texto", ".,", ",.")).alias("x1_swapped"))


@register("money_digits")
def money_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _order_money(spark, sf_dir)
    maybe = F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("texto"))
    return t.select("o_orderkey", mny.digits_money(F.col("texto")).alias("x2"),
                    mny.digits_money_or_zero(maybe).alias("x3"))


@register("money_format_roundtrip")
def money_format_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _order_money(spark, sf_dir).withColumn("fmt", mny.format_clp(F.col("cents")))
    back = mny.clean_money(F.col("fmt"))
    return t.select("o_orderkey", "fmt", back.alias("back"), (back == F.col("cents")).alias("ok"))


def _raw_sources(spark, sf_dir):
    """supplier and customer dressed as two differently headed pay drops."""
    s = table(spark, sf_dir, "supplier")
    c = table(spark, sf_dir, "customer")
    s_raw = s.select(
        F.col("s_nationkey").cast("string").alias("Institucion"),
        (F.lit(1990) + F.col("s_nationkey")).cast("string").alias("Año"),
        mon.month_name(F.col("s_nationkey") % 12 + 1).alias("mes"),
        F.col("s_name").alias("Nombre"),
        F.lit("Proveedor").alias("Tipo Estamento"),
        views.money_text(mny.to_cents(F.col("s_acctbal"))).alias("Sueldo Liquido"))
    c_raw = c.select(
        F.col("c_mktsegment").alias("organismo_nombre"),
        (F.lit(2000) + F.col("c_nationkey")).cast("string").alias("anyo"),
        mon.month_name(F.col("c_nationkey") % 12 + 1).alias("Mes"),
        F.col("c_name").alias("nombres"),
        F.translate(F.col("c_mktsegment"), "AEIOU", "ÁÉÍÓÚ").alias("paterno"),
        F.col("c_mktsegment").alias("Cargo"),
        views.money_text(mny.to_cents(F.col("c_acctbal"))).alias("remuliquida_mensual"),
        views.money_text(mny.to_cents(F.col("c_acctbal")) * 2).alias("Sueldo Bruto"))
    return s_raw, c_raw


@register("schema_unify")
def schema_unify(spark: SparkSession, sf_dir: str) -> DataFrame:
    s_raw, c_raw = _raw_sources(spark, sf_dir)
    return uni.pay_rows(s_raw, "Planta").unionByName(uni.pay_rows(c_raw, "Contrata"))


@register("audit_view")
def audit_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    s_raw, c_raw = _raw_sources(spark, sf_dir)
    return uni.audit_view([("Planta", s_raw), ("Contrata", c_raw)])


@register("ragged_concat")
def ragged_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    c = table(spark, sf_dir, "customer")
    support = s.select(
        F.when(F.col("s_acctbal") < 0, F.lit("  ")).otherwise(F.col("s_name")).alias("Nombre"),
        F.when(F.col("s_nationkey") < 5, F.lit(None)).otherwise(F.lit("Asesor legislativo")).alias("Cargo"),
        views.money_text(mny.to_cents(F.col("s_acctbal"))).alias("Sueldo"),
        F.concat(F.lit("Diputado "), F.col("s_nationkey").cast("string")).alias("Diputado/a"),
        F.lit("supplier").alias("fuente"))
    others = c.select(F.col("c_name").alias("Nombre"),
                      views.money_text(mny.to_cents(F.col("c_acctbal"))).alias("Sueldo"),
                      F.lit("customer").alias("fuente"))
    both = uni.ragged_concat([support, others])
    boss = uni.find_column(both.columns, regex=r"(?i)diputad")
    out = both.select(
        F.upper(F.col("Nombre")).alias("Nombres"),
        uni.role_of(F.col("Cargo"), F.col(f"`{boss}`")).alias("cargo"),
        mny.digits_money_or_zero(F.col("Sueldo")).alias("remuliquida_mensual"), "fuente")
    return out.filter(uni.non_blank(F.col("Nombres")))


@register("column_layout")
def column_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    messy = c.toDF(" c_custkey", "c_name\n", "c_nation\nkey ", "c_acctbal", " c_mkt\nsegment")
    clean = uni.clean_headers(messy)
    return uni.ordered_columns(clean, ("c_mkt segment", "c_name", "missing"), hidden=("c_nation key",))


@register("month_lookup")
def month_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.month("o_orderdate").alias("m"))
    name = mon.month_name(F.col("m"))
    return o.select(
        "o_orderkey", "m", name.alias("nombre"),
        mon.month_name(F.col("m") + 6, default="Enero").alias("nombre_mas_6"),
        mon.month_number(F.upper(name)).alias("de_vuelta"),
        mon.month_number(F.concat(name, F.lit("x")), default=0).alias("desconocido"))


def _name_parts(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    words = F.split(F.col("p_name"), " ")
    return p.select(
        "p_partkey",
        F.element_at(words, 1).alias("a"),
        F.when(F.col("p_size") < 10, F.lit("  "))
         .otherwise(F.concat(F.lit(" "), F.element_at(words, 2), F.lit(" "))).alias("b"),
        F.when(F.col("p_size") > 40, F.concat(F.col("p_brand"), F.lit("  x")))
         .otherwise(F.lit(None)).alias("c"))


@register("person_key")
def person_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _name_parts(spark, sf_dir)
    return t.select("p_partkey", txt.person_key(F.col("a"), F.col("b"), F.col("c")).alias("llave"))


@register("audit_full_name")
def audit_full_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _name_parts(spark, sf_dir)
    return t.select("p_partkey",
                    txt.audit_full_name(F.col("a"), F.col("b"), F.col("c")).alias("nombre_completo"))


# ---------------------------------------------------------------- joins

@register("pay_with_expenses")
def pay_with_expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer is paid in one month; most spent nothing in it."""
    c = table(spark, sf_dir, "customer")
    pay = c.select((F.col("c_custkey") % 7 + 1992).cast("int").alias("ano"),
                   (F.col("c_custkey") % 12 + 1).cast("int").alias("mes"),
                   F.col("c_custkey").alias("llave_senador"),
                   mny.to_cents(F.col("c_acctbal")).alias("dieta"))
    o = table(spark, sf_dir, "orders")
    spent = o.select(F.year("o_orderdate").alias("ano"), F.month("o_orderdate").alias("mes"),
                     F.col("o_custkey").alias("llave_senador"),
                     mny.to_cents(F.col("o_totalprice")).alias("monto"))
    return exp.pay_with_expenses(pay, spent, ["ano", "mes", "llave_senador"])


@register("id_name_lookup")
def id_name_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "user_id")
    names = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.upper("c_name").alias("llave_senador"))
    latest = exp.latest_names(names, key="user_id", name="llave_senador", order=("user_id",))
    return exp.attach_names(ev, latest, key="user_id", bound_by=names)


@register("folded_name_link")
def folded_name_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("user_id").distinct()
    cust = table(spark, sf_dir, "customer")
    users = ev.join(cust.select(F.col("c_custkey").alias("user_id"), "c_name"), "user_id")
    accented = cust.select(F.col("c_custkey").alias("linked_custkey"),
                           F.translate(F.upper("c_name"), "AEIOU", "ÁÉÍÓÚ").alias("nombre_acentuado"))
    linked = folded_link(users, accented, "c_name", "nombre_acentuado", how="left")
    return linked.select("user_id", "c_name", "nombre_acentuado", "linked_custkey")


@register("folded_link_hot_name")
def folded_link_hot_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders linked to customers by name; half of the orders bear one name,
    which two customers have, and some a blank one (J7)."""
    status = F.col("o_orderstatus")
    who = (F.when(status == "F", "José Núñez").when(status == "P", " ")
           .otherwise(F.concat(F.lit("Cliente "), F.col("o_custkey").cast("string"))))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", who.alias("who"))
    name = F.when(F.col("c_custkey") <= 2, "JOSE NUÑEZ").otherwise(F.concat(F.lit("CLIENTE "), F.col("c_custkey").cast("string")))
    customers = table(spark, sf_dir, "customer").select("c_custkey", name.alias("nombre"))
    return spread_folded_link(orders, customers, "who", "nombre").select("o_orderkey", "who", "c_custkey", "nombre")


@register("footprint")
def footprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    keyed = o.select("o_orderkey", F.col("o_custkey").alias("llave"),
                     F.year("o_orderdate").alias("anyo"), F.month("o_orderdate").alias("mes"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_extendedprice", "l_tax")
    lines = li.join(keyed, li.l_orderkey == keyed.o_orderkey)
    keys = ["llave", "anyo", "mes"]
    parts = {
        "pagos": o.select(F.col("o_custkey").alias("llave"), F.year("o_orderdate").alias("anyo"),
                          F.month("o_orderdate").alias("mes"),
                          mny.to_cents(F.col("o_totalprice")).alias("amount")),
        "gastos": lines.filter(F.col("l_returnflag") == "R").select(
            *keys, mny.to_cents(F.col("l_extendedprice")).alias("amount")),
        "viaticos": lines.select(*keys, mny.to_cents(F.col("l_extendedprice") * F.col("l_tax")).alias("amount")),
    }
    return exp.footprint(parts, keys)


# ---------------------------------------------------------------- pages, gaps, manifests


@register("page_links")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.links(text_table(spark, sf_dir, "pages"))


@register("page_title")
def page_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.heading(text_table(spark, sf_dir, "pages"), tag="h1")


@register("page_table_rows")
def page_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pg.table_rows(text_table(spark, sf_dir, "pages"), table_tag="ul", row_tag="li", cell_tag="a")
    return rows.withColumn("cells", F.array_join("cells", "|"))


@register("page_nested_tables")
def page_nested_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' lists as a real <table>, each second row with a table of its
    own in a cell: the outer rows come back, the inner text as a cell's (R1)."""
    pages = text_table(spark, sf_dir, "pages")
    items = F.regexp_extract_all("html", F.lit(r"(?s)<li>(.*?)</li>"), 1)
    inner = "<table><tr><td>in</td></tr></table>"
    rows = F.transform(items, lambda x, i: F.concat(
        F.lit("<tr class='r'><td>"), x, F.lit("</td><TD>"), F.when(i % 2 == 1, F.lit(inner)).otherwise(F.lit("-")),
        F.lit("</TD></tr>")))
    html = F.concat(F.lit("<p>x</p><TABLE border=1>"), F.array_join(rows, "\n"), F.lit("</TABLE><table><tr><td>2</td></tr></table>"))
    out = pg.table_rows(pages.select("page_id", html.alias("html")))
    return out.withColumn("cells", F.array_join("cells", "|"))


@register("page_lenient_tables")
def page_lenient_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' lists as a table without a single end tag, behind tables in a
    comment and a script, with entities and a cell over two columns (R1)."""
    pages = text_table(spark, sf_dir, "pages")
    items = F.regexp_extract_all("html", F.lit(r"(?s)<li>(.*?)</li>"), 1)
    rows = F.transform(items, lambda x, i: F.concat(F.lit("<TR class=r>\n<td>"), x, F.lit("<td colspan='2'>&Aacute;&#241;&#xf3; &amp;lt; &no;"),
                                                    F.when(i % 2 == 1, F.lit("<table><tr><td>in</table>")).otherwise(F.lit(""))))
    hidden = "<!-- <table><tr><td>old</td></tr></table> --><script>x = '<table><tr><td>js</table>'</script></table>"
    html = F.concat(F.lit(f"{hidden}<table>"), F.array_join(rows, "\n"))
    out = pg.table_rows(pages.select("page_id", html.alias("html")))
    return out.withColumn("cells", F.array_join("cells", "|"))


@register("coverage_gaps")
def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("source"), F.year("o_orderdate").alias("anyo"),
        F.month("o_orderdate").alias("mes"))
    return syn.coverage_gaps(o, o, (1995, 2002))


def _manifests(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    day = F.regexp_extract("source", r"(\d+)", 1).cast("int") + 1
    stamp = F.make_timestamp_ntz(F.lit(2024), F.lit(2), day, F.lit(8), F.lit(30), F.lit(0))
    remote = d.filter(F.col("lang") != "de").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("name"),
        F.when(F.col("n_chars") < 50, F.lit(0)).otherwise(
            F.col("n_chars") + F.when(F.col("lang") == "fr", 1).otherwise(0)).alias("size"),
        F.concat(F.date_format(stamp, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")).alias("last_modified"))
    local = d.filter(F.col("lang") != "es").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("name"),
        F.col("n_chars").alias("size"),
        F.make_timestamp(F.lit(2024), F.lit(2), F.lit(10), F.lit(0), F.lit(0), F.lit(0),
                         F.lit("UTC")).alias("last_modified"))
    return local, remote


@register("manifest_diff")
def manifest_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    local, remote = _manifests(spark, sf_dir)
    return syn.manifest_diff(local, remote)


# ---------------------------------------------------------------- files in and out
#
# These write derived copies of the test tables into the shared folder
# (``spark.checkpoint.dir``), then read them back through the library's
# readers, so the sources and sinks run end to end over whole tables.


EVENT_ITEM = T.StructType([T.StructField("event_id", T.LongType()),
                           T.StructField("user_id", T.LongType()),
                           T.StructField("event_type", T.StringType()),
                           T.StructField("value", T.DoubleType())])


@register("json_envelope")
def json_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> paged JSON documents (both envelope shapes, at most 500
    items each: ids are unique, so a page of 500 consecutive ids is bounded
    whatever the event mix; a document per line) -> parsed back into items.
    A third of the pages writes user ids as 12.0, a third as quoted text."""
    ev = table(spark, sf_dir, "events")
    page = F.floor(F.col("event_id") / 500)
    fields = [f.name for f in EVENT_ITEM.fields]

    def items(user):
        return F.transform("items", lambda i: F.struct(*[
            (user(i[n]) if n == "user_id" else i[n]).alias(n) for n in fields]))

    def shapes(user):
        body = items(user)
        wrapped = F.transform(body, lambda i: F.struct(i["event_id"].alias("id"), i.alias("attributes")))
        paged = F.to_json(F.struct(F.struct(wrapped.alias("data"), F.struct(F.struct(F.size(wrapped).alias("total"))
                                                                            .alias("pagination")).alias("meta")).alias("data")))
        return F.when(F.col("page") % 2 == 0, paged).otherwise(F.to_json(F.struct(body.alias("data"))))

    docs = ev.groupBy(page.alias("page")).agg(F.collect_list(F.struct(*fields)).alias("items"))
    text = (F.when(F.col("page") % 3 == 0, shapes(lambda u: u)).when(F.col("page") % 3 == 1, shapes(lambda u: u.cast("double")))
            .otherwise(shapes(lambda u: u.cast("string"))))
    out = scratch_path(spark, "envelopes")
    docs.select(text.alias("value")).write.text(out)
    return rd.read_envelopes(spark, f"{out}/*.txt", EVENT_ITEM).drop("source_file")


def _drifting_pages(spark, sf_dir):
    """events as pages of 500 in both shapes, with drift: every seventh user id
    is an object, every eleventh value a text; of five pages one has no list of
    items and one is cut off."""
    ev = table(spark, sf_dir, "events")

    def number(c):
        return F.coalesce(F.col(c).cast("string"), F.lit("null"))

    text = F.format_string(
        '{"event_id":%s,"user_id":%s,"event_type":%s,"value":%s}', number("event_id"),
        F.when(F.col("event_id") % 7 == 0, F.format_string('{"id":%s}', number("user_id"))).otherwise(number("user_id")),
        F.coalesce(F.concat(F.lit('"'), F.col("event_type"), F.lit('"')), F.lit("null")),
        F.when(F.col("event_id") % 11 == 0, F.lit('"n/a"')).otherwise(number("value")))
    wrapped = F.when(F.floor(F.col("event_id") / 500) % 2 == 0,
                     F.format_string('{"id":%s,"attributes":%s}', number("event_id"), text)).otherwise(text)
    pages = (ev.groupBy(F.floor(F.col("event_id") / 500).alias("page"))
             .agg(F.sort_array(F.collect_list(F.struct("event_id", wrapped.alias("text")))).alias("items")))
    body = F.concat(F.lit("["), F.array_join("items.text", ","), F.lit("]"))
    whole = F.when(F.col("page") % 2 == 0, F.format_string('{"data":{"data":%s}}', body)).otherwise(
        F.format_string('{"data":%s}', body))
    return pages.select("page", F.when(F.col("page") % 5 == 3, F.lit('{"error":"no data"}'))
                        .when(F.col("page") % 5 == 4, F.left(whole, F.length(whole) - 2)).otherwise(whole).alias("value"))


@register("json_drift")
def json_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of drifting documents; a drifting field is NULL."""
    return drift.good_items(drift.checked_envelopes(_drifting_pages(spark, sf_dir), EVENT_ITEM)).drop("page")


@register("json_quarantine")
def json_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drifting fields and broken documents of the same, with their paths."""
    bad = drift.quarantine(drift.checked_envelopes(_drifting_pages(spark, sf_dir), EVENT_ITEM))
    return bad.select("page", "path", "expected", "found", F.when(F.col("path") > "$.data", F.col("value")).alias("value"))


def _bulk_drop(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    cents = mny.to_cents(F.col("c_acctbal"))
    return c.select(
        F.col("c_mktsegment").alias("Organismo"),
        (F.lit(1990) + F.col("c_nationkey")).cast("string").alias("Año"),
        mon.month_name(F.col("c_nationkey") % 12 + 1).alias("Mes"),
        F.col("c_name").alias("Nombres"),
        F.translate(F.col("c_mktsegment"), "AEIOU", "ÁÉÍÓÚ").alias("Apellido Paterno"),
        views.money_text(cents).alias("Sueldo Liquido"),
        views.money_text(cents * 2).alias("Sueldo Bruto"))


@register("csv_ingest")
def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer written as a ';' Latin-1 bulk drop, then ingested."""
    path = scratch_path(spark, "bulk") + "/TA_PersonalPlanta.csv"
    sk.write_report_csv(_bulk_drop(spark, sf_dir), path)
    return leg.bulk_pay(spark, [path])


@register("drop_ingest")
def drop_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of the same source and months in two calls, the first again
    with its columns reversed, and one that is missing: every row once (C12)."""
    rows = _bulk_drop(spark, sf_dir)
    base = scratch_path(spark, "drops")
    a, b = f"{base}/TA_PersonalPlanta_a%41 1.csv", f"{base}/TA_PersonalPlanta_b.csv"
    odd = F.col("Organismo").isin("BUILDING", "MACHINERY")
    sk.write_report_csv(rows.filter(odd), a)
    sk.write_report_csv(rows.filter(~odd), b)
    lake = f"{base}/lake"
    leg.ingest_bulk_csv(spark, [a, f"{base}/TA_PersonalPlanta_none.csv"], lake, root=base)
    leg.ingest_bulk_csv(spark, [b], lake, root=base)
    sk.write_report_csv(rows.filter(odd).select(*reversed(rows.columns)), a)
    return leg.ingest_bulk_csv(spark, [a], lake, root=base)


@register("drop_generations")
def drop_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of one file name in two folders; the second again beside a new
    one; then the first again, but empty, beside the new one as corrected: every
    row once, none lost, as the last commit has it (S7, C12)."""
    rows = _bulk_drop(spark, sf_dir)
    base = scratch_path(spark, "drops")
    a, b, c = (f"{base}/{name}" for name in ("2024/TA_PersonalPlanta.csv", "2025/TA_PersonalPlanta.csv", "2025/TA_PersonalPlanta_otros.csv"))
    part = {a: F.col("Organismo").isin("BUILDING", "MACHINERY"), b: F.col("Organismo") == "FURNITURE"}
    part[c] = ~part[a] & ~part[b]
    lake = f"{base}/lake"
    for step in ([a], [b], [b, c]):
        for path in step:
            wrong = rows.withColumn("Sueldo Liquido", F.lit("1")) if path in (b, c) and len(step) != 2 or path == c else rows
            sk.write_report_csv(wrong.filter(part[path]), path)
        leg.ingest_bulk_csv(spark, step, lake, root=base)
    sk.write_report_csv(rows.filter(F.lit(False)), a)
    sk.write_report_csv(rows.filter(part[c]), c)
    return leg.ingest_bulk_csv(spark, [a, c], lake, root=base)


def _summarised_lake(spark, sf_dir):
    """A pay table of three drops and its summaries: refreshed after two wrong
    drops, and again after the second was corrected and a third came."""
    rows = _bulk_drop(spark, sf_dir)
    base = scratch_path(spark, "drops")
    lake, states = f"{base}/lake", f"{base}/states"
    names = [f"{base}/{n}" for n in ("2024/TA_PersonalPlanta.csv", "2024/TA_PersonalContrata.csv", "2025/TA_PersonalPlanta.csv")]
    parts = [F.col("Organismo").isin("BUILDING", "MACHINERY"), F.col("Organismo") == "FURNITURE",
             ~F.col("Organismo").isin("BUILDING", "MACHINERY", "FURNITURE")]
    wrong = rows.withColumns({"Sueldo Liquido": F.lit("$ 99.999.999,00"), "Año": F.lit("2001")})
    for step in ([0, 1], [1, 2]):
        for i in step:
            sk.write_report_csv((wrong if step == [0, 1] and i == 1 else rows).filter(parts[i]), names[i])
        leg.ingest_bulk_csv(spark, [names[i] for i in step], lake, root=base)
        prt.refresh(spark, lake, states, floor=0)
    return generations.read(spark, lake), generations.read(spark, states)


@register("catalogue_incremental")
def catalogue_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue from summaries of drops, of which only new and replaced ones were read."""
    _, states = _summarised_lake(spark, sf_dir)
    return cat.build_catalogue(states).withColumns({"anios": _join_list("anios"), "organismos": _join_list("organismos")})


@register("outliers_incremental")
def outliers_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outliers against statistics merged from summaries: one scan of the pay table (C11, A3)."""
    pay, states = _summarised_lake(spark, sf_dir)
    stats = prt.merged_stats(states, group="Mes")
    return audits.pay_outliers(pay, group="Mes", amount="remuliquida_mensual", name="Nombres",
                               org="organismo_nombre", sigma=1.5, result_floor=0, stats=stats)


@register("group_stats_incremental")
def group_stats_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and deviation per organisation, merged from summaries (A3)."""
    _, states = _summarised_lake(spark, sf_dir)
    stats = prt.merged_stats(states, group="organismo_nombre")
    return stats.select("organismo_nombre", F.round("promedio", 2).alias("promedio"), F.round("desv", 2).alias("desv"))


@register("histogram_one_scan")
def histogram_one_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pay histogram with bounds from summaries: one scan of the pay table."""
    pay, states = _summarised_lake(spark, sf_dir)
    return summ.histogram(pay, "remuliquida_mensual", bins=20, bounds=prt.merged_bounds(states))


@register("parquet_roundtrip")
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unified rows -> partitioned ZSTD Parquet -> year-pruned read."""
    s_raw, c_raw = _raw_sources(spark, sf_dir)
    rows = uni.pay_rows(s_raw, "Planta").unionByName(uni.pay_rows(c_raw, "Contrata"))
    out = scratch_path(spark, "pay")
    sk.write_pay_parquet(rows, out)
    return spark.read.parquet(out).filter(F.col("anyo").between(2005, 2010))


@register("filename_keys")
def filename_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drops named YYYY_MM.csv and ID_YYYY_MM.csv, under a folder that has a
    month in its own name; keys come from the drop's name (S4, S6, F15)."""
    o = table(spark, sf_dir, "orders")
    month = F.date_format("o_orderdate", "yyyy_MM")
    rows = o.select("o_orderkey", mny.to_cents(F.col("o_totalprice")).alias("monto"), "o_orderstatus",
                    F.col("o_custkey") % 3, month.alias("month")).toDF("o_orderkey", "monto", "status", "who", "month")
    out = scratch_path(spark, "runs") + "/2024_03"

    def write(df, name, sub):
        # one task, and so one part, per drop; a large one is split at run time
        (df.withColumn("drop", name).drop("status", "who", "month").hint("rebalance", "drop")
         .write.partitionBy("drop").option("header", True).csv(f"{out}/{sub}"))

    write(rows.filter("status = 'O'"), F.concat("month", F.lit(".csv")), "plain")
    # the other drops have their columns the other way round
    write(rows.filter("status != 'O'").select("monto", "o_orderkey", "status", "who", "month"),
          F.concat_ws("_", "who", F.concat("month", F.lit(".csv"))), "by_id")
    plain = rd.read_keyed_groups(spark, f"{out}/plain", leg.MONTH_FILE, ["anyo", "mes"])
    by_id = rd.read_keyed_groups(spark, f"{out}/by_id", leg.ID_MONTH_FILE, ["id", "anyo", "mes"])
    both = uni.ragged_concat(plain + by_id + rd.read_keyed_groups(spark, f"{out}/none", leg.MONTH_FILE, ["anyo", "mes"]))
    return both.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "id", "anyo", "mes",
                       F.col("monto").cast("bigint").alias("monto"))


@register("report_export")
def report_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A display table exported as ';' Latin-1 CSV and read back."""
    c = table(spark, sf_dir, "customer")
    rep = c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("Nombre"),
                   F.translate(F.col("c_mktsegment"), "AEIOU", "ÁÉÍÓÚ").alias("Segmento"),
                   mny.format_clp(mny.to_cents(F.col("c_acctbal"))).alias("Saldo"))
    out = scratch_path(spark, "report")
    sk.write_report_csv(rep, out)
    raw = rd.read_lenient_csv(spark, out)
    return raw.toDF(*rd.read_header(spark, out))


@register("analyst_export")
def analyst_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pay + expenses extract as analyst CSV, read back as text."""
    extract = pay_with_expenses(spark, sf_dir)
    out = scratch_path(spark, "analyst")
    sk.write_analyst_csv(extract, out)
    return spark.read.options(header=True, inferSchema=False).csv(out)


@register("stream_ingest")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of order files; each available-now run ingests only new files."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                               "o_totalprice", "o_orderstatus")
    base = scratch_path(spark, "stream")
    landing, out, ckpt = f"{base}/landing", f"{base}/out", f"{base}/checkpoint"
    schema = o.schema

    def shape(df):
        return df.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("anyo"),
                         mny.to_cents(F.col("o_totalprice")).alias("monto"))

    o.filter(F.col("o_orderstatus") == "F").write.mode("append").parquet(landing)
    ingest_new_files(spark, landing, schema, out, ckpt, transform=shape, fmt="parquet")
    o.filter(F.col("o_orderstatus") != "F").write.mode("append").parquet(landing)
    ingest_new_files(spark, landing, schema, out, ckpt, transform=shape, fmt="parquet")
    return spark.read.parquet(out)


# ---------------------------------------------------------------- legislative consolidations

def _named_order_lines(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return o.join(c, o.o_custkey == c.c_custkey)


def _senate(spark, sf_dir):
    oc = _named_order_lines(spark, sf_dir)
    cents = mny.to_cents(F.col("o_totalprice"))
    pay = oc.select(F.year("o_orderdate").alias("ano"), F.month("o_orderdate").alias("mes"),
                    F.col("c_custkey").cast("string").alias("rut"), F.col("c_name").alias("nombre"),
                    F.col("c_mktsegment").alias("appaterno"), F.lit(None).cast("string").alias("apmaterno"),
                    cents.alias("dieta"), (cents - 1000).alias("saldo"))
    # line items are summed by order first: the joins and the person key see a
    # row per order and concept
    li = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_returnflag")
          .agg(F.sum(mny.to_cents(F.col("l_extendedprice"))).alias("monto")))
    spent = li.join(oc, li.l_orderkey == oc.o_orderkey).select(
        F.year("o_orderdate").alias("ano"), F.month("o_orderdate").alias("mes"),
        F.col("c_name").alias("nombre"), F.col("c_mktsegment").alias("appaterno"),
        F.col("l_returnflag").alias("gastos_operacionales"), "monto")
    return leg.consolidate_senate(pay, spent)


@register("senate_consolidation")
def senate_consolidation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C14: pay items from orders, expense items from their line items,
    keyed by the normalised person name; app-schema rows out."""
    return _senate(spark, sf_dir)[1]


@register("senate_extract")
def senate_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C14 analyst extract: present columns, sorted by year, month, person."""
    return _senate(spark, sf_dir)[0]


def _chamber_drops(spark, sf_dir, root):
    # the three staff drops come from one join, written once to the shared folder
    joined = (table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer").select("c_custkey", "c_name"),
        F.col("o_custkey") == F.col("c_custkey"))
        .select("c_name", "o_orderpriority", "o_orderstatus",
                F.date_format("o_orderdate", "yyyy_MM").alias("period"),
                views.money_text(mny.to_cents(F.col("o_totalprice"))).alias("money")))
    joined.write.parquet(f"{root}/orders")
    orders = spark.read.parquet(f"{root}/orders")
    period, money = F.col("period"), F.col("money")

    def write(df, sub):
        # rebalanced at run time: small months share a task, a large one is split
        (df.hint("rebalance", "period")
         .write.partitionBy("period").option("header", True).csv(f"{root}/{sub}"))

    write(orders.filter(F.col("o_orderstatus") == "F").select(
        F.col("c_name").alias("Nombre Completo"), F.col("o_orderpriority").alias("Cargo"),
        money.alias("Remuneración Bruta"), period), "personal_planta")
    write(orders.filter(F.col("o_orderstatus") == "O").select(
        F.col("c_name").alias("nombre_funcionario"), F.col("o_orderpriority").alias("Función"),
        money.alias("Sueldo"), period), "personal_contrata")
    write(orders.filter(F.col("o_orderstatus") == "P").select(
        F.col("c_name").alias("Nombre"), money.alias("Honorario Total"), period), "personal_honorarios")
    s = table(spark, sf_dir, "supplier")
    month_key = lambda k: F.concat(F.lit("2024_"), F.lpad((k % 12 + 1).cast("string"), 2, "0"))
    write(s.select(
        F.when(F.col("s_acctbal") < 0, F.lit(" ")).otherwise(F.col("s_name")).alias("Nombre"),
        F.when(F.col("s_nationkey") < 5, F.lit(None)).otherwise(F.lit("Asesor")).alias("Cargo"),
        views.money_text(mny.to_cents(F.col("s_acctbal"))).alias("Sueldo"),
        F.concat(F.lit("Dip. "), F.col("s_nationkey").cast("string")).alias("Diputado Responsable"),
        month_key(F.col("s_nationkey")).alias("period")), "personal_apoyo")
    # base pay as a spreadsheet writes a column with gaps: 1000.0
    c = table(spark, sf_dir, "customer")
    cc = mny.to_cents(F.col("c_acctbal"))
    floats = F.concat((cc - 1000).cast("string"), F.lit(".0"))
    write(c.select(F.col("c_custkey").alias("ID_Diputado"), F.col("c_name").alias("Nombre"),
                   F.lit("Diputado").alias("Cargo"), cc.alias("Sueldo Bruto"),
                   F.when(F.col("c_custkey") % 5 != 0, floats).alias("Sueldo Liquido"),
                   month_key(F.col("c_nationkey")).alias("period")),
          "diputados_dieta")
    # a drop without pay columns is skipped, the others are read
    write(s.select(F.col("s_name").alias("Nombre"), F.lit("2024_01").alias("period")), "diputados_dieta/sin_sueldo")


@register("chamber_consolidation")
def chamber_consolidation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly staff drops with differing headers -> app-schema rows."""
    root = scratch_path(spark, "chamber")
    _chamber_drops(spark, sf_dir, root)
    return leg.consolidate_chamber(spark, root)


@register("chamber_expenses")
def chamber_expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expense drops keyed by deputy id and month in the folder name,
    named through the deputies' monthly lists (latest name per id)."""
    root = scratch_path(spark, "chamber_exp")
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_extendedprice")
    # one deputy per region: 5 ids x every month of drops
    key = F.concat_ws("_", F.col("n_regionkey").cast("string"), F.date_format("o_orderdate", "yyyy_MM"))
    drops = (o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
             .select("o_orderkey", key.alias("drop")))
    lines = li.join(drops, F.col("l_orderkey") == F.col("o_orderkey"))
    (lines.select(F.col("l_returnflag").alias("Concepto"),
                  views.money_text(mny.to_cents(F.col("l_extendedprice"))).alias("Monto"), "drop")
     .hint("rebalance", "drop")
     .write.partitionBy("drop").option("header", True).csv(f"{root}/gastos_operacionales"))
    # the deputies' monthly lists: every month of the orders' span; the name
    # carries a suffix in the last month, so the latest name must win
    r = table(spark, sf_dir, "region")
    lo = o.agg(F.min("o_orderdate")).scalar()
    hi = o.agg(F.max("o_orderdate")).scalar()
    month_seq = F.sequence(F.trunc(lo.cast("date"), "month"), F.trunc(hi.cast("date"), "month"),
                           F.expr("INTERVAL 1 MONTH"))
    lists = r.select("r_regionkey", "r_name", F.explode(month_seq).alias("m"))
    last = F.trunc(hi.cast("date"), "month")
    (lists.select(F.col("r_regionkey").alias("ID_Diputado"),
                  F.concat(F.col("r_name"), F.when(F.col("m") == last, F.lit(" JR")).otherwise(F.lit(""))).alias("Nombre"),
                  F.date_format("m", "yyyy_MM").alias("period"))
     .write.partitionBy("period").option("header", True).csv(f"{root}/diputados_dieta"))
    return leg.read_chamber_expenses(spark, root)


@register("catalogue_json")
def catalogue_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C13 + S10: the catalogue written as JSON lines and read back."""
    out = scratch_path(spark, "catalogue")
    sk.write_catalogue(_catalogue(spark, sf_dir), out)
    back = spark.read.schema("dataset string, anios array<int>, organismos array<string>").json(out)
    return back.withColumns({"anios": _join_list("anios"), "organismos": _join_list("organismos")})


@register("monthly_items")
def monthly_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events stored as items per (category, year, month) folder, read back."""
    ev = table(spark, sf_dir, "events")
    items = ev.select(F.col("event_type").alias("category"), F.year("ts").alias("ano"),
                      F.month("ts").alias("mes"), "event_id", "user_id", "value")
    out = scratch_path(spark, "monthly_items")
    sk.write_monthly_items(items, out)
    schema = "event_id long, user_id long, value double, category string, ano int, mes int"
    return spark.read.schema(schema).json(out)


@register("person_expenses")
def person_expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 for one person-month: customer 66's line items of May 1995, two sources."""
    open_src, done_src = _breakdown(spark, sf_dir)
    return exp.person_expenses(open_src, done_src, year=1995, month=5, key=66)


@register("search_union")
def search_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 over the union of two differently shaped sources (U1 + U2)."""
    s_raw, c_raw = _raw_sources(spark, sf_dir)
    pay = srch.union_sources([uni.pay_rows(s_raw, "Planta"), uni.pay_rows(c_raw, "Contrata")])
    return srch.search(pay, person="customer#00000001", years=(2000, 2020))


@register("search_fallback")
def search_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 then C2: no row of the person in these years, so the latest record."""
    s_raw, c_raw = _raw_sources(spark, sf_dir)
    pay = srch.union_sources([uni.pay_rows(s_raw, "Planta"), uni.pay_rows(c_raw, "Contrata")])
    columns = ("anyo", "Mes", "organismo_nombre", "origen", "Nombres")
    rows, last = srch.search_or_last_record(pay, person="customer#00000001", years=(1900, 1950), columns=columns,
                                            last={"columns": columns, "tie": ("Nombres",)})
    return rows if last is None else last


@register("audit_from_raw")
def audit_from_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C9 straight from two raw, differently headed sources: audit view
    (text), audit rows (name, year, digits-only pay), ranking of one month."""
    s_raw, c_raw = _raw_sources(spark, sf_dir)
    rows = audits.audit_rows(uni.audit_view([("Planta", s_raw), ("Contrata", c_raw)]))
    return audits.pay_ranking(rows, 2005, "Junio",
                              tie=("nombre_completo", "organismo", "Origen", "cargo"))


@register("pay_with_expenses_bucketed")
def pay_with_expenses_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 on co-located tables: pay and expenses bucketed on the same keys,
    so totals and the left join need no shuffle."""
    c = table(spark, sf_dir, "customer")
    keys = ["ano", "mes", "llave_senador"]
    pay = c.select(F.lit(1998).alias("ano"), F.lit(3).alias("mes"),
                   F.col("c_custkey").alias("llave_senador"),
                   mny.to_cents(F.col("c_acctbal")).alias("dieta"))
    o = table(spark, sf_dir, "orders")
    spent = o.select(F.year("o_orderdate").alias("ano"), F.month("o_orderdate").alias("mes"),
                     F.col("o_custkey").alias("llave_senador"),
                     mny.to_cents(F.col("o_totalprice")).alias("monto"))
    base = scratch_path(spark, "bucketed")
    tag = base.rsplit("-", 1)[-1]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))  # the cluster's setting for this much data
    pay_t = sk.write_bucketed(pay, f"pay_{tag}", keys, buckets, f"{base}/pay")
    spent_t = sk.write_bucketed(spent, f"spent_{tag}", keys, buckets, f"{base}/spent")
    return exp.pay_with_expenses(pay_t, spent_t, keys)


@register("stream_mixed_drops")
def stream_mixed_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV drops of two headers in one landing folder, taken by two runs of the
    stream: every row once (S13, C12)."""
    rows = _bulk_drop(spark, sf_dir)
    base = scratch_path(spark, "mixed")
    landing, lake = f"{base}/landing", f"{base}/lake"
    for step in (("BUILDING", "MACHINERY"), ("FURNITURE",), ()):
        for k, name in enumerate(step):
            part = rows.filter(F.col("Organismo") == name)
            sk.write_report_csv(part.select(*reversed(rows.columns)) if k else part, f"{landing}/TA_PersonalPlanta_{name}.csv")
        if not step:
            sk.write_report_csv(rows.filter(~F.col("Organismo").isin("BUILDING", "MACHINERY", "FURNITURE")),
                                f"{landing}/new/TA_PersonalPlanta_BUILDING.csv")
        ingest_mixed_drops(spark, landing, lake, f"{base}/checkpoint")
    return generations.read(spark, lake)


@register("senate_expense_detail")
def senate_expense_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 over C14's own outputs: the Senate rows of March 1996 looked up in
    the expense detail table, broken down by concept."""
    _, app, detail = _senate(spark, sf_dir)
    chosen = app.filter((F.col("anyo") == 1996) & (F.col("Mes") == "Marzo"))
    return exp.expense_detail_for(chosen, detail)


@register("lake_surname_audit")
def lake_surname_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C12 then C10: unified rows written to the partitioned pay table; the
    audit of one month reads only that month's folders (partition filters)."""
    s_raw, c_raw = _raw_sources(spark, sf_dir)
    lake = scratch_path(spark, "lake")
    sk.write_pay_parquet(uni.pay_rows(s_raw, "Planta").unionByName(uni.pay_rows(c_raw, "Contrata")), lake)
    pay = spark.read.parquet(lake)
    view = pay.select(F.col("organismo_nombre").alias("organismo"), "Paterno", "anyo", "Mes",
                      F.col("remuliquida_mensual").alias("sueldo_num"))
    return audits.surname_concentration(view, 2005, "Junio", min_count=5)


@register("lake_search")
def lake_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 on the written pay table: the stored search vector is matched,
    the year range prunes partition folders, at most 500 rows."""
    s_raw, c_raw = _raw_sources(spark, sf_dir)
    lake = scratch_path(spark, "lake")
    rows = uni.pay_rows(s_raw, "Planta").unionByName(uni.pay_rows(c_raw, "Contrata"))
    sk.write_pay_parquet(rows, lake)
    return srch.search(spark.read.parquet(lake), person="Customer#00000001", years=(2003, 2012))
