"""DuckDB SQL equal in result to each registered driver query.

Tables are the driver's pre-registered views.  Amounts are integer cents
(``CAST(round(x * 100) AS BIGINT)``), sums are cast back to BIGINT, lists
are compared as sorted, comma-joined text, and every top-k carries the
same total tie-break as the Spark side.
"""

from __future__ import annotations

# Month names in calendar order, as a DuckDB list literal.
MONTHS_SQL = ("['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto',"
              "'Septiembre','Octubre','Noviembre','Diciembre']")

ORACLE: dict[str, str] = {}

ORACLE["multi_employment"] = f"""
SELECT CAST(l_partkey AS VARCHAR) AS nombre_completo, CAST(1998 AS INTEGER) AS anyo, 'Marzo' AS Mes,
       CAST(len(list_distinct(list(l_suppkey))) AS INTEGER) AS num_empleos,
       CAST(SUM(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS sueldo_total,
       array_to_string(list_sort(list_distinct(list(l_suppkey))), ',') AS lista_organismos,
       array_to_string(list_sort(list_distinct(list(l_returnflag))), ',') AS tipos_contrato
FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-03-01' AND l_shipdate < TIMESTAMP '1998-04-01'
GROUP BY l_partkey HAVING min(l_suppkey) < max(l_suppkey)
ORDER BY sueldo_total DESC, nombre_completo LIMIT 100
"""

ORACLE["pay_ranking"] = f"""
SELECT n_name AS organismo,
       upper(trim(COALESCE(c_name, '')) || ' ' || '' || ' ' || '') AS nombre_completo,
       CAST(round(o_totalprice * 100) AS BIGINT) AS sueldo_num,
       o_orderstatus AS Origen, o_orderpriority AS cargo
FROM orders JOIN customer ON o_custkey = c_custkey
     JOIN nation ON c_nationkey = n_nationkey
WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 3
ORDER BY sueldo_num DESC, nombre_completo ASC NULLS LAST, organismo ASC NULLS LAST,
         Origen ASC NULLS LAST, cargo ASC NULLS LAST
LIMIT 100
"""

# The surnames left out of the concentration audit.
COMMON_SQL = ("['GONZALEZ', 'MUÑOZ', 'ROJAS', 'DIAZ', 'PEREZ', 'SOTO', 'CONTRERAS', 'SILVA', 'MARTINEZ', "
              "'SEPULVEDA']")


def surname_sql(org: str, surname: str, amount: str, source: str) -> str:
    """Surnames of five or more rows in an organisation, by count."""
    return f"""
SELECT org AS organismo, apellido, n AS cantidad_personas, total AS costo_mensual_total
FROM (SELECT {org} AS org, upper({surname}) AS apellido, count(*) AS n,
             CAST(sum({amount}) AS BIGINT) AS total
      FROM {source} WHERE strlen({surname}) > 2 GROUP BY ALL)
WHERE n >= 5 AND NOT list_contains({COMMON_SQL}, apellido)
ORDER BY n DESC, org NULLS LAST, apellido NULLS LAST LIMIT 100
"""


ORACLE["surname_concentration"] = surname_sql(
    "p_brand", "split_part(p_name, ' ', 2)", "CAST(round(p_retailprice * 100) AS BIGINT)", "part")


def _outliers_sql(base: str, sigma: str = "3", names: dict | None = None) -> str:
    """Rows above mean + ``sigma`` deviations of their group, for groups of over
    ten positive rows; mean and deviation as window values over the group.
    ``names``: other names of the first three columns."""
    shown = ", ".join(f"{c} AS {(names or {}).get(c, c)}" for c in ("organismo", "nombre", "estamento"))
    return f"""
SELECT {shown}, sueldo_num AS sueldo, CAST(mean AS BIGINT) AS promedio_estamento,
       CAST(sueldo_num / mean AS DECIMAL(10,1)) AS veces_promedio
FROM (SELECT *, avg(sueldo_num) OVER g AS mean, stddev_samp(sueldo_num) OVER g AS spread, count(*) OVER g AS n
      FROM ({base}) WHERE sueldo_num > 0 WINDOW g AS (PARTITION BY estamento))
WHERE n > 10 AND sueldo_num > mean + {sigma} * spread AND estamento IS NOT NULL
ORDER BY veces_promedio DESC, sueldo DESC, nombre NULLS LAST, organismo NULLS LAST LIMIT 100
"""


ORACLE["pay_outliers"] = _outliers_sql(
    "SELECT CAST(user_id AS VARCHAR) AS organismo, CAST(event_id AS VARCHAR) AS nombre, "
    "event_type AS estamento, CAST(round(value * 100) AS BIGINT) AS sueldo_num FROM events")

ORACLE["pay_outliers_documents"] = _outliers_sql(
    "SELECT lang AS organismo, CAST(doc_id AS VARCHAR) AS nombre, source AS estamento, "
    "n_chars AS sueldo_num FROM documents")

# Accent folds as DuckDB sees them: the 16-letter translate, and the full
# NFKD fold as strip_accents plus removal of what is still not ASCII.
FOLD16 = "translate(lower({x}), 'áéíóúàèìòùäëïöüñ', 'aeiouaeiouaeioun')"
FOLD_FULL = "regexp_replace(strip_accents(lower({x})), '[^\\x00-\\x7F]', '', 'g')"


def clp(x: str) -> str:
    """format_clp in DuckDB: '$ 1.234.567', truncated, NULL -> ''."""
    return (f"COALESCE('$ ' || replace(format('{{:,}}', TRY_CAST(trunc(TRY_CAST({x} AS DOUBLE)) "
            f"AS BIGINT)), ',', '.'), '')")


ORDER_ROWS = f"""
  SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority AS organismo_nombre,
         CAST(year(o_orderdate) AS INTEGER) AS anyo, {MONTHS_SQL}[month(o_orderdate)] AS Mes,
         o_orderstatus AS origen,
         CAST(round(o_totalprice * 100) AS BIGINT) AS remuliquida_mensual
  FROM orders"""

ORACLE["person_search"] = f"""
SELECT doc_id, lang, source, n_chars FROM documents
WHERE {FOLD_FULL.format(x='text')} LIKE '%des%' AND {FOLD_FULL.format(x='text')} LIKE '%elle%'
ORDER BY doc_id LIMIT 500
"""

ORACLE["indexed_search"] = ORACLE["person_search"]

ORACLE["search_filters"] = f"""
SELECT o_orderkey, organismo_nombre, anyo, Mes, origen, remuliquida_mensual
FROM ({ORDER_ROWS})
WHERE organismo_nombre = '1-URGENT' AND anyo BETWEEN 1996 AND 1997 AND Mes = 'Marzo'
ORDER BY o_orderkey LIMIT 500
"""

ORACLE["accent_fold"] = f"SELECT doc_id, {FOLD16.format(x='text')} AS folded FROM documents"
ORACLE["accent_fold_full"] = f"SELECT doc_id, {FOLD_FULL.format(x='text')} AS folded FROM documents"

# What each character of registry.FOLD_SAMPLES folds to, spelled out.
_FOLDED_DIGITS = ["kg", "10", "No", "viii", "A", "9", "", "", "", "n"]
ORACLE["accent_fold_special"] = f"""
SELECT c_custkey, array_to_string(list_transform(string_split(c_name, ''), lambda ch: CASE ch
    {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in enumerate(_FOLDED_DIGITS))} ELSE lower(ch) END), '')
    || 'fi12kg10NoviiiA9n' AS folded
FROM customer
"""

ORACLE["last_record"] = f"""
SELECT anyo, Mes, organismo_nombre, origen
FROM ({ORDER_ROWS}) o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE trim({FOLD_FULL.format(x='c_name')}) LIKE '%customer#000000007%'
ORDER BY anyo DESC, month(o_orderdate) DESC, o_orderdate DESC, o_orderkey DESC
LIMIT 1
"""

ORACLE["last_record_per_person"] = f"""
SELECT o_custkey, anyo, Mes, organismo_nombre, origen
FROM ({ORDER_ROWS})
QUALIFY row_number() OVER (PARTITION BY o_custkey
                           ORDER BY anyo DESC, month(o_orderdate) DESC, o_orderdate DESC,
                                    o_orderkey DESC) = 1
"""

PART_PEOPLE = """
  SELECT p_partkey, split_part(p_name, ' ', 1) AS Nombres, split_part(p_name, ' ', 2) AS Paterno,
         CAST(NULL AS VARCHAR) AS Materno, p_brand AS organismo_nombre, p_type AS cargo
  FROM part"""

ORACLE["profiles"] = f"""
SELECT trim(COALESCE(Nombres, '')) AS Nombres, trim(COALESCE(Paterno, '')) AS Paterno,
       trim(COALESCE(Materno, '')) AS Materno,
       array_to_string(list_sort(list(DISTINCT organismo_nombre)), ' | ') AS organismo_nombre,
       array_to_string(list_sort(list(DISTINCT cargo)), ' | ') AS cargo
FROM ({PART_PEOPLE})
GROUP BY 1, 2, 3
"""

ORACLE["profile_select"] = f"""
SELECT * FROM ({PART_PEOPLE})
WHERE trim(COALESCE(Nombres, '')) = 'small' AND trim(COALESCE(Paterno, '')) = 'ring'
  AND trim(COALESCE(Materno, '')) = ''
"""

ORACLE["profile_flags"] = f"""
SELECT COUNT(DISTINCT (trim(COALESCE(Nombres, '')), trim(COALESCE(Paterno, '')),
                       trim(COALESCE(Materno, '')))) AS n_profiles,
       COUNT(*) AS n_rows,
       COUNT(DISTINCT (trim(COALESCE(Nombres, '')), trim(COALESCE(Paterno, '')),
                       trim(COALESCE(Materno, '')))) > 1 AS ambiguous,
       COUNT(*) > 500 AS truncated
FROM ({PART_PEOPLE})
"""

ORACLE["kpis"] = f"""
SELECT registros, gasto_total, promedio, maximo,
       CASE WHEN registros = 1 THEN 'Gasto Total (Mes)' ELSE 'Gasto Total (Acumulado)' END
         AS etiqueta_total,
       {clp('gasto_total')} AS gasto_total_txt, {clp('promedio_raw')} AS promedio_txt,
       {clp('maximo')} AS maximo_txt
FROM (SELECT COUNT(*) AS registros, CAST(SUM(remuliquida_mensual) AS BIGINT) AS gasto_total,
             round(AVG(remuliquida_mensual), 2) AS promedio, AVG(remuliquida_mensual) AS promedio_raw,
             MAX(remuliquida_mensual) AS maximo
      FROM ({ORDER_ROWS}))
"""

ORACLE["chronological_table"] = f"""
SELECT anyo, Mes, {clp('remuliquida_mensual')} AS remuliquida_mensual, organismo_nombre, origen,
       o_orderkey
FROM ({ORDER_ROWS})
"""

ORACLE["pay_histogram"] = f"""
WITH v AS (SELECT remuliquida_mensual AS x FROM ({ORDER_ROWS}) WHERE remuliquida_mensual IS NOT NULL),
     b AS (SELECT min(x) AS lo, max(x) AS hi FROM v)
SELECT CAST(least(COALESCE(floor((20 * (x - lo)) / NULLIF(hi - lo, 0)) + 1, 1), 20) AS INTEGER) AS bin,
       COUNT(*) AS n, min(x) AS bin_min, max(x) AS bin_max
FROM v, b GROUP BY 1
"""

ORACLE["top_pay"] = f"""
WITH r AS (
  SELECT c_name AS Nombres, c_mktsegment AS Paterno, repeat(c_mktsegment || ' ', 12) AS cargo,
         CAST(round(c_acctbal * 100) AS BIGINT) AS amt
  FROM customer
  ORDER BY amt DESC NULLS LAST, Nombres ASC NULLS LAST, Paterno ASC NULLS LAST LIMIT 10)
SELECT Nombres AS Nombre, Paterno AS Apellido,
       CASE WHEN length(cargo) > 100 THEN substr(cargo, 1, 100) || '...' ELSE cargo END
         AS "Cargo / Función",
       {clp('amt')} AS Sueldo
FROM r
"""

LINE_EXPENSES = """
  SELECT CAST(year(o_orderdate) AS INTEGER) AS anyo, CAST(month(o_orderdate) AS INTEGER) AS Mes,
         o_custkey AS llave_senador, l_returnflag AS gastos_operacionales, l_linestatus,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS monto
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

ORACLE["expense_breakdown"] = f"""
WITH people AS (
  SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS anyo, CAST(month(o_orderdate) AS INTEGER) AS Mes,
         o_custkey AS llave_senador
  FROM orders WHERE o_orderpriority = '1-URGENT' AND year(o_orderdate) = 1996),
src AS (
  SELECT anyo, Mes, llave_senador, gastos_operacionales AS Concepto, SUM(monto) AS Monto
  FROM ({LINE_EXPENSES}) WHERE l_linestatus = 'O' GROUP BY ALL
  UNION ALL
  SELECT anyo, Mes, llave_senador, gastos_operacionales AS Concepto, SUM(monto) AS Monto
  FROM ({LINE_EXPENSES}) WHERE l_linestatus = 'F' GROUP BY ALL)
SELECT s.anyo, s.Mes, s.llave_senador, s.Concepto, CAST(SUM(s.Monto) AS BIGINT) AS Monto
FROM src s JOIN people p USING (anyo, Mes, llave_senador)
GROUP BY ALL
"""

ORACLE["expense_share"] = f"""
WITH per AS (
  SELECT gastos_operacionales AS Concepto, CAST(SUM(monto) AS BIGINT) AS Monto
  FROM ({LINE_EXPENSES}) WHERE l_linestatus IN ('O', 'F') GROUP BY 1),
pos AS (SELECT * FROM per WHERE Monto > 0)
SELECT Concepto, Monto, Monto / NULLIF((SELECT SUM(Monto) FROM pos), 0) AS share FROM pos
"""

CATALOGUE = f"""
  WITH r AS (SELECT organismo_nombre AS ds, anyo, origen AS org FROM ({ORDER_ROWS})),
  per AS (
    SELECT ds AS dataset,
           list_sort(list(DISTINCT anyo) FILTER (WHERE anyo IS NOT NULL), 'DESC') AS anios,
           list_sort(list(DISTINCT org) FILTER (WHERE org IS NOT NULL)) AS organismos
    FROM r WHERE ds IS NOT NULL GROUP BY 1),
  allds AS (
    SELECT 'Todas (Búsqueda Global)' AS dataset,
           list_sort(list(DISTINCT anyo) FILTER (WHERE anyo IS NOT NULL), 'DESC') AS anios,
           list_sort(list(DISTINCT org) FILTER (WHERE org IS NOT NULL)) AS organismos
    FROM r WHERE ds IS NOT NULL)
  SELECT * FROM per UNION ALL SELECT * FROM allds"""

ORACLE["catalogue"] = f"""
SELECT dataset, array_to_string(anios, ',') AS anios, array_to_string(organismos, ',') AS organismos
FROM ({CATALOGUE})
"""

ORACLE["catalogue_lookup"] = f"""
WITH c AS ({CATALOGUE}),
probe AS (SELECT '3-MEDIUM' AS dataset UNION ALL SELECT 'missing'),
hit AS (
  SELECT p.dataset, COALESCE(c.anios, [2026, 2025, 2024, 2023, 2022, 2021, 2020]) AS anios,
         COALESCE(c.organismos, []) AS organismos
  FROM probe p LEFT JOIN c USING (dataset))
SELECT dataset, CAST(list_min(anios) AS INTEGER) AS min_year, CAST(list_max(anios) AS INTEGER) AS max_year,
       CAST(len(anios) AS INTEGER) AS n_years, CAST(len(organismos) AS INTEGER) AS n_orgs
FROM hit
"""


def money_text(x: str) -> str:
    """Integer cents as '$ -1.234,56' (twin of views.money_text)."""
    return (f"('$ ' || CASE WHEN {x} < 0 THEN '-' ELSE '' END || "
            f"replace(format('{{:,}}', abs({x}) // 100), ',', '.') || ',' || "
            f"lpad(CAST(abs({x}) % 100 AS VARCHAR), 2, '0'))")


def clean_money(x: str) -> str:
    return f"TRY_CAST(replace(regexp_replace({x}, '[^0-9,]', '', 'g'), ',', '.') AS INTEGER)"


def digits_money(x: str) -> str:
    return f"TRY_CAST(regexp_replace({x}, '[^0-9]', '', 'g') AS BIGINT)"


CENTS = "CAST(round({x} * 100) AS BIGINT)"

ORACLE["money_clean"] = f"""
WITH t AS (SELECT o_orderkey, {money_text(CENTS.format(x='o_totalprice'))} AS texto FROM orders)
SELECT o_orderkey, texto, {clean_money('texto')} AS x1,
       {clean_money("translate(texto, '.,', ',.')")} AS x1_swapped
FROM t
"""

ORACLE["money_digits"] = f"""
WITH t AS (SELECT o_orderkey, o_orderstatus,
                  {money_text(CENTS.format(x='o_totalprice'))} AS texto FROM orders)
SELECT o_orderkey, {digits_money('texto')} AS x2,
       COALESCE({digits_money("CASE WHEN o_orderstatus = 'P' THEN NULL ELSE texto END")}, 0) AS x3
FROM t
"""

ORACLE["money_format_roundtrip"] = f"""
WITH t AS (SELECT o_orderkey, {CENTS.format(x='o_totalprice')} AS cents FROM orders),
f AS (SELECT o_orderkey, cents, {clp('cents')} AS fmt FROM t)
SELECT o_orderkey, fmt, {clean_money('fmt')} AS back,
       {clean_money('fmt')} = cents AS ok
FROM f
"""


def fold16(x: str) -> str:
    return FOLD16.format(x=x)


def fold_full(x: str) -> str:
    return FOLD_FULL.format(x=x)


def _pay_rows_sql(src: str) -> str:
    return f"""
  SELECT organismo_nombre, anyo, Mes, estamento, Nombres, Paterno, Materno, cargo,
         {clean_money('liq')} AS remuliquida_mensual,
         {clean_money('bruta')} AS remuneracionbruta_mensual,
         trim({fold_full("COALESCE(Nombres, '') || ' ' || COALESCE(Paterno, '') || ' ' || COALESCE(Materno, '')")})
           AS search_vector,
         origen
  FROM ({src}) WHERE anyo BETWEEN 2000 AND 2050"""


SUPPLIER_PAY = f"""
    SELECT CAST(s_nationkey AS VARCHAR) AS organismo_nombre,
           TRY_CAST(CAST(1990 + s_nationkey AS VARCHAR) AS INTEGER) AS anyo,
           {MONTHS_SQL}[s_nationkey % 12 + 1] AS Mes, 'Proveedor' AS estamento,
           s_name AS Nombres, CAST(NULL AS VARCHAR) AS Paterno, CAST(NULL AS VARCHAR) AS Materno,
           CAST(NULL AS VARCHAR) AS cargo,
           {money_text(CENTS.format(x='s_acctbal'))} AS liq, CAST(NULL AS VARCHAR) AS bruta,
           'Planta' AS origen
    FROM supplier"""

CUSTOMER_PAY = f"""
    SELECT c_mktsegment AS organismo_nombre,
           TRY_CAST(CAST(2000 + c_nationkey AS VARCHAR) AS INTEGER) AS anyo,
           {MONTHS_SQL}[c_nationkey % 12 + 1] AS Mes, CAST(NULL AS VARCHAR) AS estamento,
           c_name AS Nombres, translate(c_mktsegment, 'AEIOU', 'ÁÉÍÓÚ') AS Paterno,
           CAST(NULL AS VARCHAR) AS Materno, c_mktsegment AS cargo,
           {money_text(CENTS.format(x='c_acctbal'))} AS liq,
           {money_text(CENTS.format(x='c_acctbal') + ' * 2')} AS bruta,
           'Contrata' AS origen
    FROM customer"""

ORACLE["schema_unify"] = f"{_pay_rows_sql(SUPPLIER_PAY)} UNION ALL {_pay_rows_sql(CUSTOMER_PAY)}"

ORACLE["audit_view"] = f"""
SELECT 'Planta' AS Origen, s_name AS Nombres, CAST(NULL AS VARCHAR) AS Paterno,
       CAST(NULL AS VARCHAR) AS Materno, CAST(1990 + s_nationkey AS VARCHAR) AS anyo,
       {MONTHS_SQL}[s_nationkey % 12 + 1] AS Mes, CAST(s_nationkey AS VARCHAR) AS organismo,
       {money_text(CENTS.format(x='s_acctbal'))} AS sueldo, 'Proveedor' AS estamento,
       CAST(NULL AS VARCHAR) AS cargo
FROM supplier
UNION ALL
SELECT 'Contrata', c_name, translate(c_mktsegment, 'AEIOU', 'ÁÉÍÓÚ'), NULL,
       CAST(2000 + c_nationkey AS VARCHAR), {MONTHS_SQL}[c_nationkey % 12 + 1], c_mktsegment,
       {money_text(CENTS.format(x='c_acctbal'))}, NULL, c_mktsegment
FROM customer
"""

ORACLE["ragged_concat"] = f"""
WITH both_ AS (
  SELECT upper(CASE WHEN s_acctbal < 0 THEN '  ' ELSE s_name END) AS Nombres,
         COALESCE(CASE WHEN s_nationkey < 5 THEN NULL ELSE 'Asesor legislativo' END, 'Asesor')
           || ' de ' || COALESCE('Diputado ' || CAST(s_nationkey AS VARCHAR), 'Diputado') AS cargo,
         COALESCE({digits_money(money_text(CENTS.format(x='s_acctbal')))}, 0) AS remuliquida_mensual,
         'supplier' AS fuente
  FROM supplier
  UNION ALL
  SELECT upper(c_name), 'Asesor de Diputado',
         COALESCE({digits_money(money_text(CENTS.format(x='c_acctbal')))}, 0), 'customer'
  FROM customer)
SELECT * FROM both_ WHERE trim(COALESCE(Nombres, '')) <> ''
"""

ORACLE["column_layout"] = """
SELECT c_mktsegment AS "c_mkt segment", c_name, c_custkey, c_acctbal FROM customer
"""


def _capitalize(x: str) -> str:
    return f"(upper(substr({x}, 1, 1)) || lower(substr({x}, 2)))"


ORACLE["month_lookup"] = f"""
WITH t AS (SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS m FROM orders),
n AS (SELECT o_orderkey, m, {MONTHS_SQL}[m] AS nombre FROM t)
SELECT o_orderkey, m, nombre, COALESCE({MONTHS_SQL}[m + 6], 'Enero') AS nombre_mas_6,
       CAST(list_position({MONTHS_SQL}, {_capitalize('upper(nombre)')}) AS INTEGER) AS de_vuelta,
       CAST(COALESCE(list_position({MONTHS_SQL}, {_capitalize("nombre || 'x'")}), 0) AS INTEGER)
         AS desconocido
FROM n
"""

NAME_PARTS = """
  SELECT p_partkey, split_part(p_name, ' ', 1) AS a,
         CASE WHEN p_size < 10 THEN '  ' ELSE ' ' || split_part(p_name, ' ', 2) || ' ' END AS b,
         CASE WHEN p_size > 40 THEN p_brand || '  x' ELSE NULL END AS c
  FROM part"""

ORACLE["person_key"] = f"""
SELECT p_partkey,
       trim(replace(concat_ws(' ', nullif(upper(trim(a)), ''), nullif(upper(trim(b)), ''),
                              nullif(upper(trim(c)), '')), '  ', ' ')) AS llave
FROM ({NAME_PARTS})
"""

ORACLE["audit_full_name"] = f"""
SELECT p_partkey,
       upper(trim(COALESCE(a, '')) || ' ' || trim(COALESCE(b, '')) || ' ' || trim(COALESCE(c, '')))
         AS nombre_completo
FROM ({NAME_PARTS})
"""

ORACLE["pay_with_expenses"] = f"""
WITH spent AS (SELECT o_custkey, strftime(o_orderdate, '%Y-%m') AS month, SUM({CENTS.format(x='o_totalprice')}) AS t
               FROM orders GROUP BY ALL),
pay AS (SELECT CAST(c_custkey % 7 + 1992 AS INTEGER) AS ano, CAST(c_custkey % 12 + 1 AS INTEGER) AS mes,
               c_custkey, {CENTS.format(x='c_acctbal')} AS dieta FROM customer)
SELECT ano, mes, c_custkey AS llave_senador, dieta, CAST(COALESCE(t, 0) AS BIGINT) AS total_gastos_operacionales,
       CAST(dieta + COALESCE(t, 0) AS BIGINT) AS costo_total_mensual
FROM pay LEFT JOIN spent ON o_custkey = c_custkey AND month = printf('%d-%02d', ano, mes)
"""

ORACLE["id_name_lookup"] = """
SELECT e.user_id, e.event_id, upper(c.c_name) AS llave_senador
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
"""

ORACLE["folded_name_link"] = f"""
WITH users AS (SELECT DISTINCT e.user_id, c.c_name FROM events e JOIN customer c ON e.user_id = c.c_custkey),
acc AS (SELECT c_custkey AS linked_custkey,
               translate(upper(c_name), 'AEIOU', 'ÁÉÍÓÚ') AS nombre_acentuado FROM customer)
SELECT u.user_id, u.c_name, a.nombre_acentuado, a.linked_custkey
FROM users u LEFT JOIN acc a
  ON nullif(trim({fold_full('u.c_name')}), '') = nullif(trim({fold_full('a.nombre_acentuado')}), '')
"""

ORACLE["folded_link_hot_name"] = f"""
WITH o AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'José Núñez' WHEN 'P' THEN ' '
                                   ELSE 'Cliente ' || CAST(o_custkey AS VARCHAR) END AS who FROM orders),
c AS (SELECT c_custkey, CASE WHEN c_custkey <= 2 THEN 'JOSE NUÑEZ' ELSE 'CLIENTE ' || CAST(c_custkey AS VARCHAR) END AS nombre
      FROM customer)
SELECT o.o_orderkey, o.who, c.c_custkey, c.nombre FROM o LEFT JOIN c
  ON nullif(trim({fold_full('o.who')}), '') = nullif(trim({fold_full('c.nombre')}), '')
"""

ORACLE["footprint"] = f"""
WITH keyed AS (SELECT o_orderkey, o_custkey AS llave, CAST(year(o_orderdate) AS INTEGER) AS anyo,
                      CAST(month(o_orderdate) AS INTEGER) AS mes, o_totalprice FROM orders),
lines AS (SELECT k.llave, k.anyo, k.mes, l.l_returnflag, l.l_extendedprice, l.l_tax
          FROM lineitem l JOIN keyed k ON l.l_orderkey = k.o_orderkey),
long_ AS (
  SELECT llave, anyo, mes, 'pagos' AS kind, SUM({CENTS.format(x='o_totalprice')}) AS amount
  FROM keyed GROUP BY ALL
  UNION ALL
  SELECT llave, anyo, mes, 'gastos', SUM({CENTS.format(x='l_extendedprice')})
  FROM lines WHERE l_returnflag = 'R' GROUP BY ALL
  UNION ALL
  SELECT llave, anyo, mes, 'viaticos', SUM(CAST(round(l_extendedprice * l_tax * 100) AS BIGINT))
  FROM lines GROUP BY ALL),
wide AS (
  SELECT llave, anyo, mes,
         CAST(COALESCE(SUM(amount) FILTER (WHERE kind = 'pagos'), 0) AS BIGINT) AS pagos,
         CAST(COALESCE(SUM(amount) FILTER (WHERE kind = 'gastos'), 0) AS BIGINT) AS gastos,
         CAST(COALESCE(SUM(amount) FILTER (WHERE kind = 'viaticos'), 0) AS BIGINT) AS viaticos
  FROM long_ GROUP BY ALL)
SELECT *, pagos + gastos + viaticos AS total FROM wide
"""


def strip_tags(x: str) -> str:
    inner = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"),
                    ("&nbsp;", " "), ("&amp;", "&")):
        inner = f"replace({inner}, '{ent}', '{ch}')"
    return f"trim({inner})"


# Anchors found by splitting, not by the library's pattern.
ORACLE["page_links"] = f"""
WITH closed AS (SELECT page_id, unnest(string_split(html, '</a>')) AS s FROM pages),
opened AS (SELECT page_id, string_split(s, '<a ')[-1] AS s FROM closed WHERE contains(s, '<a ')),
x AS (SELECT page_id, split_part(split_part(s, 'href="', 2), '"', 1) AS href,
             {strip_tags("substr(s, instr(s, '>') + 1)")} AS text FROM opened)
SELECT DISTINCT page_id, href, text FROM x WHERE text <> ''
"""

ORACLE["page_title"] = f"""
SELECT page_id,
       regexp_replace({strip_tags("regexp_extract(html, '(?is)<h1\\b[^>]*>(.*?)</h1>', 1)")},
                      '^[Dd]iputad[oa]\\s+', '') AS title
FROM pages
"""

# The first list of a page, cut out by splitting at its tags (lists do not nest here).
_ITEMS = """
items AS (
  SELECT page_id, CAST(generate_subscripts(rws, 1) - 1 AS INTEGER) AS row_no, unnest(rws) AS rw
  FROM (SELECT page_id, list_filter(string_split(split_part(split_part(html, '<ul>', 2), '</ul>', 1), '<li>'),
                                    lambda x: contains(x, '</li>')) AS rws
        FROM pages WHERE contains(html, '<ul>')))"""

ORACLE["page_table_rows"] = f"""
WITH {_ITEMS},
cells AS (SELECT page_id, row_no, list_filter(string_split(split_part(rw, '</li>', 1), '<a '),
                                              lambda x: contains(x, '</a>')) AS cs FROM items)
SELECT page_id, CAST(0 AS INTEGER) AS table_no, row_no,
       array_to_string(list_transform(cs, lambda x: {strip_tags("substr(split_part(x, '</a>', 1), instr(x, '>') + 1)")}),
                       '|') AS cells
FROM cells
"""

ORACLE["page_nested_tables"] = f"""
WITH items AS (
  SELECT page_id, CAST(generate_subscripts(rws, 1) - 1 AS INTEGER) AS row_no, unnest(rws) AS rw
  FROM (SELECT page_id, list_filter(string_split(html, '<li>'), lambda x: contains(x, '</li>')) AS rws FROM pages))
SELECT page_id, CAST(0 AS INTEGER) AS table_no, row_no,
       {strip_tags("split_part(rw, '</li>', 1)")} || '|' || CASE WHEN row_no % 2 = 1 THEN 'in' ELSE '-' END AS cells
FROM items
"""

ORACLE["page_lenient_tables"] = f"""
WITH items AS (
  SELECT page_id, CAST(generate_subscripts(rws, 1) - 1 AS INTEGER) AS row_no, unnest(rws) AS rw
  FROM (SELECT page_id, list_filter(string_split(html, '<li>'), lambda x: contains(x, '</li>')) AS rws FROM pages)),
texts AS (
  SELECT page_id, row_no, {strip_tags("split_part(rw, '</li>', 1)")} AS first,
         'Áñó &lt; &no;' || CASE WHEN row_no % 2 = 1 THEN '   in' ELSE '' END AS second
  FROM items)
SELECT page_id, CAST(0 AS INTEGER) AS table_no, row_no, first || '|' || second || '|' || second AS cells
FROM texts
"""

ORACLE["coverage_gaps"] = """
WITH src AS (SELECT DISTINCT o_orderpriority AS source FROM orders),
cells AS (SELECT source, CAST(y AS INTEGER) AS anyo, CAST(m AS INTEGER) AS mes
          FROM src CROSS JOIN range(1995, 2003) AS r1(y) CROSS JOIN range(1, 13) AS r2(m)),
have AS (SELECT DISTINCT o_orderpriority AS source, year(o_orderdate) AS anyo,
                month(o_orderdate) AS mes FROM orders)
SELECT c.* FROM cells c
WHERE NOT EXISTS (SELECT 1 FROM have h WHERE h.source = c.source AND h.anyo = c.anyo AND h.mes = c.mes)
"""

ORACLE["manifest_diff"] = """
WITH d AS (SELECT *, CAST(regexp_extract(source, '(\\d+)', 1) AS INTEGER) + 1 AS day FROM documents),
remote AS (
  SELECT 'doc_' || CAST(doc_id AS VARCHAR) AS name,
         CASE WHEN n_chars < 50 THEN 0 ELSE n_chars + CASE WHEN lang = 'fr' THEN 1 ELSE 0 END END AS size,
         make_timestamp(2024, 2, day, 8, 30, 0) AS remote_modified
  FROM d WHERE lang <> 'de'),
local_ AS (
  SELECT 'doc_' || CAST(doc_id AS VARCHAR) AS name, n_chars AS size,
         TIMESTAMP '2024-02-10 00:00:00' AS local_modified
  FROM d WHERE lang <> 'es')
SELECT COALESCE(r.name, l.name) AS name, l.size AS local_size, r.size AS remote_size,
       CASE WHEN r.size IS NULL AND l.size IS NOT NULL THEN 'gone'
            WHEN COALESCE(r.size, 0) = 0 THEN 'skip'
            WHEN l.size IS NULL THEN 'download'
            WHEN l.size <> r.size THEN 'download'
            WHEN r.remote_modified IS NOT NULL AND l.local_modified < r.remote_modified THEN 'download'
            ELSE 'up_to_date' END AS action
FROM remote r FULL OUTER JOIN local_ l ON r.name = l.name
"""

ORACLE["json_envelope"] = "SELECT event_id, user_id, event_type, value FROM events"

ORACLE["json_drift"] = """
SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN user_id END AS user_id, event_type,
       CASE WHEN event_id % 11 <> 0 THEN value END AS value
FROM events WHERE (event_id // 500) % 5 < 3
"""

ORACLE["json_quarantine"] = """
WITH e AS (
  SELECT *, event_id // 500 AS page, row_number() OVER (PARTITION BY event_id // 500 ORDER BY event_id) - 1 AS pos
  FROM events),
w AS (
  SELECT *, CASE WHEN page % 2 = 0 THEN '$.data.data[' || pos || '].attributes.' ELSE '$.data[' || pos || '].' END AS item
  FROM e WHERE page % 5 < 3)
SELECT page, item || 'user_id' AS path, 'bigint' AS expected, 'OBJECT' AS found,
       '{"id":' || coalesce(CAST(user_id AS VARCHAR), 'null') || '}' AS value FROM w WHERE event_id % 7 = 0
UNION ALL
SELECT page, item || 'value', 'double', 'STRING', 'n/a' FROM w WHERE event_id % 11 = 0
UNION ALL
SELECT DISTINCT page, '$.data', 'ARRAY', 'missing', NULL FROM e WHERE page % 5 = 3
UNION ALL
SELECT DISTINCT page, '$', 'JSON', 'no JSON', NULL FROM e WHERE page % 5 = 4
"""

BULK_DROP = f"""
    SELECT c_mktsegment AS organismo_nombre,
           TRY_CAST(CAST(1990 + c_nationkey AS VARCHAR) AS INTEGER) AS anyo,
           {MONTHS_SQL}[c_nationkey % 12 + 1] AS Mes, CAST(NULL AS VARCHAR) AS estamento,
           c_name AS Nombres, translate(c_mktsegment, 'AEIOU', 'ÁÉÍÓÚ') AS Paterno,
           CAST(NULL AS VARCHAR) AS Materno, CAST(NULL AS VARCHAR) AS cargo,
           {money_text(CENTS.format(x='c_acctbal'))} AS liq,
           {money_text(CENTS.format(x='c_acctbal') + ' * 2')} AS bruta,
           'Planta' AS origen
    FROM customer"""

ORACLE["csv_ingest"] = _pay_rows_sql(BULK_DROP)

ORACLE["parquet_roundtrip"] = f"""
SELECT * FROM ({_pay_rows_sql(SUPPLIER_PAY)} UNION ALL {_pay_rows_sql(CUSTOMER_PAY)})
WHERE anyo BETWEEN 2005 AND 2010
"""

ORACLE["filename_keys"] = f"""
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'O' THEN CAST(o_custkey % 3 AS INTEGER) END AS id,
       CAST(year(o_orderdate) AS INTEGER) AS anyo,
       CAST(month(o_orderdate) AS INTEGER) AS mes, {CENTS.format(x='o_totalprice')} AS monto
FROM orders
"""

ORACLE["drop_ingest"] = f"""
SELECT *, CASE WHEN organismo_nombre IN ('BUILDING', 'MACHINERY') THEN 'TA_PersonalPlanta_a%41 1.csv'
               ELSE 'TA_PersonalPlanta_b.csv' END AS drop
FROM ({_pay_rows_sql(BULK_DROP)})
"""

ORACLE["drop_generations"] = f"""
SELECT *, CASE WHEN organismo_nombre IN ('BUILDING', 'MACHINERY') THEN '2024/TA_PersonalPlanta.csv'
               WHEN organismo_nombre = 'FURNITURE' THEN '2025/TA_PersonalPlanta.csv' ELSE '2025/TA_PersonalPlanta_otros.csv' END AS drop
FROM ({_pay_rows_sql(BULK_DROP)})
"""

SUMMARISED = f"""
SELECT * REPLACE (CASE WHEN organismo_nombre = 'FURNITURE' THEN 'Contrata' ELSE 'Planta' END AS origen)
FROM ({_pay_rows_sql(BULK_DROP)})"""

ORACLE["catalogue_incremental"] = f"""
SELECT dataset, array_to_string(list_reverse_sort(list_distinct(list(anyo))), ',') AS anios,
       array_to_string(list_sort(list_distinct(list(organismo_nombre))), ',') AS organismos
FROM (SELECT origen AS dataset, anyo, organismo_nombre FROM ({SUMMARISED})
      UNION ALL SELECT 'Todas (Búsqueda Global)', anyo, organismo_nombre FROM ({SUMMARISED}))
GROUP BY dataset
"""

ORACLE["outliers_incremental"] = _outliers_sql(
    f"SELECT organismo_nombre AS organismo, Nombres AS nombre, Mes AS estamento, remuliquida_mensual AS sueldo_num FROM ({SUMMARISED})",
    sigma="1.5", names={"organismo": "organismo_nombre", "nombre": "Nombres", "estamento": "Mes"})

ORACLE["group_stats_incremental"] = f"""
SELECT organismo_nombre, round(avg(remuliquida_mensual), 2) AS promedio, round(stddev_samp(remuliquida_mensual), 2) AS desv
FROM ({SUMMARISED}) WHERE remuliquida_mensual > 0 GROUP BY organismo_nombre HAVING count(*) > 10
"""

ORACLE["histogram_one_scan"] = f"""
WITH v AS (SELECT remuliquida_mensual AS x FROM ({SUMMARISED}) WHERE remuliquida_mensual IS NOT NULL),
     b AS (SELECT min(x) AS lo, max(x) AS hi FROM v)
SELECT CAST(least(COALESCE(floor((20 * (x - lo)) / NULLIF(hi - lo, 0)) + 1, 1), 20) AS INTEGER) AS bin,
       COUNT(*) AS n, min(x) AS bin_min, max(x) AS bin_max
FROM v, b GROUP BY 1
"""

ORACLE["stream_mixed_drops"] = f"""
SELECT *, CASE WHEN organismo_nombre IN ('BUILDING', 'MACHINERY', 'FURNITURE')
               THEN 'TA_PersonalPlanta_' || organismo_nombre || '.csv' ELSE 'new/TA_PersonalPlanta_BUILDING.csv' END AS drop
FROM ({_pay_rows_sql(BULK_DROP)})
"""

ORACLE["report_export"] = f"""
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS Nombre,
       translate(c_mktsegment, 'AEIOU', 'ÁÉÍÓÚ') AS Segmento,
       {clp(CENTS.format(x='c_acctbal'))} AS Saldo
FROM customer
"""

ORACLE["analyst_export"] = f"""
SELECT CAST(ano AS VARCHAR) AS ano, CAST(mes AS VARCHAR) AS mes,
       CAST(llave_senador AS VARCHAR) AS llave_senador, CAST(dieta AS VARCHAR) AS dieta,
       CAST(total_gastos_operacionales AS VARCHAR) AS total_gastos_operacionales,
       CAST(costo_total_mensual AS VARCHAR) AS costo_total_mensual
FROM ({ORACLE['pay_with_expenses']})
"""

ORACLE["stream_ingest"] = f"""
SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS anyo,
       {CENTS.format(x='o_totalprice')} AS monto
FROM orders
"""


def person_key_sql(*parts: str) -> str:
    inner = ", ".join(f"nullif(upper(trim({p})), '')" for p in parts)
    return f"trim(replace(concat_ws(' ', {inner}), '  ', ' '))"


ORACLE["senate_consolidation"] = f"""
WITH oc AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey),
pay AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes,
         c_name AS nombre, c_mktsegment AS appaterno, CAST(NULL AS VARCHAR) AS apmaterno,
         {CENTS.format(x='o_totalprice')} AS dieta, {CENTS.format(x='o_totalprice')} - 1000 AS saldo,
         {person_key_sql('c_name', 'c_mktsegment', 'NULL')} AS llave
  FROM oc),
ex AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes,
         {person_key_sql('c_name', 'c_mktsegment', 'NULL')} AS llave,
         SUM({CENTS.format(x='l_extendedprice')}) AS t
  FROM lineitem JOIN oc ON l_orderkey = o_orderkey GROUP BY ALL),
fin AS (SELECT p.*, p.dieta + COALESCE(e.t, 0) AS costo
        FROM pay p LEFT JOIN ex e USING (ano, mes, llave)),
app AS (
  SELECT 'Senado de la República' AS organismo_nombre, ano AS anyo,
         COALESCE({MONTHS_SQL}[mes], 'Enero') AS Mes, 'Senador(a)' AS estamento,
         COALESCE(upper(nombre), '') AS Nombres, COALESCE(upper(appaterno), '') AS Paterno,
         COALESCE(upper(apmaterno), '') AS Materno, 'Senador(a) de la República' AS cargo,
         CAST(COALESCE(saldo, 0) AS BIGINT) AS remuliquida_mensual,
         CAST(COALESCE(costo, 0) AS BIGINT) AS remuneracionbruta_mensual, 'Senado' AS origen
  FROM fin)
SELECT *, trim({fold_full("concat_ws(' ', Nombres, Paterno, Materno)")}) AS search_vector FROM app
"""

_STAFF = f"""
  SELECT CAST(year(o_orderdate) AS INTEGER) AS anyo, CAST(month(o_orderdate) AS INTEGER) AS mes_id,
         upper(c_name) AS Nombres, @cargo AS cargo,
         COALESCE({digits_money(money_text(CENTS.format(x='o_totalprice')))}, 0) AS liq,
         COALESCE({digits_money(money_text(CENTS.format(x='o_totalprice')))}, 0) AS bruta,
         '@role' AS estamento
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = '@status'"""


def _staff(cargo: str, role: str, status: str) -> str:
    return _STAFF.replace("@cargo", cargo).replace("@role", role).replace("@status", status)

ORACLE["chamber_consolidation"] = f"""
WITH rows_ AS (
  {_staff('o_orderpriority', 'Personal de Planta', 'F')}
  UNION ALL
  {_staff('o_orderpriority', 'Personal a Contrata', 'O')}
  UNION ALL
  {_staff('CAST(NULL AS VARCHAR)', 'Personal a Honorarios', 'P')}
  UNION ALL
  SELECT 2024, s_nationkey % 12 + 1,
         upper(CASE WHEN s_acctbal < 0 THEN ' ' ELSE s_name END),
         COALESCE(CASE WHEN s_nationkey < 5 THEN NULL ELSE 'Asesor' END, 'Asesor') || ' de '
           || 'Dip. ' || CAST(s_nationkey AS VARCHAR),
         COALESCE({digits_money(money_text(CENTS.format(x='s_acctbal')))}, 0),
         COALESCE({digits_money(money_text(CENTS.format(x='s_acctbal')))}, 0),
         'Personal de Apoyo Parlamentario'
  FROM supplier
  UNION ALL
  SELECT 2024, c_nationkey % 12 + 1, upper(c_name), 'Diputado',
         CASE WHEN c_custkey % 5 <> 0 THEN {CENTS.format(x='c_acctbal')} - 1000 END,
         {CENTS.format(x='c_acctbal')}, 'Diputado(a)'
  FROM customer),
app AS (
  SELECT 'Cámara de Diputadas y Diputados' AS organismo_nombre, anyo, {MONTHS_SQL}[mes_id] AS Mes,
         estamento, COALESCE(Nombres, '') AS Nombres, '' AS Paterno, '' AS Materno,
         COALESCE(cargo, 'Funcionario/a') AS cargo, CAST(COALESCE(liq, 0) AS BIGINT) AS remuliquida_mensual,
         CAST(COALESCE(bruta, 0) AS BIGINT) AS remuneracionbruta_mensual,
         'Cámara de Diputados' AS origen
  FROM rows_)
SELECT *, trim({fold_full("concat_ws(' ', Nombres, Paterno, Materno)")}) AS search_vector
FROM app WHERE trim(COALESCE(Nombres, '')) <> ''
"""

ORACLE["catalogue_json"] = ORACLE["catalogue"]

ORACLE["senate_extract"] = f"""
WITH oc AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey),
pay AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes,
         CAST(c_custkey AS VARCHAR) AS rut, {CENTS.format(x='o_totalprice')} AS dieta,
         {CENTS.format(x='o_totalprice')} - 1000 AS saldo,
         {person_key_sql('c_name', 'c_mktsegment', 'NULL')} AS llave_senador
  FROM oc),
ex AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes,
         {person_key_sql('c_name', 'c_mktsegment', 'NULL')} AS llave_senador,
         SUM({CENTS.format(x='l_extendedprice')}) AS t
  FROM lineitem JOIN oc ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT p.ano, p.mes, p.rut, p.llave_senador, p.dieta, p.saldo,
       CAST(COALESCE(e.t, 0) AS BIGINT) AS total_gastos_operacionales,
       CAST(p.dieta + COALESCE(e.t, 0) AS BIGINT) AS costo_total_mensual
FROM pay p LEFT JOIN ex e USING (ano, mes, llave_senador)
"""

ORACLE["chamber_expenses"] = f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS anyo, CAST(month(o_orderdate) AS INTEGER) AS Mes,
       upper(r_name) || ' JR' AS llave_senador, l_returnflag AS gastos_operacionales,
       COALESCE({digits_money(money_text(CENTS.format(x='l_extendedprice')))}, 0) AS monto,
       'Cámara de Diputadas y Diputados' AS organismo_nombre
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
     JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey
"""

ORACLE["monthly_items"] = """
SELECT event_id, user_id, value, event_type AS category, CAST(year(ts) AS INTEGER) AS ano,
       CAST(month(ts) AS INTEGER) AS mes
FROM events
"""

ORACLE["person_expenses"] = f"""
SELECT gastos_operacionales AS Concepto, CAST(SUM(monto) AS BIGINT) AS Monto
FROM ({LINE_EXPENSES})
WHERE l_linestatus IN ('O', 'F') AND anyo = 1995 AND Mes = 5 AND llave_senador = 66
GROUP BY 1
"""

ORACLE["search_union"] = f"""
SELECT organismo_nombre, anyo, Mes, estamento, Nombres, Paterno, Materno, cargo,
       remuliquida_mensual, remuneracionbruta_mensual, origen
FROM ({_pay_rows_sql(SUPPLIER_PAY)} UNION ALL {_pay_rows_sql(CUSTOMER_PAY)})
WHERE search_vector LIKE '%customer#00000001%' AND anyo BETWEEN 2000 AND 2020
ORDER BY organismo_nombre NULLS LAST, anyo NULLS LAST, Mes NULLS LAST, estamento NULLS LAST,
         Nombres NULLS LAST, Paterno NULLS LAST, Materno NULLS LAST, cargo NULLS LAST,
         remuliquida_mensual NULLS LAST, remuneracionbruta_mensual NULLS LAST, origen NULLS LAST
LIMIT 500
"""

ORACLE["search_fallback"] = f"""
SELECT anyo, Mes, organismo_nombre, origen, Nombres
FROM ({_pay_rows_sql(SUPPLIER_PAY)} UNION ALL {_pay_rows_sql(CUSTOMER_PAY)})
WHERE search_vector LIKE '%customer#00000001%'
ORDER BY anyo DESC NULLS LAST, coalesce(list_position({MONTHS_SQL}, Mes), 0) DESC, Nombres DESC NULLS LAST
LIMIT 1
"""

ORACLE["audit_from_raw"] = f"""
WITH v AS ({ORACLE['audit_view']}),
r AS (
  SELECT Origen, organismo, Mes, cargo,
         upper(trim(COALESCE(Nombres, '')) || ' ' || trim(COALESCE(Paterno, '')) || ' '
               || trim(COALESCE(Materno, ''))) AS nombre_completo,
         TRY_CAST(anyo AS INTEGER) AS anyo, {digits_money('sueldo')} AS sueldo_num
  FROM v)
SELECT organismo, nombre_completo, sueldo_num, Origen, cargo FROM r
WHERE sueldo_num IS NOT NULL AND anyo = 2005 AND Mes = 'Junio'
ORDER BY sueldo_num DESC, nombre_completo ASC NULLS LAST, organismo ASC NULLS LAST,
         Origen ASC NULLS LAST, cargo ASC NULLS LAST
LIMIT 100
"""

ORACLE["pay_with_expenses_bucketed"] = f"""
WITH pay AS (SELECT 1998 AS ano, 3 AS mes, c_custkey AS llave_senador,
                    {CENTS.format(x='c_acctbal')} AS dieta FROM customer),
spent AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes,
                 o_custkey AS llave_senador, SUM({CENTS.format(x='o_totalprice')}) AS t
          FROM orders GROUP BY ALL)
SELECT p.ano, p.mes, p.llave_senador, p.dieta,
       CAST(COALESCE(s.t, 0) AS BIGINT) AS total_gastos_operacionales,
       CAST(p.dieta + COALESCE(s.t, 0) AS BIGINT) AS costo_total_mensual
FROM pay p LEFT JOIN spent s USING (ano, mes, llave_senador)
"""


def person_key_keep_case(*parts: str) -> str:
    inner = ", ".join(f"nullif(trim({p}), '')" for p in parts)
    return f"trim(replace(concat_ws(' ', {inner}), '  ', ' '))"


ORACLE["senate_expense_detail"] = f"""
WITH oc AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey),
people AS (
  SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS anyo, CAST(month(o_orderdate) AS INTEGER) AS Mes,
         {person_key_keep_case('upper(c_name)', 'upper(c_mktsegment)', "''")} AS llave_senador
  FROM oc WHERE year(o_orderdate) = 1996 AND month(o_orderdate) = 3),
ex AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS anyo, CAST(month(o_orderdate) AS INTEGER) AS Mes,
         {person_key_sql('c_name', 'c_mktsegment', 'NULL')} AS llave_senador,
         l_returnflag AS Concepto, {CENTS.format(x='l_extendedprice')} AS monto
  FROM lineitem JOIN oc ON l_orderkey = o_orderkey)
SELECT e.anyo, e.Mes, e.llave_senador, e.Concepto, CAST(SUM(e.monto) AS BIGINT) AS Monto
FROM ex e JOIN people p USING (anyo, Mes, llave_senador)
GROUP BY ALL
"""

ORACLE["lake_surname_audit"] = surname_sql(
    "organismo_nombre", "Paterno", "remuliquida_mensual",
    f"({_pay_rows_sql(SUPPLIER_PAY)} AND Mes = 'Junio' AND anyo = 2005 UNION ALL "
    f"{_pay_rows_sql(CUSTOMER_PAY)} AND Mes = 'Junio' AND anyo = 2005)")

ORACLE["lake_search"] = f"""
SELECT organismo_nombre, anyo, Mes, estamento, Nombres, Paterno, Materno, cargo,
       remuliquida_mensual, remuneracionbruta_mensual, origen
FROM ({_pay_rows_sql(SUPPLIER_PAY)} UNION ALL {_pay_rows_sql(CUSTOMER_PAY)})
WHERE search_vector LIKE '%customer#00000001%' AND anyo BETWEEN 2003 AND 2012
ORDER BY organismo_nombre NULLS LAST, anyo NULLS LAST, Mes NULLS LAST, estamento NULLS LAST,
         Nombres NULLS LAST, Paterno NULLS LAST, Materno NULLS LAST, cargo NULLS LAST,
         remuliquida_mensual NULLS LAST, remuneracionbruta_mensual NULLS LAST, origen NULLS LAST
LIMIT 500
"""
