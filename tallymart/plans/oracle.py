"""DuckDB SQL for every registered query, written independently of the
Spark code from the semantics each operator promises.

Two DuckDB differences are handled explicitly: ``TRY_CAST`` accepts
``'1.5'``, ``'1e3'`` or ``'0x1F'`` as integers, so integer parsing is guarded
by a full-match on optional sign + digits; and ``regexp_replace`` needs the
``'g'`` flag to replace every match.
"""

from __future__ import annotations

from tallymart.plans.fixture import FIXTURE_CATEGORIES, FIXTURE_PATTERN_A, FIXTURE_PATTERN_B


def sql_int(expr: str) -> str:
    """Integer parse with Spark ``try_cast`` semantics: digits only, else NULL."""
    return f"CASE WHEN regexp_full_match(trim({expr}), '[+-]?[0-9]+') THEN TRY_CAST(trim({expr}) AS INTEGER) END"


def sql_pad(expr: str, width: int) -> str:
    return f"lpad(right({expr}, {width}), {width}, '0')"


def sql_label(*parts: str) -> str:
    inner = f"concat_ws(' ', {', '.join(parts)})"
    return f"trim(regexp_replace(regexp_replace({inner}, '[^\\w\\s]', '', 'g'), '\\s{{2,}}', ' ', 'g'))"


def _clean(col: str) -> str:
    return f"CASE WHEN trim({col}) = '\\N' THEN NULL ELSE trim({col}) END AS {col}"


_BRONZE_COLS = [
    "dist_codigo", "secc_codigo", "secc_descrip", "circ_codigo", "circ_descrip", "zona_codigo",
    "carg_codigo", "ppar_codigo", "ppar_descrip", "cant", "totins",
]
_CATS = ", ".join(f"'{c}'" for c in FIXTURE_CATEGORIES)

# Fixture tally: raw rows -> bronze -> normalised -> classified -> silver.
FIXTURE_CTES = f"""
mesas AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderpriority, o.o_totalprice,
         c.c_nationkey, c.c_mktsegment, n.n_name, n.n_regionkey
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
raw AS (
  SELECT CAST(m.n_regionkey AS VARCHAR) AS dist_codigo,
         CAST(m.c_nationkey AS VARCHAR) AS secc_codigo,
         ' ' || m.n_name || ' ' AS secc_descrip,
         CASE WHEN m.c_mktsegment = 'MACHINERY' THEN '\\N' ELSE CAST(m.o_custkey AS VARCHAR) END AS circ_codigo,
         CASE WHEN m.c_mktsegment = 'HOUSEHOLD' THEN '' ELSE m.c_mktsegment END AS circ_descrip,
         CAST(m.o_orderkey AS VARCHAR) AS zona_codigo,
         l.l_returnflag || l.l_linestatus AS carg_codigo,
         CAST(l.l_linenumber AS VARCHAR) AS ppar_codigo,
         'Agrupación Nº ' || CAST(l.l_suppkey AS VARCHAR) AS ppar_descrip,
         CASE WHEN l.l_discount = CAST(0.1 AS DOUBLE) AND l.l_tax = CAST(0.08 AS DOUBLE) THEN '1.5'
              WHEN l.l_discount = CAST(0.0 AS DOUBLE) AND l.l_tax = CAST(0.0 AS DOUBLE)
                THEN CAST(-CAST(l.l_quantity AS INTEGER) AS VARCHAR)
              ELSE CAST(CAST(l.l_quantity AS INTEGER) AS VARCHAR) END AS cant,
         CASE WHEN m.o_orderstatus = 'P' AND m.o_orderpriority = '5-LOW' THEN 'n/a'
              ELSE CAST(CAST(floor(m.o_totalprice / 100) AS BIGINT) AS VARCHAR) END AS totins
  FROM lineitem l JOIN mesas m ON l.l_orderkey = m.o_orderkey
),
bronze AS (
  SELECT {", ".join(_clean(c) for c in _BRONZE_COLS)} FROM raw
),
s0 AS (
  SELECT NULLIF(dist_codigo, '') AS distrito, NULLIF(secc_codigo, '') AS seccion,
         NULLIF(secc_descrip, '') AS seccion_descripcion, NULLIF(circ_codigo, '') AS circuito,
         NULLIF(circ_descrip, '') AS circuito_descripcion, NULLIF(zona_codigo, '') AS mesa,
         NULLIF(carg_codigo, '') AS categoria, NULLIF(ppar_codigo, '') AS campo_numero,
         NULLIF(ppar_descrip, '') AS campo_descripcion, NULLIF(cant, '') AS cant_txt,
         NULLIF(totins, '') AS totins_txt
  FROM bronze
),
s1 AS (
  SELECT {sql_pad('distrito', 2)} AS distrito, {sql_pad('seccion', 3)} AS seccion, seccion_descripcion,
         {sql_pad('circuito', 12)} AS circuito, circuito_descripcion, {sql_pad('mesa', 12)} AS mesa,
         categoria, {sql_pad('campo_numero', 3)} AS campo_numero, campo_descripcion,
         {sql_int('cant_txt')} AS cantidad, {sql_int('totins_txt')} AS inscriptos
  FROM s0
),
s2 AS (
  SELECT coalesce(distrito, 'NN') || coalesce(seccion, 'NNN') || coalesce(circuito, 'NNNNNNNNNNNN')
           || coalesce(mesa, 'NNNNNNNNNNNN') || 'X' AS id_mesa,
         *,
         {sql_label('campo_numero', 'campo_descripcion')} AS campo,
         CASE WHEN campo_numero IN ('000', '003', '004', '005', '006', '007') THEN 'MESA' ELSE 'AGRUPACION' END
           AS registro
  FROM s1
),
flags AS (
  SELECT id_mesa,
         max(CASE WHEN cantidad < 0 THEN 1 ELSE 0 END) AS f0,
         max(CASE WHEN regexp_matches(upper(coalesce(seccion_descripcion, '')), '{FIXTURE_PATTERN_A}') THEN 1 ELSE 0 END) AS f1,
         max(CASE WHEN regexp_matches(upper(coalesce(seccion_descripcion, '')), '{FIXTURE_PATTERN_B}') THEN 1 ELSE 0 END) AS f2
  FROM s2 GROUP BY id_mesa
),
classified AS (
  SELECT s2.*, CASE WHEN f0 = 1 THEN 'COMPENSATORIA' WHEN f1 = 1 THEN 'RESIDENTES_EXTERIOR'
                    WHEN f2 = 1 THEN 'PRIVADOS_LIBERTAD' ELSE 'NORMAL' END AS tipo_mesa
  FROM s2 JOIN flags USING (id_mesa)
),
silver AS (
  SELECT id_mesa, distrito, seccion, seccion_descripcion, circuito, circuito_descripcion, mesa, categoria,
         campo, campo_numero, campo_descripcion, cantidad, registro, tipo_mesa
  FROM classified
  UNION ALL
  SELECT id_mesa, distrito, seccion, seccion_descripcion, circuito, circuito_descripcion, mesa, categoria,
         concat_ws(' ', '000', 'INSCRIPTOS') AS campo, '000' AS campo_numero, 'INSCRIPTOS' AS campo_descripcion,
         coalesce(inscriptos, 0) AS cantidad, registro, tipo_mesa
  FROM classified WHERE campo_numero = '007'
),
totals AS (
  SELECT categoria, id_mesa, distrito, seccion, seccion_descripcion, circuito, circuito_descripcion, mesa, tipo_mesa,
         max(CASE WHEN campo_numero = '000' THEN cantidad END) AS inscriptos,
         max(CASE WHEN campo_numero = '003' THEN cantidad END) AS votos_blanco,
         max(CASE WHEN campo_numero = '004' THEN cantidad END) AS votos_nulos,
         max(CASE WHEN campo_numero = '005' THEN cantidad END) AS votos_recurridos,
         max(CASE WHEN campo_numero = '006' THEN cantidad END) AS votos_impugnados,
         max(CASE WHEN campo_numero = '007' THEN cantidad END) AS votos_totales
  FROM silver WHERE registro = 'MESA'
  GROUP BY categoria, id_mesa, distrito, seccion, seccion_descripcion, circuito, circuito_descripcion, mesa, tipo_mesa
),
lists AS (
  SELECT categoria, id_mesa, CAST(sum(cantidad) AS BIGINT) AS votos_afirmativos, count(*) AS listas
  FROM silver WHERE registro = 'AGRUPACION' GROUP BY categoria, id_mesa
),
mart AS (
  SELECT t.categoria, t.id_mesa, t.distrito, t.seccion, t.seccion_descripcion, t.circuito, t.circuito_descripcion,
         t.mesa, t.tipo_mesa, l.listas, t.inscriptos, l.votos_afirmativos, t.votos_blanco, t.votos_nulos,
         t.votos_recurridos, t.votos_impugnados, t.votos_totales
  FROM totals t LEFT JOIN lists l ON t.categoria = l.categoria AND t.id_mesa = l.id_mesa
),
dim_mesa AS (
  SELECT DISTINCT id_mesa, concat_ws('', distrito, seccion, circuito) AS id_circuito, mesa, tipo_mesa FROM silver
),
dim_circuito AS (
  SELECT DISTINCT concat_ws('', distrito, seccion, circuito) AS id_circuito, concat_ws('', distrito, seccion) AS id_seccion,
         circuito AS circuito_numero, circuito_descripcion
  FROM silver WHERE circuito IS NOT NULL
),
dim_seccion AS (
  SELECT DISTINCT concat_ws('', distrito, seccion) AS id_seccion, distrito AS id_distrito, seccion AS seccion_numero,
         seccion_descripcion
  FROM silver WHERE seccion IS NOT NULL
),
dim_distrito AS (
  SELECT id_distrito, CASE id_distrito WHEN '00' THEN 'AFRICA' WHEN '01' THEN 'AMERICA' WHEN '02' THEN 'ASIA'
                                       WHEN '03' THEN 'EUROPE' END AS distrito
  FROM (SELECT DISTINCT distrito AS id_distrito FROM silver)
),
dim_categoria AS (
  SELECT DISTINCT categoria AS id_categoria, categoria AS codigo FROM silver
),
dim_campo AS (
  SELECT DISTINCT concat_ws('-', distrito, categoria, campo_numero, campo_descripcion) AS id_campo,
         distrito AS id_distrito, categoria AS id_categoria, campo_numero, campo_descripcion
  FROM silver
),
fact AS (
  SELECT id_mesa, concat_ws('-', distrito, categoria, campo_numero, campo_descripcion) AS id_campo, cantidad FROM silver
)
"""


def fixture(select: str) -> str:
    return f"WITH {FIXTURE_CTES} {select}"


SILVER_COLS = (
    "id_mesa, distrito, seccion, seccion_descripcion, circuito, circuito_descripcion, mesa, categoria, "
    "campo, campo_numero, campo_descripcion, cantidad, registro, tipo_mesa"
)

# Source families written by the ingest queries (see catalog.py).
INGEST_EXPECTED = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW", "6-NONE"]
INGEST_BAD = "(o_orderpriority = '5-LOW' AND o_orderstatus = 'P') OR (o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')"

_NULL_CONTRACT_ROWS = [
    ("id_mesa", 0, False), ("distrito", 1, False), ("seccion", 2, True), ("seccion_descripcion", 3, True),
    ("circuito", 4, False), ("circuito_descripcion", 5, True), ("mesa", 6, True), ("categoria", 7, False),
    ("campo", 8, True), ("campo_numero", 9, True), ("campo_descripcion", 10, True), ("cantidad", 11, False),
    ("registro", 12, True), ("tipo_mesa", 13, True),
]


def _null_contract_sql() -> str:
    parts = []
    for name, pos, nullable in _NULL_CONTRACT_ROWS:
        nulls = f"(SELECT count(*) FROM silver WHERE {name} IS NULL)"
        violated = "false" if nullable else f"({nulls} > 0)"
        parts.append(
            f"SELECT '{name}' AS \"column\", CAST({pos} AS INTEGER) AS position, {str(nullable).lower()} AS nullable, "
            f"CAST({nulls} AS BIGINT) AS nulls, {violated} AS violated"
        )
    return fixture(" UNION ALL ".join(parts))


_GOLD_PK = [
    ("dim_distrito", "id_distrito"), ("dim_seccion", "id_seccion"), ("dim_circuito", "id_circuito"),
    ("dim_mesa", "id_mesa"), ("dim_categoria", "id_categoria"), ("dim_campo", "id_campo"),
    ("fact", "id_mesa, id_campo"), ("mart", "categoria, id_mesa"),
]
_GOLD_NAMES = {"fact": "fact_resultados", "mart": "resumen_mesa"}
_GOLD_NOT_NULL = {
    "dim_distrito": ["id_distrito", "distrito"],
    "dim_seccion": ["id_seccion", "id_distrito", "seccion_numero"],
    "dim_circuito": ["id_circuito", "id_seccion"],
    "dim_mesa": ["id_mesa", "id_circuito", "mesa", "tipo_mesa"],
    "dim_categoria": ["id_categoria", "codigo"],
    "dim_campo": ["id_campo", "id_distrito", "id_categoria", "campo_descripcion"],
    "fact": ["id_mesa", "id_campo", "cantidad"],
    "mart": ["categoria", "id_mesa", "distrito"],
}
_GOLD_FK = [
    ("dim_seccion", "id_distrito", "dim_distrito", "id_distrito"),
    ("dim_circuito", "id_seccion", "dim_seccion", "id_seccion"),
    ("dim_mesa", "id_circuito", "dim_circuito", "id_circuito"),
    ("fact", "id_mesa", "dim_mesa", "id_mesa"),
    ("fact", "id_campo", "dim_campo", "id_campo"),
]


def _gold_checks_sql() -> str:
    parts = []
    for table, key in _GOLD_PK:
        name = _GOLD_NAMES.get(table, table)
        parts.append(
            f"SELECT 'primary_key' AS \"check\", '{name}' AS \"table\", '{key.replace(' ', '')}' AS detail, "
            f"CAST((SELECT count(*) FROM (SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1)) AS BIGINT) AS violations"
        )
        for col in _GOLD_NOT_NULL[table]:
            parts.append(
                f"SELECT 'not_null', '{name}', '{col}', CAST((SELECT count(*) FROM {table} WHERE {col} IS NULL) AS BIGINT)"
            )
    for child, col, parent, pcol in _GOLD_FK:
        cname = _GOLD_NAMES.get(child, child)
        parts.append(
            f"SELECT 'foreign_key', '{cname}', '{col} -> {parent}({pcol})', "
            f"CAST((SELECT count(*) FROM {child} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} p WHERE p.{pcol} = c.{col})) AS BIGINT)"
        )
    return fixture(" UNION ALL ".join(parts))


_LINE = "concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus, o_orderpriority)"
_SOURCES = f"""
        counts AS (
          SELECT o_orderpriority AS source, count(*) AS n, count(*) FILTER (WHERE {INGEST_BAD}) AS bad
          FROM orders GROUP BY o_orderpriority),
        expected(source) AS (VALUES {", ".join(f"('{x}')" for x in INGEST_EXPECTED)}),
        status AS (
          SELECT coalesce(e.source, c.source) AS source, coalesce(c.n, 0) AS n,
                 CASE WHEN e.source IS NULL THEN 'UNEXPECTED' WHEN coalesce(c.n, 0) = 0 THEN 'NO_ROWS'
                      WHEN coalesce(c.bad, 0) > 0 THEN 'MALFORMED' ELSE 'OK' END AS status
          FROM expected e FULL OUTER JOIN counts c ON e.source = c.source)"""

# Rule, condition on rows of silver (NOT NULL of the contracts).
_CONTRACT_RULES = [
    ("silver_id_mesa", "id_mesa IS NULL"), ("silver_distrito", "distrito IS NULL"), ("silver_categoria", "categoria IS NULL"),
    ("fact_resultados_id_mesa", "id_mesa IS NULL"), ("fact_resultados_id_campo", "false"),
    ("fact_resultados_cantidad", "cantidad IS NULL"),
    ("dim_mesa_id_mesa", "id_mesa IS NULL"), ("dim_mesa_id_circuito", "false"), ("dim_mesa_mesa", "mesa IS NULL"),
    ("dim_mesa_tipo_mesa", "tipo_mesa IS NULL"),
    ("dim_circuito_id_circuito", "false"), ("dim_circuito_id_seccion", "false"),
    ("dim_seccion_id_seccion", "false"), ("dim_seccion_id_distrito", "seccion IS NOT NULL AND distrito IS NULL"),
    ("dim_seccion_seccion_numero", "false"),
    ("dim_distrito_id_distrito", "distrito IS NULL"),
    ("dim_distrito_distrito", "distrito IS NULL OR distrito NOT IN ('00', '01', '02', '03')"),
    ("dim_categoria_id_categoria", "categoria IS NULL"), ("dim_categoria_codigo", "categoria IS NULL"),
    ("dim_campo_id_campo", "false"), ("dim_campo_id_distrito", "distrito IS NULL"),
    ("dim_campo_id_categoria", "categoria IS NULL"), ("dim_campo_campo_descripcion", "campo_descripcion IS NULL"),
    ("resumen_mesa_categoria", "registro = 'MESA' AND categoria IS NULL"),
    ("resumen_mesa_id_mesa", "registro = 'MESA' AND id_mesa IS NULL"),
    ("resumen_mesa_distrito", "registro = 'MESA' AND distrito IS NULL"),
]
_GEO_NULL = ("tipo_mesa = 'NORMAL' AND (id_mesa IS NULL OR distrito IS NULL OR seccion IS NULL OR circuito IS NULL "
             "OR mesa IS NULL)")
_ROW_RULES = [
    ("normal_geo_complete", _GEO_NULL), ("category_domain", f"NOT (categoria IN ({_CATS}))"),
    ("count_not_null", "cantidad IS NULL"), ("id_length", "length(id_mesa) != 30"),
    *[(f"not_null_{name}", condition) for name, condition in _CONTRACT_RULES],
]
_ATTRIBUTES = ("distrito", "seccion", "seccion_descripcion", "circuito", "circuito_descripcion", "mesa", "tipo_mesa")


def _spelled(select: str) -> str:
    """Silver whose descriptions vary by line, as ``spelled``."""
    return fixture(f"""
        , spelled AS (
          SELECT * REPLACE (
            CASE WHEN campo_numero = '001' THEN lower(seccion_descripcion) ELSE seccion_descripcion END AS seccion_descripcion,
            CASE WHEN campo_numero IN ('002', '003', '007') THEN NULL ELSE circuito_descripcion END AS circuito_descripcion)
          FROM silver)
        {select}""")


def _one_sql(key: str, columns: dict[str, str], kept: str) -> str:
    listed = ", ".join(f"{e} AS {n}" for n, e in columns.items())
    rest = ", ".join(f"{c} IS NULL, {c}" for c in columns if c != key)
    return _spelled(f"""
        SELECT {", ".join(columns)} FROM (
          SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY n DESC, {rest}) AS k
          FROM (SELECT {listed}, count(*) AS n FROM spelled WHERE {kept} IS NOT NULL GROUP BY ALL))
        WHERE k = 1""")


def _summary_one_sql() -> str:
    order = ", ".join(f"{c} IS NULL, {c}" for c in _ATTRIBUTES)
    codes = {"inscriptos": "000", "votos_blanco": "003", "votos_nulos": "004", "votos_recurridos": "005",
             "votos_impugnados": "006", "votos_totales": "007"}
    cells = ", ".join(f"max(CASE WHEN registro = 'MESA' AND campo_numero = '{v}' THEN cantidad END) AS {c}" for c, v in codes.items())
    return _spelled(f"""
        , chosen AS (
          SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY categoria, id_mesa ORDER BY n DESC, {order}) AS k
            FROM (SELECT categoria, id_mesa, {", ".join(_ATTRIBUTES)}, count(*) AS n FROM spelled
                  WHERE registro = 'MESA' GROUP BY ALL)) WHERE k = 1),
        cells AS (
          SELECT categoria, id_mesa, {cells}, CAST(sum(CASE WHEN registro = 'AGRUPACION' THEN cantidad END) AS BIGINT) AS total,
                 count(*) FILTER (WHERE registro = 'AGRUPACION') AS lists
          FROM spelled GROUP BY categoria, id_mesa)
        SELECT c.categoria, c.id_mesa, {", ".join("c." + a for a in _ATTRIBUTES)},
               CASE WHEN lists > 0 THEN lists END AS listas, {", ".join(codes)},
               CASE WHEN lists > 0 THEN total END AS votos_afirmativos
        FROM chosen c JOIN cells x ON c.categoria = x.categoria AND c.id_mesa = x.id_mesa""")


ORACLE_SQL: dict[str, str] = {
    "csv_ingest": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE c_mktsegment END AS c_mktsegment
        FROM customer""",
    "ingest_report": f"""
        WITH counts AS (
          SELECT o_orderpriority AS source, count(*) AS n, count(*) FILTER (WHERE {INGEST_BAD}) AS bad
          FROM orders GROUP BY o_orderpriority),
        expected(source) AS (VALUES {", ".join(f"('{s}')" for s in INGEST_EXPECTED)})
        SELECT coalesce(e.source, c.source) AS source, CAST(coalesce(c.n, 0) AS BIGINT) AS rows,
               CAST(coalesce(c.bad, 0) AS BIGINT) AS bad_rows, CAST(0 AS BIGINT) AS null_key_rows,
               CASE WHEN e.source IS NULL THEN 'UNEXPECTED' WHEN coalesce(c.n, 0) = 0 THEN 'NO_ROWS'
                    WHEN coalesce(c.bad, 0) > 0 THEN 'MALFORMED' ELSE 'OK' END AS status
        FROM expected e FULL OUTER JOIN counts c ON e.source = c.source""",
    "ingest_clean": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
               o_orderstatus, o_orderpriority, o_orderpriority AS _source
        FROM orders
        WHERE o_orderpriority NOT IN (SELECT o_orderpriority FROM orders WHERE {INGEST_BAD})
          AND o_orderpriority IN ({", ".join(f"'{s}'" for s in INGEST_EXPECTED)})""",
    "ingest_rejects": f"""
        WITH {_SOURCES},
        lines AS (
          SELECT o_orderpriority AS source, {_LINE} AS line,
                 CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'TOO_MANY_FIELDS'
                      WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'TOO_FEW_FIELDS' END AS fault
          FROM orders)
        SELECT l.source, coalesce(fault, 'SOURCE_' || status) AS reason,
               CASE fault WHEN 'TOO_MANY_FIELDS' THEN line || '|extra'
                          WHEN 'TOO_FEW_FIELDS' THEN left(line, length(line) - length(l.source) - 1) ELSE line END AS line
        FROM lines l JOIN status s ON l.source = s.source WHERE status <> 'OK'""",
    "ingest_balance": f"""
        WITH {_SOURCES}
        SELECT source, n AS lines, CASE WHEN status = 'OK' THEN n ELSE 0 END AS loaded,
               CASE WHEN status = 'OK' THEN 0 ELSE n END AS rejected FROM status WHERE n > 0""",
    "ingest_unreadable": f"""
        WITH {_SOURCES},
        found AS (
          SELECT source, n, CASE WHEN source = '2-HIGH' THEN 'INCOMPLETE' WHEN source = '3-MEDIUM' THEN 'UNREADABLE'
                                 WHEN status = 'MALFORMED' THEN 'OK' ELSE status END AS status FROM status)
        SELECT source, status, status IN ('INCOMPLETE', 'UNREADABLE') AS explained,
               CASE WHEN status = 'OK' THEN n ELSE 0 END AS loaded FROM found""",
    "district_reload": fixture("""
        SELECT dist_codigo, zona_codigo, carg_codigo, ppar_codigo, ppar_descrip,
               CASE WHEN dist_codigo = '2' THEN '0' ELSE cant END AS cant,
               CASE WHEN dist_codigo = '2' THEN 'second' ELSE 'first' END AS delivery
        FROM bronze WHERE NOT (dist_codigo = '2' AND ppar_codigo > '3')"""),
    "provenance": """
        SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority AS source, o_orderpriority AS folder,
               true AS stamped
        FROM orders""",
    "publish_roundtrip": """
        SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus FROM orders""",
    "project_rename": """
        SELECT c_custkey AS circuito, c_name AS circuito_descripcion, c_nationkey AS seccion FROM customer""",
    "null_sentinel": """
        SELECT event_id, CASE WHEN trim(event_type) = 'error' THEN NULL ELSE trim(event_type) END AS event_type
        FROM events""",
    "blank_to_null": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
               o_orderpriority
        FROM orders""",
    "pad_code": f"""
        SELECT o_orderkey, {sql_pad('CAST(o_custkey AS VARCHAR)', 3)} AS cust_code,
               {sql_pad('CAST(o_orderkey AS VARCHAR)', 5)} AS order_code,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE {sql_pad('o_orderstatus', 2)} END AS status_code
        FROM orders""",
    "composite_id": f"""
        SELECT c_custkey,
               coalesce(CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE {sql_pad('CAST(c_nationkey AS VARCHAR)', 3)} END, 'NNN')
               || coalesce({sql_pad('CAST(c_custkey AS VARCHAR)', 5)}, 'NNNNN') || 'X' AS id
        FROM customer""",
    "clean_label": f"""
        SELECT doc_id, {sql_label('CAST(doc_id AS VARCHAR)', 'text')} AS label FROM documents""",
    "safe_int": f"""
        SELECT event_id,
               {sql_int("regexp_extract(props, '(-?[0-9]+)', 1)")} AS prop_int,
               {sql_int('event_type')} AS type_int,
               coalesce({sql_int('event_type')}, 0) AS type_int_or_zero,
               {sql_int('CAST(user_id AS VARCHAR)')} AS user_int
        FROM events""",
    "row_kind": """
        SELECT o_orderkey,
               CASE WHEN (CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END) IN ('1-URGENT', '2-HIGH')
                    THEN 'MESA' ELSE 'AGRUPACION' END AS kind
        FROM orders""",
    "path_key": f"""
        SELECT c_custkey,
               concat_ws('', {sql_pad('CAST(c_nationkey AS VARCHAR)', 3)},
                         CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL ELSE {sql_pad('CAST(c_custkey AS VARCHAR)', 5)} END)
                 AS id_path
        FROM customer""",
    "joined_key": """
        SELECT c_custkey,
               concat_ws('-', CAST(c_nationkey AS VARCHAR),
                         CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_mktsegment END, c_name) AS id_joined
        FROM customer""",
    "lookup_map": """
        SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'URGENT' WHEN '2-HIGH' THEN 'HIGH'
                                WHEN '3-MEDIUM' THEN 'MEDIUM' WHEN '5-LOW' THEN 'LOW' END AS priority_name
        FROM orders""",
    "lookup_table": """
        SELECT c.c_custkey, n.n_name AS nation_name
        FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "entity_class": fixture("SELECT id_mesa, categoria, campo_numero, cantidad, tipo_mesa FROM classified"),
    "measure_to_row": fixture(f"SELECT {SILVER_COLS} FROM silver"),
    "dq_geo_null": fixture(
        "SELECT id_mesa, distrito, seccion, circuito, mesa, tipo_mesa, categoria, campo_numero, campo_descripcion, "
        "cantidad FROM silver WHERE tipo_mesa = 'NORMAL' AND (id_mesa IS NULL OR distrito IS NULL OR seccion IS NULL "
        "OR circuito IS NULL OR mesa IS NULL)"
    ),
    "dq_zero_sum": fixture(
        "SELECT id_mesa, CAST(sum(cantidad) AS BIGINT) AS total_votos FROM silver WHERE tipo_mesa = 'COMPENSATORIA' "
        "GROUP BY id_mesa HAVING sum(cantidad) != 0"
    ),
    "dq_domain": fixture(f"SELECT DISTINCT categoria FROM silver WHERE NOT (categoria IN ({_CATS}))"),
    "dq_null_measure": fixture(
        "SELECT id_mesa, tipo_mesa, categoria, campo_numero, campo_descripcion, cantidad FROM silver "
        "WHERE cantidad IS NULL"
    ),
    "dq_id_length": fixture(
        "SELECT id_mesa, distrito, seccion, circuito, mesa FROM (SELECT *, coalesce(distrito, 'NN') || "
        "coalesce(seccion, 'NNN') || coalesce(circuito, 'NNNNNNNNNNNN') || coalesce(mesa, 'NNNNNNNNNNNN') || 'X' "
        "AS id_mesa FROM s0) WHERE length(id_mesa) != 30"
    ),
    "dq_id_mixed": fixture(f"""
        SELECT id_mesa, campo_numero FROM (
          SELECT campo_numero, coalesce({sql_pad('distrito', 2)}, 'NN') || coalesce({sql_pad('seccion', 3)}, 'NNN')
                 || coalesce({sql_pad('circuito', 12)}, 'NNNNNNNNNNNN')
                 || coalesce(CASE WHEN campo_numero IN ('1', '2') THEN {sql_pad('mesa', 12)} ELSE mesa END, 'NNNNNNNNNNNN')
                 || 'X' AS id_mesa FROM s0)
        WHERE length(id_mesa) != 30"""),
    "dq_violations": fixture(f"""
        SELECT 'normal_geo_complete' AS rule, id_mesa, categoria, campo_numero, cantidad, CAST(NULL AS BIGINT) AS total_votos
        FROM silver WHERE {_GEO_NULL}
        UNION ALL SELECT DISTINCT 'category_domain', NULL, categoria, NULL, NULL, NULL FROM silver
        WHERE NOT (categoria IN ({_CATS}))
        UNION ALL SELECT 'count_not_null', id_mesa, categoria, campo_numero, cantidad, NULL FROM silver WHERE cantidad IS NULL
        UNION ALL SELECT 'id_length', id_mesa, NULL, NULL, NULL, NULL FROM silver WHERE length(id_mesa) != 30
        UNION ALL SELECT 'compensatory_zero_sum', id_mesa, NULL, NULL, NULL, CAST(sum(cantidad) AS BIGINT) FROM silver
        WHERE tipo_mesa = 'COMPENSATORIA' GROUP BY id_mesa HAVING sum(cantidad) != 0
        UNION ALL SELECT 'compensatory_many_rows', id_mesa, NULL, NULL, NULL, count(*) FROM silver
        WHERE tipo_mesa = 'COMPENSATORIA' GROUP BY id_mesa HAVING count(*) > 6"""),
    "dq_observed": fixture(
        "SELECT 'rows' AS rule, count(*) AS violations FROM silver UNION ALL "
        + " UNION ALL ".join(f"SELECT '{name}', count(*) FILTER (WHERE {condition}) FROM silver" for name, condition in _ROW_RULES)
    ),
    "dq_contract": fixture(" UNION ALL ".join(
        f"SELECT 'not_null_{name}' AS rule, CAST({i} AS INTEGER) AS position, count(*) FILTER (WHERE {condition}) AS violations"
        " FROM silver" for i, (name, condition) in enumerate(_CONTRACT_RULES)
    )),
    "key_collisions": """
        SELECT key, count(*) AS tuples FROM (
          SELECT DISTINCT CAST(c_nationkey AS VARCHAR) || CAST(c_custkey AS VARCHAR) AS key, c_nationkey, c_custkey FROM customer)
        GROUP BY key HAVING count(*) > 1""",
    "dim_seccion_one": _one_sql(
        "id_seccion",
        {"id_seccion": "concat_ws('', distrito, seccion)", "id_distrito": "distrito", "seccion_numero": "seccion",
         "seccion_descripcion": "seccion_descripcion"}, "seccion"),
    "dim_circuito_one": _one_sql(
        "id_circuito",
        {"id_circuito": "concat_ws('', distrito, seccion, circuito)", "id_seccion": "concat_ws('', distrito, seccion)",
         "circuito_numero": "circuito", "circuito_descripcion": "circuito_descripcion"}, "circuito"),
    "summary_one": _summary_one_sql(),
    "clustered_class": fixture("SELECT id_mesa, categoria, campo_numero, cantidad, tipo_mesa FROM classified"),
    "clustered_zero_sum": fixture(
        "SELECT id_mesa, CAST(sum(cantidad) AS BIGINT) AS total_votos FROM silver WHERE tipo_mesa = 'COMPENSATORIA' "
        "GROUP BY id_mesa HAVING sum(cantidad) != 0"
    ),
    "clustered_summary": fixture("SELECT * FROM mart"),
    "dq_report": fixture(
        f"""SELECT 'normal_geo_complete' AS rule, 0 AS position, CAST(count(*) FILTER (WHERE tipo_mesa = 'NORMAL' AND
              (id_mesa IS NULL OR distrito IS NULL OR seccion IS NULL OR circuito IS NULL OR mesa IS NULL)) AS BIGINT)
              AS violations FROM silver
        UNION ALL SELECT 'compensatory_zero_sum', 1, CAST(count(*) AS BIGINT) FROM (
              SELECT id_mesa FROM silver WHERE tipo_mesa = 'COMPENSATORIA' GROUP BY id_mesa HAVING sum(cantidad) != 0)
        UNION ALL SELECT 'category_domain', 2, CAST(count(DISTINCT CASE WHEN NOT (categoria IN ({_CATS}))
              THEN categoria END) AS BIGINT) FROM silver
        UNION ALL SELECT 'count_not_null', 3, CAST(count(*) FILTER (WHERE cantidad IS NULL) AS BIGINT) FROM silver
        UNION ALL SELECT 'id_length', 4, CAST(count(*) FILTER (WHERE length(id_mesa) != 30) AS BIGINT) FROM silver
        UNION ALL SELECT 'compensatory_many_rows', 5, CAST(count(*) AS BIGINT) FROM (
              SELECT id_mesa FROM silver WHERE tipo_mesa = 'COMPENSATORIA' GROUP BY id_mesa HAVING count(*) > 6)"""
    ),
    "dq_code_width": fixture(
        " UNION ALL ".join(
            f"SELECT 'code_too_long_{c}' AS rule, {i} AS position, "
            f"CAST(count(*) FILTER (WHERE length({c}) > {w}) AS BIGINT) AS violations FROM s0"
            for i, (c, w) in enumerate([("distrito", 2), ("seccion", 1), ("circuito", 2), ("mesa", 3),
                                        ("campo_numero", 3)])
        )
    ),
    "pk_duplicates": """
        SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber
        HAVING count(*) > 1""",
    "fk_orphans": """
        SELECT o_custkey, count(*) AS n
        FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN -o_custkey ELSE o_custkey END AS o_custkey FROM orders) o
        WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
        GROUP BY o_custkey""",
    "null_contract": _null_contract_sql(),
    "fact": fixture("SELECT id_mesa, id_campo, cantidad FROM fact"),
    "dim_mesa": fixture("SELECT * FROM dim_mesa"),
    "dim_circuito": fixture("SELECT * FROM dim_circuito"),
    "dim_seccion": fixture("SELECT * FROM dim_seccion"),
    "dim_distrito": fixture("SELECT * FROM dim_distrito"),
    "dim_categoria": fixture("SELECT * FROM dim_categoria"),
    "dim_campo": fixture("SELECT * FROM dim_campo"),
    "pivot_codes": fixture("SELECT * FROM totals"),
    "list_aggregate": fixture("SELECT * FROM lists"),
    "summary": fixture("SELECT * FROM mart"),
    "summary_onepass": fixture("SELECT * FROM mart"),
    "gold_checks": _gold_checks_sql(),
    "tally_run": fixture("SELECT * FROM mart"),
}
