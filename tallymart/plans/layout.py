"""The bronze -> silver -> gold table layout, built from a few parameters.

The layout (column names, table contracts, dimensions, rules) is the same for
every tally; only codes, categories, patterns and names vary, so a spec is
made by ``make_spec`` from those values.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tallymart.operators.quality import any_null
from tallymart.spec import (
    ClassRule,
    ClassSpec,
    Contract,
    DimSpec,
    ForeignKey,
    KeySpec,
    KindSpec,
    MeasureRowSpec,
    Rule,
    SourceSpec,
    SummarySpec,
    TallySpec,
)

# Fixed layout of the model (names of the published tables' columns).
BRONZE_COLUMNS = (
    "dist_codigo", "secc_codigo", "secc_descrip", "circ_codigo", "circ_descrip", "zona_codigo",
    "carg_codigo", "ppar_codigo", "ppar_descrip", "cant", "totins",
)
RENAME = {
    "dist_codigo": "distrito", "secc_codigo": "seccion", "secc_descrip": "seccion_descripcion",
    "circ_codigo": "circuito", "circ_descrip": "circuito_descripcion", "zona_codigo": "mesa",
    "carg_codigo": "categoria", "ppar_codigo": "campo_numero", "ppar_descrip": "campo_descripcion",
    "cant": "cantidad", "totins": "inscriptos",
}
SILVER_COLUMNS = (
    "id_mesa", "distrito", "seccion", "seccion_descripcion", "circuito", "circuito_descripcion",
    "mesa", "categoria", "campo", "campo_numero", "campo_descripcion", "cantidad", "registro", "tipo_mesa",
)
WIDTHS = {"distrito": 2, "seccion": 3, "circuito": 5, "mesa": 5, "campo_numero": 3}
ID_PARTS = ("distrito", "seccion", "circuito", "mesa")
PLACEHOLDER = "N"
ID_SUFFIX = "X"
SUMMARY_ATTRIBUTES = (
    "distrito", "seccion", "seccion_descripcion", "circuito", "circuito_descripcion", "mesa", "tipo_mesa",
)
SUMMARY_ORDER = (
    "categoria", "id_mesa", "distrito", "seccion", "seccion_descripcion", "circuito",
    "circuito_descripcion", "mesa", "tipo_mesa", "listas", "inscriptos", "votos_afirmativos",
    "votos_blanco", "votos_nulos", "votos_recurridos", "votos_impugnados", "votos_totales",
)

# Key expressions of the snowflake.
ID_SECCION = "concat_ws('', distrito, seccion)"
ID_CIRCUITO = "concat_ws('', distrito, seccion, circuito)"
ID_CAMPO = "concat_ws('-', distrito, categoria, campo_numero, campo_descripcion)"


def _schema(*cols: tuple[str, object, bool]) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in cols])


S, I, L = StringType(), IntegerType(), LongType()

SILVER = Contract(
    "silver",
    _schema(
        ("id_mesa", S, False), ("distrito", S, False), ("seccion", S, True), ("seccion_descripcion", S, True),
        ("circuito", S, True), ("circuito_descripcion", S, True), ("mesa", S, True), ("categoria", S, False),
        ("campo", S, True), ("campo_numero", S, True), ("campo_descripcion", S, True), ("cantidad", I, True),
        ("registro", S, True), ("tipo_mesa", S, True),
    ),
)

GOLD = {
    "dim_distrito": Contract(
        "dim_distrito", _schema(("id_distrito", S, False), ("distrito", S, False)), ("id_distrito",)
    ),
    "dim_seccion": Contract(
        "dim_seccion",
        _schema(("id_seccion", S, False), ("id_distrito", S, False), ("seccion_numero", S, False),
                ("seccion_descripcion", S, True)),
        ("id_seccion",),
    ),
    "dim_circuito": Contract(
        "dim_circuito",
        _schema(("id_circuito", S, False), ("id_seccion", S, False), ("circuito_numero", S, True),
                ("circuito_descripcion", S, True)),
        ("id_circuito",),
    ),
    "dim_mesa": Contract(
        "dim_mesa",
        _schema(("id_mesa", S, False), ("id_circuito", S, False), ("mesa", S, False), ("tipo_mesa", S, False)),
        ("id_mesa",),
    ),
    "dim_categoria": Contract(
        "dim_categoria", _schema(("id_categoria", S, False), ("codigo", S, False)), ("id_categoria",)
    ),
    "dim_campo": Contract(
        "dim_campo",
        _schema(("id_campo", S, False), ("id_distrito", S, False), ("id_categoria", S, False),
                ("campo_numero", S, True), ("campo_descripcion", S, False)),
        ("id_campo",),
    ),
    "fact_resultados": Contract(
        "fact_resultados",
        _schema(("id_mesa", S, False), ("id_campo", S, False), ("cantidad", I, False)),
        ("id_mesa", "id_campo"),
    ),
    "resumen_mesa": Contract(
        "resumen_mesa",
        _schema(
            ("categoria", S, False), ("id_mesa", S, False), ("distrito", S, False), ("seccion", S, True),
            ("seccion_descripcion", S, True), ("circuito", S, True), ("circuito_descripcion", S, True),
            ("mesa", S, True), ("tipo_mesa", S, True), ("listas", L, True), ("inscriptos", I, True),
            ("votos_afirmativos", L, True), ("votos_blanco", I, True), ("votos_nulos", I, True),
            ("votos_recurridos", I, True), ("votos_impugnados", I, True), ("votos_totales", I, True),
        ),
        ("categoria", "id_mesa"),
    ),
}

FOREIGN_KEYS = (
    ForeignKey("dim_seccion", ("id_distrito",), "dim_distrito", ("id_distrito",)),
    ForeignKey("dim_circuito", ("id_seccion",), "dim_seccion", ("id_seccion",)),
    ForeignKey("dim_mesa", ("id_circuito",), "dim_circuito", ("id_circuito",)),
    ForeignKey("fact_resultados", ("id_mesa",), "dim_mesa", ("id_mesa",)),
    ForeignKey("fact_resultados", ("id_campo",), "dim_campo", ("id_campo",)),
)


def dims(district_names: Mapping[str, str], one_spelling: bool = False) -> dict[str, DimSpec]:
    """The six dimensions of the snowflake (G2-G7).  ``one_spelling`` gives
    sections and circuits that are described in several ways one row each."""
    one = (lambda *key: key) if one_spelling else (lambda *key: ())
    return {
        "dim_mesa": DimSpec(
            {"id_mesa": "id_mesa", "id_circuito": ID_CIRCUITO, "mesa": "mesa", "tipo_mesa": "tipo_mesa"}
        ),
        "dim_circuito": DimSpec(
            {"id_circuito": ID_CIRCUITO, "id_seccion": ID_SECCION, "circuito_numero": "circuito",
             "circuito_descripcion": "circuito_descripcion"},
            not_null=("circuito",),
            one_per=one("id_circuito"),
        ),
        "dim_seccion": DimSpec(
            {"id_seccion": ID_SECCION, "id_distrito": "distrito", "seccion_numero": "seccion",
             "seccion_descripcion": "seccion_descripcion"},
            not_null=("seccion",),
            one_per=one("id_seccion"),
        ),
        "dim_distrito": DimSpec(
            {"id_distrito": "distrito"}, lookups={"distrito": ("id_distrito", dict(district_names))}
        ),
        "dim_categoria": DimSpec({"id_categoria": "categoria", "codigo": "categoria"}),
        "dim_campo": DimSpec(
            {"id_campo": ID_CAMPO, "id_distrito": "distrito", "id_categoria": "categoria",
             "campo_numero": "campo_numero", "campo_descripcion": "campo_descripcion"}
        ),
    }


FACT = DimSpec({"id_mesa": "id_mesa", "id_campo": ID_CAMPO, "cantidad": "cantidad"}, distinct=False)


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def rules(categories, id_length: int, zero_sum_filter: str | None = None) -> tuple[Rule, ...]:
    """The five silver gates (D1-D5), in the order they are reported.

    The zero-sum gate sums every row of a compensatory table by default
    (totals and the inscribed row included, as the original process does);
    ``zero_sum_filter`` narrows the rows it sums, e.g. ``"registro = 'AGRUPACION'"``.
    """
    compensatory = "tipo_mesa = 'COMPENSATORIA'"
    if zero_sum_filter:
        compensatory = f"{compensatory} AND ({zero_sum_filter})"
    return (
        Rule(
            "normal_geo_complete",
            violation=f"tipo_mesa = 'NORMAL' AND ({any_null(['id_mesa', 'distrito', 'seccion', 'circuito', 'mesa'])})",
            columns=("id_mesa", "distrito", "seccion", "circuito", "mesa", "tipo_mesa", "categoria",
                     "campo_numero", "campo_descripcion", "cantidad"),
        ),
        Rule(
            "compensatory_zero_sum",
            filter=compensatory,
            group_by=("id_mesa",),
            agg={"total_votos": "sum(cantidad)"},
            having="total_votos != 0",
        ),
        Rule(
            "category_domain",
            violation=f"NOT (categoria IN ({_sql_list(categories)}))",
            columns=("categoria",),
            distinct=True,
        ),
        Rule(
            "count_not_null",
            violation="cantidad IS NULL",
            columns=("id_mesa", "tipo_mesa", "categoria", "campo_numero", "campo_descripcion", "cantidad"),
        ),
        Rule(
            "id_length",
            violation=f"length(id_mesa) != {id_length}",
            columns=("id_mesa", "tipo_mesa", "distrito", "seccion", "circuito", "mesa"),
        ),
    )


def make_spec(
    source: SourceSpec,
    totals: Mapping[str, str],
    total_code: str,
    inscribed_code: str,
    inscribed_label: str,
    categories,
    class_rules: tuple[ClassRule, ...],
    district_names: Mapping[str, str],
    bronze_partition: str | None = "dist_codigo",
    zero_sum_filter: str | None = None,
    widths: Mapping[str, int] = WIDTHS,
    one_spelling: bool = False,
) -> TallySpec:
    """Build a full spec.

    ``totals`` maps each totals code (including ``inscribed_code``) to its mart
    column; ``total_code`` is the code of the row carrying the registered-voter
    measure, which becomes an extra row with ``inscribed_code``.  ``widths``
    must hold the longest code of each column: a longer one is cut to its last
    characters (``truncation_rules`` reports it).  With ``one_spelling`` the
    declared primary keys of sections, circuits and the mart hold whatever the
    spelling of descriptions: the most frequent one is taken.
    """
    placeholders = {c: PLACEHOLDER * widths[c] for c in ID_PARTS}
    key = KeySpec(ID_PARTS, placeholders, ID_SUFFIX, "id_mesa")
    lit_code = inscribed_code.replace("'", "''")
    lit_label = inscribed_label.replace("'", "''")
    return TallySpec(
        source=source,
        bronze_columns=BRONZE_COLUMNS,
        rename=RENAME,
        widths=dict(widths),
        id_key=key,
        label_output="campo",
        label_parts=("campo_numero", "campo_descripcion"),
        int_columns=("cantidad", "inscriptos"),
        kind=KindSpec("campo_numero", tuple(totals), "MESA", "AGRUPACION", "registro"),
        classes=ClassSpec(("id_mesa",), tuple(class_rules), "NORMAL", "tipo_mesa"),
        measure_row=MeasureRowSpec(
            when=f"campo_numero = '{total_code}'",
            measure="inscriptos",
            target="cantidad",
            set_values={
                "campo_numero": f"'{lit_code}'",
                "campo_descripcion": f"'{lit_label}'",
                "campo": f"concat_ws(' ', '{lit_code}', '{lit_label}')",
            },
            fill=0,
        ),
        categories=tuple(categories),
        rules=rules(categories, key.length, zero_sum_filter),
        silver=SILVER,
        fact=FACT,
        dims=dims(district_names, one_spelling),
        summary=SummarySpec(
            join_keys=("categoria", "id_mesa"),
            attributes=SUMMARY_ATTRIBUTES,
            code="campo_numero",
            measure="cantidad",
            totals=dict(totals),
            output_order=SUMMARY_ORDER,
            one_spelling=one_spelling,
        ),
        gold=GOLD,
        foreign_keys=FOREIGN_KEYS,
        bronze_partition=bronze_partition,
    )


#: Keys built from parts (P6, P10, P11), as expressions over silver, and the
#: parts whose tuples each must tell apart.
BUILT_KEYS = {
    "id_mesa": ("id_mesa", ID_PARTS),
    "id_seccion": (ID_SECCION, ("distrito", "seccion")),
    "id_circuito": (ID_CIRCUITO, ("distrito", "seccion", "circuito")),
    "id_campo": (ID_CAMPO, ("distrito", "categoria", "campo_numero", "campo_descripcion")),
}


def contract_rules(spec: TallySpec) -> tuple[Rule, ...]:
    """NOT NULL of the silver and gold contracts as row rules over silver:
    every gold column is an expression of silver rows, so one pass over the
    staged silver proves what would be published (S8, K3)."""
    out = [Rule(f"not_null_silver_{c}", f"{c} IS NULL", SILVER_COLUMNS) for c in spec.silver.not_null]
    for name, dim in {"fact_resultados": spec.fact, **spec.dims}.items():
        kept = [f"{c} IS NOT NULL" for c in dim.not_null] + ([f"({dim.filter})"] if dim.filter else [])
        for c in spec.gold[name].not_null:
            if c in dim.lookups:
                code, names = dim.lookups[c]
                missing = f"coalesce(NOT ({dim.columns[code]}) IN ({_sql_list(names)}), true)" if names else "true"
            else:
                missing = f"({dim.columns[c]}) IS NULL"
            out.append(Rule(f"not_null_{name}_{c}", " AND ".join([*kept, missing]), SILVER_COLUMNS))
    totals = f"{spec.summary.kind} = '{spec.summary.totals_kind}'"
    out += [
        Rule(f"not_null_resumen_mesa_{c}", f"{totals} AND {c} IS NULL", SILVER_COLUMNS)
        for c in spec.gold["resumen_mesa"].not_null
    ]
    return tuple(out)


def truncation_rules(widths: Mapping[str, int] = WIDTHS) -> tuple[Rule, ...]:
    """Pre-check for the code-width rule: codes longer than
    their width are cut to their last characters, so ``1990`` becomes ``990``
    and may collide with a totals code.  Evaluate these on the renamed,
    not-yet-padded rows (``pre_pad``)."""
    return tuple(
        Rule(f"code_too_long_{col}", violation=f"length({col}) > {width}", columns=(col,))
        for col, width in widths.items()
    )
