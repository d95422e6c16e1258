"""Spec of the 2025 national tally files: 24 district files, 31 text fields."""

from __future__ import annotations

from tallymart.plans.layout import make_spec
from tallymart.spec import ClassRule, SourceSpec, text_schema

# --- Fixed values (must equal the source layout and vocabulary) -------------

# Raw file layout: 31 text fields, in file order.
RAW_FIELDS = (
    "dist_codigo", "zona", "zona_codigo", "zona_descrip",
    "secg_codigo", "secg_descrip", "secc_codigo", "secc_descrip",
    "muni_codigo", "muni_descrip", "circ_codigo", "circ_descrip",
    "mes_sexo", "tmesa_codigo", "ppar_codigo", "ppar_descrip",
    "ppar_codvis", "ppar_codvis2", "ppar_codvis3", "ppar_orden",
    "ppar_vercodi", "ppar_subcod", "ppar_subcod_descrip", "carg_codigo",
    "carg_descrip", "carg_abrev1", "carg_orden", "cant",
    "totins", "totvot", "sobcub",
)

# One file per district, named "2025 - NN - RESULTADOS.txt".
FILE_PATTERN = r"2025 - (\d{2}) - RESULTADOS\.txt$"

DISTRICT_NAMES = {
    "01": "CAPITAL_FEDERAL",
    "02": "BUENOS_AIRES",
    "03": "CATAMARCA",
    "04": "CORDOBA",
    "05": "CORRIENTES",
    "06": "CHACO",
    "07": "CHUBUT",
    "08": "ENTRE_RIOS",
    "09": "FORMOSA",
    "10": "JUJUY",
    "11": "LA_PAMPA",
    "12": "LA_RIOJA",
    "13": "MENDOZA",
    "14": "MISIONES",
    "15": "NEUQUEN",
    "16": "RIO_NEGRO",
    "17": "SALTA",
    "18": "SAN_JUAN",
    "19": "SAN_LUIS",
    "20": "SANTA_CRUZ",
    "21": "SANTA_FE",
    "22": "SANTIAGO_DEL_ESTERO",
    "23": "TIERRA_DEL_FUEGO",
    "24": "TUCUMAN",
}

#: The districts expected in a full run.
DISTRICTS = sorted(DISTRICT_NAMES)

CATEGORIES = ["PV", "DN", "SN", "PN", "PR", "GO", "DP", "DD", "SP", "MU", "CO", "TC", "RP", "CC", "JU"]

# Totals codes -> mart column.
TOTALS = {
    "000": "inscriptos",
    "990": "votos_blanco",
    "991": "votos_nulos",
    "992": "votos_recurridos",
    "993": "votos_impugnados",
    "994": "votos_totales",
}
TOTAL_VOTES_CODE = "994"
INSCRIBED_CODE = "000"
INSCRIBED_LABEL = "INSCRIPTOS"

# Section-name patterns of special tables (word stems, matched upper-cased).
PATTERN_ABROAD = "EXTERIOR|RESIDENT|ARGENT"
PATTERN_DEPRIVED = "PRIV|LIBERTAD"

# ---------------------------------------------------------------------------

CLASS_RULES = (
    ClassRule("COMPENSATORIA", "cantidad < 0"),
    ClassRule("RESIDENTES_EXTERIOR", f"upper(coalesce(seccion_descripcion, '')) rlike '{PATTERN_ABROAD}'"),
    ClassRule("PRIVADOS_LIBERTAD", f"upper(coalesce(seccion_descripcion, '')) rlike '{PATTERN_DEPRIVED}'"),
)

SOURCE = SourceSpec(schema=text_schema(RAW_FIELDS), source_pattern=FILE_PATTERN)

ELECTION = make_spec(
    source=SOURCE,
    totals=TOTALS,
    total_code=TOTAL_VOTES_CODE,
    inscribed_code=INSCRIBED_CODE,
    inscribed_label=INSCRIBED_LABEL,
    categories=CATEGORIES,
    class_rules=CLASS_RULES,
    district_names=DISTRICT_NAMES,
)
