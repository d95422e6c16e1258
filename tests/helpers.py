"""Hand-made tally rows in the election layout."""

from tallymart.plans.layout import BRONZE_COLUMNS

BRONZE_DDL = ", ".join(f"{c} string" for c in BRONZE_COLUMNS)


def row(dist="1", secc="2", secc_d="CAPITAL", circ="3", circ_d="CENTRO", mesa="4", cat="DN",
        code="501", desc="LISTA AZUL", cant="10", totins="350"):
    return (dist, secc, secc_d, circ, circ_d, mesa, cat, code, desc, cant, totins)


def table_rows(mesa="4", cat="DN", lists=((501, 10), (502, 20)), totals=None, totins="350", **kw):
    """One polling table: list rows plus totals rows (code -> count)."""
    totals = {"990": "1", "991": "2", "992": "0", "993": "0", "994": "33"} if totals is None else totals
    out = [row(mesa=mesa, cat=cat, code=str(c), desc=f"LISTA {c}", cant=str(n), totins=totins, **kw) for c, n in lists]
    out += [row(mesa=mesa, cat=cat, code=c, desc=f"TOTAL {c}", cant=n, totins=totins, **kw) for c, n in totals.items()]
    return out


def bronze(spark, rows):
    return spark.createDataFrame(rows, BRONZE_DDL)
