"""A polling table holding a third of all rows: results must stay exact
(checked against a brute-force pandas computation) with AQE skew handling on."""

import pandas as pd
from pyspark.sql import functions as F

from helpers import bronze, table_rows
from tallymart.operators import summary, summary_onepass
from tallymart.plans.elections import ELECTION
from tallymart.plans.medallion import clean_bronze, silver


def test_hot_table_is_exact(spark):
    rows = []
    for m in range(1, 41):
        rows += table_rows(mesa=str(m), lists=((501, m), (502, 2 * m)))
    # mesa 99 holds as many list rows as all the others together (~1/3 of the input)
    hot_lists = tuple((600 + i, 1) for i in range(len(rows)))
    rows += table_rows(mesa="99", lists=hot_lists + ((999, -1),), secc_d="EXTERIOR")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    s = silver(clean_bronze(bronze(spark, rows), ELECTION), ELECTION)

    pdf = s.toPandas()
    hot = pdf[pdf.id_mesa == "010020000300099X"]
    assert len(hot) >= len(pdf) / 3
    assert set(hot.tipo_mesa) == {"COMPENSATORIA"}  # negative row anywhere in the table

    lists = pdf[pdf.registro == "AGRUPACION"].groupby(["categoria", "id_mesa"]).cantidad.agg(["sum", "count"])
    for fn in (summary, summary_onepass):
        got = {r["id_mesa"]: (r["votos_afirmativos"], r["listas"]) for r in fn(s, ELECTION.summary).collect()}
        want = {k[1]: (int(v["sum"]), int(v["count"])) for k, v in lists.iterrows()}
        assert got == want

    total = s.agg(F.sum("cantidad")).first()[0]
    assert total == int(pd.to_numeric(pdf.cantidad).sum())
