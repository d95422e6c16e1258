"""SURVEY section 5 invariants on the driver-table fixture (sf0.001)."""

import os

import pytest
from pyspark.sql import functions as F

from tallymart.operators import summary, summary_onepass
from tallymart.plans.catalog import fixture_bronze, fixture_silver
from tallymart.plans.fixture import FIXTURE, FIXTURE_TOTAL_CODE

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_invariants(spark):
    bronze = fixture_bronze(spark, SF)
    silver = fixture_silver(spark, SF).cache()
    try:
        n_total_rows = bronze.filter(F.lpad(F.col("ppar_codigo"), 3, "0") == FIXTURE_TOTAL_CODE).count()
        assert silver.count() == bronze.count() + n_total_rows
        assert silver.filter(F.length("id_mesa") != FIXTURE.id_key.length).count() == 0

        spec = FIXTURE.summary
        mart = summary(silver, spec)
        groups = silver.filter(F.col("registro") == "MESA").select(*spec.join_keys, *spec.attributes).distinct()
        assert mart.count() == groups.count()

        # with one descriptor tuple per key, the mart's list sums equal the raw list sums of its keys
        keys = mart.select(*spec.join_keys)
        lists = silver.filter(F.col("registro") == "AGRUPACION").join(keys, list(spec.join_keys), "left_semi")
        assert mart.agg(F.sum("votos_afirmativos")).first()[0] == lists.agg(F.sum("cantidad")).first()[0]

        a = sorted((tuple(r) for r in mart.collect()), key=repr)
        b = sorted((tuple(r) for r in summary_onepass(silver, spec).collect()), key=repr)
        assert a == b
    finally:
        silver.unpersist()
