"""What one task holds or compares does not grow with the input."""

import re

from pyspark.sql import functions as F

from tallymart.operators import summary, summary_onepass
from tallymart.operators.classify import entity_class
from tallymart.plans import catalog, fixture
from tallymart.sources.delimited import read_delimited
from tallymart.spec import ClassRule, ClassSpec, SourceSpec, text_schema

SF = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_buckets_grow_with_the_line_items(spark, monkeypatch):
    few = catalog.q_clustered_summary(spark, SF)
    plain = rows_of(few)
    monkeypatch.setattr(fixture, "SHARE_BYTES", 4096)
    n = fixture.shares(spark, SF)
    assert n > catalog.BUCKETS
    many = catalog.q_clustered_summary(spark, SF)
    described = {r["col_name"]: r["data_type"] for r in spark.sql("describe formatted tallymart_clustered_silver").collect()}
    assert described["Num Buckets"] == str(n)
    assert "Exchange" not in physical(many) and rows_of(many) == plain


def test_the_tally_is_joined_in_shares_of_the_line_items(spark, monkeypatch):
    plain = fixture.tally_bronze(spark, SF)
    assert "REPARTITION_BY_NUM" not in physical(plain)
    monkeypatch.setattr(fixture, "SHARE_BYTES", 4096)
    shared = fixture.tally_bronze(spark, SF)
    assert "hashpartitioning(l_orderkey#" in physical(shared)
    n = re.search(r"hashpartitioning\(l_orderkey#\d+L?, (\d+)\), REPARTITION_BY_NUM", physical(shared))
    assert int(n.group(1)) == fixture.shares(spark, SF) > 16
    assert rows_of(shared) == rows_of(plain)


def test_silver_hashes_special_entities_instead_of_sorting_rows(spark):
    plan = physical(catalog.fixture_silver(spark, SF))
    assert re.search(r"ShuffledHashJoin .*LeftOuter, BuildRight", plan)
    assert not re.search(r"SortMergeJoin.*LeftOuter", plan)


def test_rows_that_satisfy_no_rule_are_not_aggregated(spark):
    rows = [("a", 1), ("a", -1), ("b", 2), ("c", None), (None, -3), (None, 1), ("d", None), ("d", -2)]
    df = spark.createDataFrame(rows, "k string, v int")
    spec = ClassSpec(("k",), (ClassRule("NEG", "v < 0"), ClassRule("TWO", "v = 2")), "OK", "cls")
    want = {"a": "NEG", "b": "TWO", "c": "OK", None: "NEG", "d": "NEG"}
    for method in ("join", "hash", "window"):
        out = entity_class(df, spec, method=method)
        assert out.count() == len(rows)
        assert {r["k"]: r["cls"] for r in out.collect()} == want, method
    flagged = entity_class(df, spec)._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in flagged.split("Aggregate")[1]
    none = entity_class(df, ClassSpec(("k",), (), "OK", "cls"), method="hash")
    assert [r["cls"] for r in none.collect()] == ["OK"] * len(rows)


def test_the_mart_tells_keys_apart_by_their_hash(spark):
    for name in ("summary_onepass", "summary_one"):
        window = re.search(r"Window \[.*", physical(catalog.QUERIES[name](spark, SF))).group(0)
        assert "windowspecdefinition(_w" in window or "xxhash64" in window, name


def test_one_spelling_with_ties_nulls_and_null_keys(spark):
    spec = catalog.ONE_SPELLING.summary
    attributes = {c: "x" for c in spec.attributes}
    def row(categoria, mesa, code, n, kind=spec.totals_kind, **other):
        return {"categoria": categoria, "id_mesa": mesa, spec.code: code, spec.measure: n, spec.kind: kind, **attributes, **other}
    lists = spec.lists_kind
    rows = [
        row("A", "m1", "007", 5), row("A", "m1", "003", 2, seccion_descripcion=None),  # a tie: present before NULL
        row("A", "m1", "501", 3, lists, seccion_descripcion="never a total"),
        row("A", "m2", "007", 5, seccion_descripcion="b"), row("A", "m2", "003", 1, seccion_descripcion="a"),
        row("A", "m3", "501", 9, lists),  # no totals: no row
        row(None, "m4", "007", 1), row(None, "m4", "501", 4, lists),  # a NULL key has no lists
    ]
    names = [*spec.join_keys, spec.code, spec.measure, spec.kind, *spec.attributes]
    schema = ", ".join(f"{c} {'int' if c == spec.measure else 'string'}" for c in names)
    df = spark.createDataFrame([tuple(r[c] for c in names) for r in rows], schema)
    got = {r["id_mesa"]: r for r in summary_onepass(df, spec).collect()}
    assert set(got) == {"m1", "m2", "m4"}
    assert [got[m]["seccion_descripcion"] for m in ("m1", "m2", "m4")] == ["x", "a", "x"]
    assert [got[m][spec.lists_sum] for m in ("m1", "m2", "m4")] == [3, None, None]
    assert [got[m][spec.lists_count] for m in ("m1", "m2", "m4")] == [1, None, None]
    assert (got["m1"]["votos_totales"], got["m1"]["votos_blanco"]) == (5, 2)
    assert rows_of(summary(df, spec)) == rows_of(summary_onepass(df, spec))


def test_a_path_without_percent_is_not_decoded(spark, tmp_dir):
    spec = SourceSpec(schema=text_schema(["a", "b"]), source_pattern=r"/src=([^/]+)/")
    for name in ("plain", "with space", "a+b", "50%25", "á+é 1"):
        spark.createDataFrame([("1|2",)], "value string").coalesce(1).write.text(f"{tmp_dir}/{name}/src={name}")
    rows = read_delimited(spark, f"{tmp_dir}/*/*", spec)
    assert "CASE WHEN" in rows._jdf.queryExecution().optimizedPlan().toString()
    seen = {r["_source"]: r["_source_file"] for r in rows.collect()}
    assert len(seen) == 5
    for source, file in seen.items():
        assert f"/{source}/src={source}/part-" in file and file.startswith("file:")
