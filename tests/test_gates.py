"""Gates of one run: counted by the write, captured in one pass, replaced by
the next run; keys that collide, keys with several spellings, buckets."""

import collections
import json
import os
import subprocess
import sys
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from helpers import bronze, row, table_rows
from tallymart.operators import (
    QualityError, captured, dimension, evaluate, key_collisions, observe_rules, observed_counts, one_spelling, pk_duplicates,
    summary, summary_onepass, violation_rows, violations,
)
from tallymart.operators.classify import entity_class
from tallymart.operators.quality import observed_rules
from tallymart.plans import catalog, elections
from tallymart.plans.elections import ELECTION
from tallymart.plans.layout import contract_rules, dims
from tallymart.plans.medallion import clean_bronze, collision_checks, normalize, run, silver
from tallymart.sources.sink import publish_clustered, read_table
from tallymart.spec import Contract, Rule
from test_medallion import good_files, table_lines, write
from test_plans import SF, executed, physical


def bad_silver(spark):
    rows = table_rows("4", lists=((501, 10), (502, "1.5")))
    rows += table_rows("5", cat="ZZ", circ="", lists=((501, 1), (502, 2)))
    rows += table_rows("6", lists=((501, -1), (502, 2)))
    return silver(clean_bronze(bronze(spark, rows), ELECTION), ELECTION)


MANY = Rule("many", filter="tipo_mesa = 'COMPENSATORIA'", group_by=("id_mesa",), agg={"total_votos": "count(1)"}, having="total_votos > 3")
WIDE = Rule("wide", violation="cantidad = 33")  # all columns
RULES = (*ELECTION.rules, *contract_rules(ELECTION), MANY, WIDE)


def test_captured_rows_equal_one_scan_per_rule(spark):
    s = bad_silver(spark).cache()
    want = collections.Counter(map(tuple, violation_rows(s, RULES).collect()))
    assert {r for r, _ in want} >= {"compensatory_zero_sum", "category_domain", "many", "wide"}
    assert collections.Counter(map(tuple, captured(s, RULES).collect())) == want
    fired = {r.name for r in RULES if not r.grouped and violations(s, r).count()}
    assert collections.Counter(map(tuple, captured(s, RULES, fired).collect())) == want
    assert captured(s, [], None).collect() == [] and captured(s, [WIDE], set()).collect() == []


def test_capture_scans_once_for_all_row_rules(spark, tmp_dir):
    bad_silver(spark).write.parquet(f"{tmp_dir}/s")
    s = spark.read.parquet(f"{tmp_dir}/s")
    flat = [r for r in RULES if not r.grouped]
    assert physical(captured(s, flat)).count("FileScan") == 1
    assert physical(captured(s, RULES)).count("FileScan") == 3  # two families: their aliases disagree
    assert physical(violation_rows(s, RULES)).count("FileScan") > 20  # one for each rule that is not plainly false


def test_observed_counts_equal_evaluate(spark, tmp_dir):
    s = bad_silver(spark)
    rows, seen = observe_rules(s, RULES)
    rows.write.parquet(f"{tmp_dir}/s")
    n, counts = observed_counts(seen, RULES)
    back = spark.read.parquet(f"{tmp_dir}/s")
    plain = [replace(r, distinct=False) for r in observed_rules(RULES)]
    assert n == back.count()
    assert counts == {r["rule"]: r["violations"] for r in evaluate(back, plain).collect()}


RETRIED = """
import sys, tempfile
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
from tallymart.operators import observe_rules, observed_counts
from tallymart.spec import Rule
spark = (SparkSession.builder.master("local[3,4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
def shaky(batches):
    from pyspark import TaskContext
    yield from batches
    if TaskContext.get().attemptNumber() < 2 and TaskContext.get().partitionId() % 2 == 0:
        raise RuntimeError("lost")
rules = [Rule("odd", violation="id % 2 = 1")]
rows, seen = observe_rules(spark.range(0, 1000, 1, 5).mapInArrow(shaky, "id long"), rules)
rows.write.parquet(tempfile.mkdtemp() + "/out")
print("COUNTED", observed_counts(seen, rules))
"""


def test_observed_counts_are_right_when_tasks_are_tried_again():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", RETRIED.format(root=root)], capture_output=True, text=True, timeout=300)
    assert "COUNTED (1000, {'odd': 500})" in out.stdout, out.stderr[-2000:]


def test_violations_belong_to_their_run(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    os.makedirs(src)
    good_files(src)
    write(src, "01", table_lines("1", "4", cat="ZZ", circ=""))
    with pytest.raises(QualityError):
        run(spark, f"{src}/*.txt", ELECTION, out, expected=["01", "02"])
    assert read_table(spark, f"{out}/reports/quality_violations").count() == 5 + 1  # five rows without circuit, one value
    good_files(src)
    res = run(spark, f"{src}/*.txt", ELECTION, out, expected=["01", "02"])
    assert read_table(spark, res.tables["quality_violations"]).count() == 0
    report = {r["rule"]: r["violations"] for r in read_table(spark, res.tables["quality_report"]).collect()}
    assert set(report.values()) == {0} and len(report) == len(res.quality) + len(res.truncated)


def test_codes_that_are_cut_are_reported_and_can_stop_a_run(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    os.makedirs(src)
    write(src, "01", table_lines("1", "4", lists=((1994, 7), (502, 5))))
    res = run(spark, f"{src}/*.txt", ELECTION, out, expected=["01"])
    report = {r["rule"]: (r["violations"], r["enforced"]) for r in read_table(spark, res.tables["quality_report"]).collect()}
    assert report["code_too_long_campo_numero"] == (1, False) and report["code_too_long_mesa"] == (0, False)
    with pytest.raises(QualityError, match="code_too_long_campo_numero: 1"):
        run(spark, f"{src}/*.txt", ELECTION, os.path.join(tmp_dir, "out2"), expected=["01"], enforce_widths=True)
    assert not os.path.exists(os.path.join(tmp_dir, "out2", "silver"))


def test_keys_are_reported_by_the_run(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    os.makedirs(src)
    good_files(src)
    res = run(spark, f"{src}/*.txt", ELECTION, out, expected=["01", "02"])
    report = {(r["check"], r["table"], r["detail"]): r["violations"] for r in read_table(spark, res.tables["key_report"]).collect()}
    assert report[("foreign_key", "dim_mesa", "id_circuito -> dim_circuito(id_circuito)")] == 1
    assert report[("collision", "silver", "id_mesa <- distrito,seccion,circuito,mesa")] == 0
    assert ("foreign_key", "dim_mesa", "id_circuito -> dim_circuito(id_circuito)", 1) in res.keys
    assert all(n > 0 for *_, n in res.keys) and len(res.keys) == sum(n > 0 for n in report.values())
    quiet = run(spark, f"{src}/*.txt", ELECTION, os.path.join(tmp_dir, "out2"), expected=["01", "02"], check_keys=False)
    assert "key_report" not in quiet.tables and quiet.keys == []


def test_collisions_tell_null_empty_and_delimiters_apart(spark):
    df = spark.createDataFrame([("a-b", "c"), ("a", "b-c"), ("x", None), ("x", None), (None, "x"), ("y", ""), ("p", "q")], "u string, v string")
    found = {r["key"]: (r["tuples"], json.loads(r["least"]), json.loads(r["most"]))
             for r in key_collisions(df, "concat_ws('-', u, v)", ("u", "v")).collect()}
    assert found == {"a-b-c": (2, {"u": "a", "v": "b-c"}, {"u": "a-b", "v": "c"}), "x": (2, {"u": "x"}, {"v": "x"})}
    assert key_collisions(df.limit(0), "concat_ws('-', u, v)", ("u", "v")).count() == 0


def test_a_placeholder_in_the_data_collides(spark):
    rows = [row(circ=""), row(circ="NNNNN")]
    checks = {r["detail"].split(" ")[0]: r["violations"]
              for r in collision_checks(silver(clean_bronze(bronze(spark, rows), ELECTION), ELECTION), ELECTION).collect()}
    assert checks == {"id_mesa": 1, "id_seccion": 0, "id_circuito": 0, "id_campo": 0}


def two_spellings(spark):
    rows = table_rows("4", circ_d="CENTRO") + table_rows("5", circ_d="Centro", secc_d="Capital")
    rows += [row(mesa="4", circ_d="", code="503"), row(mesa="4", circ_d="CENTRO", code="990", desc="TOTAL 990", cant="1", secc_d="Otra")]
    return silver(clean_bronze(bronze(spark, rows), ELECTION), ELECTION)


def test_one_spelling_per_key(spark):
    s, names = two_spellings(spark), dict.fromkeys(["01"], "UNO")
    plain, one = dims(names), dims(names, one_spelling=True)
    for name, key in (("dim_seccion", "id_seccion"), ("dim_circuito", "id_circuito")):
        assert pk_duplicates(dimension(s, plain[name]), [key]).count() > 0
        assert pk_duplicates(dimension(s, one[name]), [key]).count() == 0
    assert dimension(s, one["dim_circuito"]).first()["circuito_descripcion"] == "CENTRO"
    spec = replace(ELECTION.summary, one_spelling=True)
    assert pk_duplicates(summary_onepass(s, ELECTION.summary), ["categoria", "id_mesa"]).count() > 0
    mart = {r["id_mesa"]: r for r in summary_onepass(s, spec).collect()}
    assert len(mart) == summary(s, spec).count() == 2
    four = mart["010020000300004X"]
    assert (four["seccion_descripcion"], four["listas"], four["votos_totales"]) == ("CAPITAL", 3, 33)


def test_ties_of_spellings(spark):
    df = spark.createDataFrame([(1, None), (1, "b"), (1, "a"), (2, None), (3, "é"), (3, "z"), (3, "z"), (None, "q")], "k int, v string")
    got = {tuple(r) for r in one_spelling(df, ["k"]).collect()}
    assert got == {(1, "a"), (2, None), (3, "z"), (None, "q")}
    assert {tuple(r) for r in one_spelling(df.select("k"), ["k"]).collect()} == {(1,), (2,), (3,), (None,)}


def exchanges(plan):
    return plan.count("Exchange hashpartitioning")


def test_bucketed_silver_needs_no_exchange(spark):
    rows = table_rows("4") + table_rows("5", lists=((501, -5), (502, 6))) + table_rows("6", secc_d="EXTERIOR")
    # a polling table with far more rows than all others
    rows += table_rows("99", lists=tuple((100 + i, 1) for i in range(400)) + ((999, -1),))
    raw = clean_bronze(bronze(spark, rows), ELECTION)
    normal = normalize(raw, ELECTION)
    publish_clustered(normal, "tm_gates_rows", Contract("r", normal.schema), ["id_mesa"], 4)
    classed = entity_class(spark.table("tm_gates_rows"), ELECTION.classes, method="clustered")
    assert exchanges(physical(classed)) == 0 and exchanges(executed(classed)) == 0
    want = collections.Counter(map(tuple, entity_class(normal, ELECTION.classes).collect()))
    assert collections.Counter(map(tuple, classed.collect())) == want
    s = silver(raw, ELECTION)
    publish_clustered(s, "tm_gates_silver", ELECTION.silver, ["id_mesa"], 4)
    t = spark.table("tm_gates_silver")
    gate = next(r for r in ELECTION.rules if r.name == "compensatory_zero_sum")
    for plain, bucketed in ((violations(s, gate), violations(t, gate)),
                            (summary_onepass(s, ELECTION.summary), summary_onepass(t, ELECTION.summary))):
        assert exchanges(physical(bucketed)) == 0
        assert collections.Counter(map(tuple, bucketed.collect())) == collections.Counter(map(tuple, plain.collect()))
    publish_clustered(s, "tm_gates_silver", ELECTION.silver, ["id_mesa"], 4)  # a full refresh
    assert spark.table("tm_gates_silver").count() == s.count()


def test_registered_clustered_queries_have_no_exchange(spark):
    for name in ("clustered_class", "clustered_zero_sum", "clustered_summary"):
        assert exchanges(physical(catalog.QUERIES[name](spark, SF))) == 0, name


def test_a_run_into_bucketed_tables(spark, tmp_dir):
    from tallymart.plans.medallion import table_targets

    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    good_files(src)
    res = run(spark, f"{src}/*.txt", ELECTION, table_targets("tmbucket_"), expected=["01", "02"], buckets=4)
    described = {r[0]: r[1] for r in spark.sql("DESCRIBE EXTENDED tmbucket_silver").collect()}
    assert described["Num Buckets"] == "4" and spark.table("tmbucket_silver").count() == 15
    assert spark.table(res.tables["resumen_mesa"]).count() == 3
    with pytest.raises(ValueError):
        run(spark, f"{src}/*.txt", ELECTION, os.path.join(tmp_dir, "out"), expected=["01", "02"], buckets=4)
    assert elections.DISTRICTS
