"""What a job leaves on disk while it runs: the shuffles of one step, not of all."""

import os
import time

import pytest
from helpers import bronze, row, table_rows
from pyspark.sql import functions as F
from test_medallion import good_files

from tallymart.operators import summary_onepass
from tallymart.operators.classify import entity_class
from tallymart.plans import catalog
from tallymart.plans.elections import ELECTION
from tallymart.plans.medallion import check_parts, clean_bronze, collision_checks, gold_checks, read_gold, run, silver
from tallymart.session import CLEANUP_CONF, hot_keys_split, materialize, scratch_path, shuffles_removed
from tallymart.sources.sink import Folder, read_table
from tallymart.spec import ClassRule, ClassSpec

SF = "/root/testdata/sf0.001"


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files, names = blocks.getAllFiles(), set()
    for i in range(files.size()):
        names.add(files.apply(i).getName())
    return {n for n in names if n.startswith("shuffle_")}


def left_over(spark, before):
    """New shuffle files; they are removed in the background."""
    for _ in range(100):
        new = shuffle_files(spark) - before
        if not new:
            break
        time.sleep(0.1)
    return new


def rows_of(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_shuffles_are_removed_and_the_setting_is_put_back(spark):
    before, was = shuffle_files(spark), spark.conf.get(CLEANUP_CONF, None)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    with shuffles_removed(spark):
        kept = materialize(df, "shuffles-removed")
    assert not left_over(spark, before)
    assert spark.conf.get(CLEANUP_CONF, None) == was and kept.count() == 7
    with pytest.raises(ZeroDivisionError), shuffles_removed(spark):
        1 / 0
    assert spark.conf.get(CLEANUP_CONF, None) == was
    spark.conf.set(CLEANUP_CONF, "false")
    try:
        with shuffles_removed(spark):
            assert spark.conf.get(CLEANUP_CONF) == "true"
        assert spark.conf.get(CLEANUP_CONF) == "false"
    finally:
        spark.conf.unset(CLEANUP_CONF)


@pytest.mark.parametrize("stage_mart", [False, True])
def test_a_run_leaves_no_shuffle_and_no_staging(spark, tmp_dir, stage_mart):
    os.makedirs(f"{tmp_dir}/src")
    good_files(f"{tmp_dir}/src")
    before = shuffle_files(spark)
    res = run(spark, f"{tmp_dir}/src/*.txt", ELECTION, f"{tmp_dir}/out", enforce_quality=False, stage_mart=stage_mart)
    assert not left_over(spark, before)
    gold = {n: p for n, p in res.tables.items() if n in ELECTION.gold}
    assert set(gold) == set(ELECTION.gold) == set(os.listdir(f"{tmp_dir}/out/gold"))
    # The checks are those of one union of all of them.
    tables, rows = read_gold(spark, gold, ELECTION), read_table(spark, res.tables["silver"], ELECTION.silver)
    every = gold_checks(tables, ELECTION).unionByName(collision_checks(rows, ELECTION))
    assert rows_of(read_table(spark, res.tables["key_report"])) == rows_of(every)
    assert len(check_parts(tables, ELECTION)) == len(ELECTION.gold) + len(ELECTION.foreign_keys)
    assert rows_of(tables["resumen_mesa"]) == rows_of(summary_onepass(rows, ELECTION.summary))


def test_the_text_of_the_whole_process_is_compressed(spark):
    assert catalog.q_tally_run(spark, SF).count() > 0
    files = Folder(spark, scratch_path(spark, "tally-run/raw", unique=False)).children("dist=*/part-*")
    assert files and all(f.endswith(".csv.gz") for f in files)


@pytest.mark.parametrize("spec", [ELECTION.summary, catalog.ONE_SPELLING.summary], ids=["plain", "one_spelling"])
def test_the_mart_in_two_steps_is_the_mart(spark, spec):
    rows = table_rows(mesa="4") + [row(mesa="4", secc_d=None, code="503"), row(mesa="4", secc_d="other", code="990", cant="8"),
                                   row(mesa="6", code="501"), row(mesa=None, circ_d=None, cat=None, code="990"),
                                   row(mesa=None, cat=None, code="501")]
    df = silver(clean_bronze(bronze(spark, rows + rows[:3]), ELECTION), ELECTION).withColumn(
        "campo_numero", F.when(F.col("campo_numero") == "990", F.lit(next(iter(spec.totals)))).otherwise(F.col("campo_numero")))
    seen = []

    def stage(level1):
        seen.append(level1)
        return materialize(level1, "two-steps")

    once, twice = summary_onepass(df, spec), summary_onepass(df, spec, stage)
    assert len(seen) == 1 and once.count() > 0 and rows_of(twice) == rows_of(once)
    plan = twice._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    # What a tuple without totals rows is called is not carried on.
    names = [c for c in spec.attributes if c not in spec.join_keys]
    assert all(r[c] is None for r in seen[0].filter("__ntot = 0").collect() for c in names)


def test_the_order_of_spellings_is_not_shuffled(spark):
    df = silver(clean_bronze(bronze(spark, table_rows()), ELECTION), ELECTION)
    plan = summary_onepass(df, catalog.ONE_SPELLING.summary)._jdf.queryExecution().optimizedPlan().toString()
    window = next(line for line in plan.splitlines() if "Window [" in line)
    assert "struct" not in plan and "circuito_descripcion" in window and "ASC NULLS LAST" in window


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_rows_stay_dealt_by_the_entity(spark):
    rows = table_rows(mesa="4") + table_rows(mesa="5", secc_d="RESIDENTES") + table_rows(mesa=None, lists=((501, -3),))
    df = silver(clean_bronze(bronze(spark, rows), ELECTION), ELECTION)
    dealt = silver(clean_bronze(bronze(spark, rows), ELECTION), ELECTION, method="dealt")
    assert rows_of(dealt) == rows_of(df) and len({r["tipo_mesa"] for r in dealt.collect()}) == 3
    mart = summary_onepass(dealt, ELECTION.summary)
    plan = mart._jdf.queryExecution().executedPlan().toString()
    # Rows, flags, and the special entities: none for the mart's two levels.
    assert plan.count("Exchange hashpartitioning") == 3 and "ShuffledHashJoin" in plan
    assert rows_of(mart) == rows_of(summary_onepass(df, ELECTION.summary))
    with pytest.raises(ValueError, match="never NULL"):
        entity_class(spark.createDataFrame([("a", 1)], "k string, v int"), ClassSpec(("k",), (ClassRule("N", "v < 0"),), "OK", "c"), "dealt")
    with pytest.raises(ValueError, match="text keys"):
        entity_class(spark.range(3), ClassSpec(("id",), (ClassRule("N", "id < 0"),), "OK", "c"), "dealt")


@pytest.mark.parametrize("force", [True, False])
def test_a_hot_entity_is_split_although_rows_stay_dealt(spark, force):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        hot = F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("k"), (F.col("id") % 5_000).cast("string")))
        df = spark.range(150_000).select(
            F.coalesce(hot, F.lit("")).alias("k"),
            (F.col("id") % 7 - 1).cast("int").alias("v"),
            F.sha2(F.col("id").cast("string"), 256).alias("pad"),
        )
        out = entity_class(df, ClassSpec(("k",), (ClassRule("NEG", "v < 0"),), "OK", "cls"), method="dealt")
        agg = out.groupBy("k", "cls").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("pad")).alias("bytes"))
        if force:
            with hot_keys_split(spark):
                plan = executed(agg)
        else:
            plan = executed(agg)
        assert ("ShuffledHashJoin(skew=true)" in plan) == force
        assert sum(r["n"] for r in agg.collect()) == 150_000
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_summary_one_stages_its_steps(spark):
    before = shuffle_files(spark)
    df = catalog.q_summary_one(spark, SF)
    assert not left_over(spark, before)  # the counts are written, the mart is not run yet
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    folder = Folder(spark, scratch_path(spark, "", unique=False))
    assert folder.children("summary-one-*") == ["summary-one-counts"]
    whole = summary_onepass(catalog._spelled_twice(catalog.fixture_silver(spark, SF)), catalog.ONE_SPELLING.summary)
    assert rows_of(df) == rows_of(whole)
