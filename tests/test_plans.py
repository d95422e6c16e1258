"""Plan shape: what Catalyst does with our operators."""

from tallymart.operators import summary
from tallymart.plans import catalog

SF = "/root/testdata/sf0.001"


def executed(df):
    df.collect()  # let AQE finalise the plan
    return df._jdf.queryExecution().executedPlan().toString()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_anywhere(spark):
    for name, fn in catalog.QUERIES.items():
        plan = physical(fn(spark, SF))
        for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert node not in plan, f"{name} uses {node}"


def test_scans_prune_columns_and_push_filters(spark):
    plan = physical(catalog.q_fk_orphans(spark, SF))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string>" in plan
    assert "ReadSchema: struct<c_custkey:bigint>" in plan
    plan = physical(catalog.table(spark, SF, "orders").filter("o_orderstatus = 'P'").select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,P)]" in plan


def test_consumers_without_the_class_scan_the_tally_once(spark):
    for name in ("fact", "dim_circuito", "dim_seccion", "dim_distrito", "dim_categoria", "dim_campo",
                 "list_aggregate", "dq_domain", "pk_duplicates"):
        plan = physical(catalog.QUERIES[name](spark, SF))
        assert plan.count("l_orderkey:bigint") == 1, name


def test_only_special_entities_are_joined(spark):
    df = spark.createDataFrame([(f"k{i % 50}", i % 7 - 1 if i < 7 else 1) for i in range(400)], "k string, v int")
    from tallymart.operators.classify import entity_class, entity_flags
    from tallymart.spec import ClassRule, ClassSpec

    spec = ClassSpec(("k",), (ClassRule("NEG", "v < 0"),), "OK", "cls")
    out = {r["k"]: r["cls"] for r in entity_class(df, spec).distinct().select("k", "cls").collect()}
    assert {k for k, c in out.items() if c == "NEG"} == {"k0"} and len(out) == 50
    joined = entity_class(df, spec)._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in joined.split("Aggregate")[0]
    assert entity_flags(df, spec).count() == 50


def test_measure_rows_use_generate_not_union(spark):
    plan = physical(catalog.q_measure_to_row(spark, SF))
    assert "Generate explode" in plan and "Union" not in plan


def test_classification_is_aggregate_and_join_not_window(spark):
    plan = physical(catalog.q_entity_class(spark, SF))
    assert "Window" not in plan
    assert "partial_max" in plan  # flags pre-aggregated map-side


def test_quality_report_is_two_aggregates(spark):
    plan = physical(catalog.q_dq_report(spark, SF))
    # one global aggregate for row/distinct rules + one grouped aggregate for the zero-sum rule
    assert plan.count("Union") == 1


def test_onepass_summary_has_no_join_after_silver(spark):
    plan = physical(catalog.q_summary_onepass(spark, SF))
    joined = physical(summary(catalog.fixture_silver(spark, SF), catalog.FIXTURE.summary))
    assert plan.count("Join") < joined.count("Join")


def test_small_lookup_is_broadcast_by_size(spark):
    plan = physical(catalog.q_lookup_table(spark, SF))
    assert "BroadcastHashJoin" in plan


def test_hot_entity_join_is_split_by_aqe(spark):
    """One entity holding a third of the rows: the classification join-back
    is a sort-merge join whose hot partition AQE splits (skew=true)."""
    from pyspark.sql import functions as F

    from tallymart.operators.classify import entity_class
    from tallymart.spec import ClassRule, ClassSpec

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        hot = F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 20_000).cast("string"))
        )
        df = spark.range(600_000).select(
            F.coalesce(hot, F.lit("")).alias("k"),  # a key that cannot be NULL, like the built id
            (F.col("id") % 7 - 1).cast("int").alias("v"),
            F.sha2(F.col("id").cast("string"), 256).alias("pad"),
        )
        out = entity_class(df, ClassSpec(("k",), (ClassRule("NEG", "v < 0"),), "OK", "cls"))
        # downstream work keyed by the entity, as the mart does
        agg = out.groupBy("k", "cls").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("pad")).alias("bytes"))
        assert sum(r["n"] for r in agg.collect()) == 600_000
        plan = agg._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_quarantine_broadcasts_a_small_written_report(spark, tmp_dir):
    from tallymart.sources.delimited import ingest_report, quarantine

    raw = catalog._ingest_files(spark, SF, "plan-ingest")
    ingest_report(raw, catalog.INGEST_EXPECTED).write.parquet(f"{tmp_dir}/report")
    plan = physical(quarantine(raw, spark.read.parquet(f"{tmp_dir}/report")))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
