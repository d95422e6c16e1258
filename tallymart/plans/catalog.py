"""Registered queries: one per operator of the inventory, each reading the
driver tables at ``sf_dir`` (or data Spark derives from them).

Every callable is ``(spark, sf_dir) -> DataFrame`` and returns a lazy result;
the few that exercise a sink or a text source first write their input under
the shared checkpoint folder (an action), then return the read-back frame.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tallymart.functions.codes import (
    clean_label,
    composite_id,
    joined_key,
    lookup,
    pad_code,
    path_key,
    row_kind,
    to_int,
)
from tallymart.operators.classify import entity_class
from tallymart.operators.clean import blank_to_null, pad_codes, project, trim_sentinel
from tallymart.operators.mart import list_aggregate, summary, summary_onepass, totals_pivot
from tallymart.operators.model import dimension, fact, lookup_table
from tallymart.operators.quality import (
    captured,
    evaluate,
    fk_orphans,
    key_collisions,
    null_contract,
    observe_rules,
    observed_counts,
    observed_rules,
    pk_duplicates,
    violations,
)
from tallymart.plans.fixture import FIXTURE, ONE_SPELLING, shares, table, tally_bronze
from tallymart.plans.layout import contract_rules, truncation_rules
from tallymart.plans.medallion import (
    bronze_contract,
    clean_bronze,
    gold,
    gold_checks,
    normalize,
    pre_pad,
    publish_gold,
    read_gold,
    run,
    silver,
)
from tallymart.plans.oracle import INGEST_EXPECTED
from tallymart.session import drop_scratch, hot_keys_split, materialize, scratch_path, shuffles_removed
from tallymart.sources.delimited import (
    INGESTED_AT,
    SOURCE,
    SOURCE_FILE,
    ingest_report,
    quarantine,
    read_delimited,
    read_staged,
    rejected_lines,
    source_id,
    stage_delimited,
)
from tallymart.sources.sink import Folder, publish, publish_clustered, publish_partitions, read_table
from tallymart.spec import Contract, Rule, SourceSpec, text_schema

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values of the small lookup used by ``lookup_map``.
PRIORITY_NAMES = {"1-URGENT": "URGENT", "2-HIGH": "HIGH", "3-MEDIUM": "MEDIUM", "5-LOW": "LOW"}


# --- fixture tally -----------------------------------------------------------

def fixture_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_bronze(tally_bronze(spark, sf_dir), FIXTURE)


def fixture_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(fixture_bronze(spark, sf_dir), FIXTURE, method="hash")


def fixture_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver without the entity class, for operators that do not read it:
    the tally is evaluated once, and nothing is joined to it."""
    return silver(fixture_bronze(spark, sf_dir), FIXTURE, method=None)


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity_class(normalize(fixture_bronze(spark, sf_dir), FIXTURE), FIXTURE.classes)


def _rule(name: str):
    return next(r for r in FIXTURE.rules if r.name == name)


# --- sources and sinks -------------------------------------------------------

def q_csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer rows written as ISO-8859-1 pipe text, then read in
    one scan with an explicit schema, trimmed and sentinel-cleaned."""
    path = scratch_path(spark, "csv-ingest", unique=False)
    lines = table(spark, sf_dir, "customer").select(
        F.concat_ws(
            "|",
            F.col("c_custkey").cast("string"),
            F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")),
            F.col("c_nationkey").cast("string"),
            F.when(F.col("c_mktsegment") == "MACHINERY", F.lit(" \\N ")).otherwise(F.col("c_mktsegment")),
        ).alias("value")
    )
    (lines.write.mode("overwrite").option("encoding", "ISO-8859-1").option("quote", "")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path))
    spec = SourceSpec(schema=text_schema(["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]))
    raw = read_delimited(spark, path, spec)
    return trim_sentinel(raw, "\\N", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]).select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment"
    )


ORDER_LINES = SourceSpec(
    schema=text_schema(["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]),
    source_pattern=r"/src=([^/]+)/",
)


def _ingest_files(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Orders written as one text family per priority; two families get
    malformed lines (too many fields, too few fields), one is not expected."""
    path = scratch_path(spark, name, unique=False)
    o = table(spark, sf_dir, "orders")
    base = F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"),
                       F.col("o_orderstatus"), F.col("o_orderpriority"))
    short = F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"),
                        F.col("o_orderstatus"))
    value = (
        F.when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P"), F.concat(base, F.lit("|extra")))
        .when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"), short)
        .otherwise(base)
    )
    o.select(F.col("o_orderpriority").alias("src"), value.alias("value")).write.mode("overwrite").partitionBy(
        "src"
    ).text(path)
    # As in a real run: parsed once into a staging table.
    staging = scratch_path(spark, f"{name}-staging", unique=False)
    stage_delimited(spark, path, ORDER_LINES, staging)
    return read_staged(spark, ORDER_LINES, staging)


def q_ingest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows / malformed rows / status per source file family."""
    report = ingest_report(_ingest_files(spark, sf_dir, "ingest-report"), INGEST_EXPECTED)
    return report.select("source", "rows", "bad_rows", "null_key_rows", "status")


def q_ingest_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only rows of expected sources whose every line parsed."""
    raw = _ingest_files(spark, sf_dir, "ingest-clean")
    kept = quarantine(raw, ingest_report(raw, INGEST_EXPECTED))
    return kept.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", SOURCE)


def q_ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line that is kept out, and why: malformed ones as they stand,
    the others of their source with it."""
    raw = _ingest_files(spark, sf_dir, "ingest-rejects")
    return rejected_lines(raw, ingest_report(raw, INGEST_EXPECTED), ORDER_LINES).select("source", "reason", "line")


def q_ingest_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source the lines of its files, those loaded and those
    rejected: nothing is lost between them."""
    raw = _ingest_files(spark, sf_dir, "ingest-balance")
    report = materialize(ingest_report(raw, INGEST_EXPECTED), "ingest-balance-report", unique=False)
    text = spark.read.text(scratch_path(spark, "ingest-balance", unique=False))
    lines = text.filter(F.trim("value") != "").select(source_id(ORDER_LINES).alias("source"), F.lit("lines").alias("of"))
    loaded = quarantine(raw, report).select(F.col(SOURCE).alias("source"), F.lit("loaded").alias("of"))
    rejected = rejected_lines(raw, report, ORDER_LINES).select("source", F.lit("rejected").alias("of"))
    every = lines.unionByName(loaded).unionByName(rejected)
    return every.groupBy("source").agg(*[F.count_if(F.col("of") == of).alias(of) for of in ("lines", "loaded", "rejected")])


#: Of this source one compressed part file is cut short; of the other one a
#: part file that is named does not exist.
CUT_SOURCE, SHORT_SOURCE = "3-MEDIUM", "2-HIGH"


def q_ingest_unreadable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as gzip text, one family per priority.  One file is cut
    short, one that is named is missing: their sources are reported and kept
    out, whatever else they have; the others are loaded."""
    path = scratch_path(spark, "ingest-unreadable", unique=False)
    o = table(spark, sf_dir, "orders")
    line = F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"),
                       F.col("o_orderstatus"), F.col("o_orderpriority"))
    o.select(F.col("o_orderpriority").alias("src"), line.alias("value")).write.mode("overwrite").partitionBy("src").option(
        "compression", "gzip"
    ).text(path)
    folder = Folder(spark, path)
    for name in folder.children(f"src={CUT_SOURCE}/part-*.gz")[:1]:
        _cut_file(folder, name)
    paths = [f"{path}/{name}" for name in folder.children("src=*")] + [f"{path}/src={SHORT_SOURCE}/part-lost.txt.gz"]
    staging = scratch_path(spark, "ingest-unreadable-staging", unique=False)
    failed = stage_delimited(spark, paths, ORDER_LINES, staging)
    raw = read_staged(spark, ORDER_LINES, staging)
    report = materialize(ingest_report(raw, INGEST_EXPECTED, failed=failed), "ingest-unreadable-report", unique=False)
    loaded = quarantine(raw, report).groupBy(F.col(SOURCE).alias("source")).agg(F.count(F.lit(1)).alias("loaded"))
    return report.join(loaded, on="source", how="left").select(
        "source", "status", F.col("error").isNotNull().alias("explained"), F.coalesce("loaded", F.lit(0)).alias("loaded")
    )


def _cut_file(folder: Folder, name: str) -> None:
    """Put the first half (at most a megabyte) of a file in its place."""
    path, short = folder._of(f"{folder.path}/{name}"), folder._of(f"{folder.path}/{name.replace('part-', 'part-cut-')}")
    size = folder.fs.getFileStatus(path).getLen()
    given, taken = folder.fs.open(path), folder.fs.create(short)
    taken.write(given.readNBytes(min(max(12, size // 2), 1 << 20)))
    given.close()
    taken.close()
    folder.delete(f"{folder.path}/{name}")


#: District whose second delivery replaces the first, and what it holds.
RELOADED = "2"


def q_district_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze by district; one district is delivered again, with fewer
    lines and other counts, and only its partition is replaced."""
    path = scratch_path(spark, "district-reload", unique=False)
    contract = bronze_contract(FIXTURE)
    stamped = fixture_bronze(spark, sf_dir).withColumns({SOURCE_FILE: F.lit("first"), INGESTED_AT: F.current_timestamp()})
    publish(stamped, path, contract)
    again = read_table(spark, path, contract).filter((F.col("dist_codigo") == RELOADED) & (F.col("ppar_codigo") <= "3"))
    again = again.withColumns({"cant": F.lit("0"), SOURCE_FILE: F.lit("second")})
    publish_partitions(again, path, contract, allowed=[RELOADED])
    return read_table(spark, path, contract).select(
        "dist_codigo", "zona_codigo", "carg_codigo", "ppar_codigo", "ppar_descrip", "cant", F.col(SOURCE_FILE).alias("delivery")
    )


def q_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: source id, folder named in the decoded file path, and whether the
    ingestion time is set, per row."""
    raw = _ingest_files(spark, sf_dir, "provenance")
    return raw.select(
        "o_orderkey",
        F.col(SOURCE).alias("source"),
        F.regexp_extract(F.col(SOURCE_FILE), r"/src=([^/]+)/[^/]+$", 1).alias("folder"),
        F.col(INGESTED_AT).isNotNull().alias("stamped"),
    )


ORDERS_CONTRACT = Contract(
    "orders_by_status",
    StructType([
        StructField("o_orderkey", LongType(), False),
        StructField("o_custkey", LongType(), True),
        StructField("o_orderpriority", StringType(), True),
        StructField("o_orderstatus", StringType(), True),
    ]),
    primary_key=("o_orderkey",),
    partition_by=("o_orderstatus",),
)


def q_publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-refresh partitioned write aligned by name, read back."""
    path = scratch_path(spark, "publish", unique=False)
    src = table(spark, sf_dir, "orders").select("o_orderstatus", "o_totalprice", "o_custkey", "o_orderkey",
                                                "o_orderpriority")
    publish(src, path, ORDERS_CONTRACT)
    return read_table(spark, path, ORDERS_CONTRACT)


# --- projections and column functions ----------------------------------------

def q_project_rename(spark, sf_dir):
    """P1, P2."""
    return project(table(spark, sf_dir, "customer"),
                   {"c_custkey": "circuito", "c_name": "circuito_descripcion", "c_nationkey": "seccion"})


def q_null_sentinel(spark, sf_dir):
    """P3 with a custom sentinel."""
    return trim_sentinel(table(spark, sf_dir, "events").select("event_id", "event_type"), "error")


def q_blank_to_null(spark, sf_dir):
    """P4."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_orderpriority",
    )
    return blank_to_null(o)


def q_pad_code(spark, sf_dir):
    """P5: keep the last n chars, left-pad zeros; NULL stays NULL."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("cust_code"),
        F.col("o_orderkey").cast("string").alias("order_code"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status_code"),
    )
    return pad_codes(o, {"cust_code": 3, "order_code": 5, "status_code": 2})


def q_composite_id(spark, sf_dir):
    """P6."""
    c = table(spark, sf_dir, "customer")
    nation = F.when(F.col("c_mktsegment") != "MACHINERY", pad_code(F.col("c_nationkey").cast("string"), 3))
    return c.select(
        "c_custkey",
        nation.alias("nation_code"),
        pad_code(F.col("c_custkey").cast("string"), 5).alias("cust_code"),
    ).select("c_custkey", composite_id({"nation_code": "NNN", "cust_code": "NNNNN"}, "X").alias("id"))


def q_clean_label(spark, sf_dir):
    """P7 over whole document texts."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", clean_label(F.col("doc_id").cast("string"), F.col("text")).alias("label"))


def q_safe_int(spark, sf_dir):
    """P8, P15."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        to_int(F.regexp_extract("props", r"(-?[0-9]+)", 1)).alias("prop_int"),
        to_int("event_type").alias("type_int"),
        to_int("event_type", default=0).alias("type_int_or_zero"),
        to_int(F.col("user_id").cast("string")).alias("user_int"),
    )


def q_row_kind(spark, sf_dir):
    """NULL code -> the 'no' kind."""
    o = table(spark, sf_dir, "orders")
    code = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return o.select("o_orderkey", row_kind(code, ["1-URGENT", "2-HIGH"]).alias("kind"))


def q_path_key(spark, sf_dir):
    """P10: NULL parts are skipped."""
    c = table(spark, sf_dir, "customer")
    cust = F.when(F.col("c_mktsegment") != "MACHINERY", pad_code(F.col("c_custkey").cast("string"), 5))
    return c.select("c_custkey", path_key(pad_code(F.col("c_nationkey").cast("string"), 3), cust).alias("id_path"))


def q_joined_key(spark, sf_dir):
    """P11."""
    c = table(spark, sf_dir, "customer")
    seg = F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment"))
    return c.select("c_custkey", joined_key(F.col("c_nationkey").cast("string"), seg, "c_name").alias("id_joined"))


def q_lookup_map(spark, sf_dir):
    """P13 with a literal map; unknown -> NULL."""
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", lookup("o_orderpriority", PRIORITY_NAMES).alias("priority_name"))


def q_lookup_table(spark, sf_dir):
    """P13 with a lookup table."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    out = lookup_table(c, "c_nationkey", table(spark, sf_dir, "nation"), "n_nationkey", "n_name", "nation_name")
    return out.select("c_custkey", "nation_name")


# --- classification, reshaping, quality --------------------------------------

def q_entity_class(spark, sf_dir):
    """W1, W2, F9, F10."""
    return _classified(spark, sf_dir).select("id_mesa", "categoria", "campo_numero", "cantidad", "tipo_mesa")


def q_measure_to_row(spark, sf_dir):
    """The whole silver table."""
    return fixture_silver(spark, sf_dir)


def q_dq_geo_null(spark, sf_dir):
    return violations(fixture_silver(spark, sf_dir), _rule("normal_geo_complete"))


def q_dq_zero_sum(spark, sf_dir):
    return violations(fixture_silver(spark, sf_dir), _rule("compensatory_zero_sum"))


def q_dq_domain(spark, sf_dir):
    return violations(fixture_rows(spark, sf_dir), _rule("category_domain"))


def q_dq_null_measure(spark, sf_dir):
    return violations(fixture_silver(spark, sf_dir), _rule("count_not_null"))


def q_dq_id_length(spark, sf_dir):
    """D5 on ids built from codes that were not brought to their widths."""
    rule = replace(_rule("id_length"), columns=("id_mesa", "distrito", "seccion", "circuito", "mesa"))
    rows = pre_pad(fixture_bronze(spark, sf_dir), FIXTURE)
    return violations(rows.withColumn("id_mesa", composite_id(FIXTURE.id_key)), rule)


# A second grouped rule of the zero-sum rule's family, whose alias stands for
# another expression.
MANY_ROWS = Rule(
    "compensatory_many_rows",
    filter="tipo_mesa = 'COMPENSATORIA'",
    group_by=("id_mesa",),
    agg={"total_votos": "count(1)"},
    having="total_votos > 6",
)


def q_dq_report(spark, sf_dir):
    """Every gate in one report, evaluated (as in a real run) on a
    staged parquet copy of silver: the two aggregates read it instead of
    recomputing silver each (measured ~25% faster at sf0.1)."""
    return evaluate(materialize(fixture_silver(spark, sf_dir), "dq-report", unique=False), (*FIXTURE.rules, MANY_ROWS))


def q_dq_id_mixed(spark, sf_dir):
    """Ids of which some have the right length and some do not: the
    table code is brought to its width on the first two lines only."""
    rule = replace(_rule("id_length"), columns=("id_mesa", "campo_numero"))
    rows = pre_pad(fixture_bronze(spark, sf_dir), FIXTURE)
    first = F.col("campo_numero").isin("1", "2")
    rows = pad_codes(rows, {c: w for c, w in FIXTURE.widths.items() if c in ("distrito", "seccion", "circuito")})
    mesa = F.when(first, pad_code("mesa", FIXTURE.widths["mesa"])).otherwise(F.col("mesa"))
    return violations(rows.withColumn("mesa", mesa).withColumn("id_mesa", composite_id(FIXTURE.id_key)), rule)


def q_dq_violations(spark, sf_dir):
    """What every gate objects to, all row rules in one scan of the staged
    silver and one scan per family of grouped rules."""
    staged = materialize(fixture_silver(spark, sf_dir), "dq-violations", unique=False)
    found = captured(staged, (*FIXTURE.rules, MANY_ROWS))
    value = lambda name: F.get_json_object("row", f"$.{name}")
    return found.select(
        "rule",
        *[value(c).alias(c) for c in ("id_mesa", "categoria", "campo_numero")],
        value("cantidad").cast("int").alias("cantidad"),
        value("total_votos").cast("long").alias("total_votos"),
    )


def q_dq_observed(spark, sf_dir):
    """Rows, and what each row rule objects to, counted by the
    write of silver itself."""
    rules = (*FIXTURE.rules, *contract_rules(FIXTURE))
    rows, seen = observe_rules(fixture_silver(spark, sf_dir), rules)
    materialize(rows, "dq-observed", unique=False)
    n, counts = observed_counts(seen, rules)
    entries = [("rows", n), *[(r.name, counts[r.name]) for r in observed_rules(rules)]]
    return spark.createDataFrame(entries, "rule string, violations long")


def q_dq_contract(spark, sf_dir):
    """NOT NULL of the silver and gold contracts as rules over silver."""
    return evaluate(materialize(fixture_silver(spark, sf_dir), "dq-contract", unique=False), contract_rules(FIXTURE))


def q_key_collisions(spark, sf_dir):
    """Edges 12, 13: keys built without widths, which several pairs of nation
    and customer share."""
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string"), F.col("c_custkey").cast("string"))
    found = key_collisions(c, "concat_ws('', c_nationkey, c_custkey)", ("c_nationkey", "c_custkey"))
    return found.select("key", "tuples")


# Widths that some codes of the fixture exceed.
NARROW_WIDTHS = {"distrito": 2, "seccion": 1, "circuito": 2, "mesa": 3, "campo_numero": 3}


def q_dq_code_width(spark, sf_dir):
    """Truncation pre-check: codes longer than a width, per column."""
    return evaluate(pre_pad(fixture_bronze(spark, sf_dir), FIXTURE), truncation_rules(NARROW_WIDTHS))


def q_pk_duplicates(spark, sf_dir):
    """K1 on (l_orderkey, l_linenumber)."""
    return pk_duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_fk_orphans(spark, sf_dir):
    """K2: orders of customers that do not exist (the keys of open orders
    are negated, so that there are some)."""
    key = F.when(F.col("o_orderstatus") == "P", -F.col("o_custkey")).otherwise(F.col("o_custkey"))
    orders = table(spark, sf_dir, "orders").select(key.alias("o_custkey"))
    return fk_orphans(orders, ["o_custkey"], table(spark, sf_dir, "customer"), ["c_custkey"])


STRICT_SILVER = Contract(
    "silver_strict",
    StructType([
        StructField(f.name, f.dataType, f.nullable and f.name not in ("circuito", "cantidad"))
        for f in FIXTURE.silver.schema.fields
    ]),
)


def q_null_contract(spark, sf_dir):
    """K3 against the silver contract, made stricter than the fixture is."""
    return null_contract(fixture_silver(spark, sf_dir), STRICT_SILVER)


# --- gold ----------------------------------------------------------------------

def _spelled_twice(rows: DataFrame) -> DataFrame:
    """Silver whose sections and circuits are described differently on some
    lines."""
    first, second = F.col("campo_numero") == "001", F.col("campo_numero").isin("002", "003", "007")
    return rows.withColumns({
        "seccion_descripcion": F.when(first, F.lower("seccion_descripcion")).otherwise(F.col("seccion_descripcion")),
        "circuito_descripcion": F.when(second, F.lit(None)).otherwise(F.col("circuito_descripcion")),
    })


def _dim_one(name: str) -> Query:
    def run(spark, sf_dir):
        return dimension(_spelled_twice(fixture_rows(spark, sf_dir)), ONE_SPELLING.dims[name])

    run.__name__, run.__doc__ = f"q_{name}_one", "Edge 14: one row per key, with its most frequent spelling."
    return run


def q_summary_one(spark, sf_dir):
    """Edge 14 in G8: one row per category and polling table.

    The tally and the counts per spelling are written one after the other, so
    that the disk holds the shuffles of one step only.  Between them silver is
    dealt by polling table once, for its class and for the counts."""
    def staged(df: DataFrame, name: str) -> DataFrame:
        publish(df, scratch_path(spark, name, unique=False))
        return spark.read.schema(df.schema).parquet(scratch_path(spark, name, unique=False))

    tally, counts = "summary-one-tally", "summary-one-counts"
    with shuffles_removed(spark), hot_keys_split(spark):
        rows = silver(staged(fixture_bronze(spark, sf_dir), tally), FIXTURE, method="dealt")
        out = summary_onepass(_spelled_twice(rows), ONE_SPELLING.summary, lambda df: staged(df, counts))
        drop_scratch(spark, scratch_path(spark, tally, unique=False))
    return out


BUCKETS = 16


def clustered(spark, df: DataFrame, name: str, sf_dir: str) -> DataFrame:
    """``df`` as a catalog table bucketed by the entity key: a bucket is one
    task later, so their number grows with the line items."""
    contract = Contract(name, df.schema)
    publish_clustered(df, f"tallymart_{name}", contract, FIXTURE.classes.key, max(BUCKETS, shares(spark, sf_dir)),
                      location=scratch_path(spark, name, unique=False))
    return spark.table(f"tallymart_{name}")


def q_clustered_class(spark, sf_dir):
    """W1, W2 on rows bucketed by the entity: flags and join without exchange."""
    rows = clustered(spark, normalize(fixture_bronze(spark, sf_dir), FIXTURE), "clustered_rows", sf_dir)
    return entity_class(rows, FIXTURE.classes, method="clustered").select(
        "id_mesa", "categoria", "campo_numero", "cantidad", "tipo_mesa"
    )


def q_clustered_zero_sum(spark, sf_dir):
    """D2 on a silver bucketed by the entity: no exchange."""
    return violations(clustered(spark, fixture_silver(spark, sf_dir), "clustered_gate", sf_dir), _rule("compensatory_zero_sum"))


def q_clustered_summary(spark, sf_dir):
    """G8 on a silver bucketed by the entity: no exchange."""
    return summary_onepass(clustered(spark, fixture_silver(spark, sf_dir), "clustered_silver", sf_dir), FIXTURE.summary)


def q_fact(spark, sf_dir):
    return fact(fixture_rows(spark, sf_dir), FIXTURE.fact.columns)


def _dim(name: str) -> Query:
    rows = fixture_silver if "tipo_mesa" in FIXTURE.dims[name].columns.values() else fixture_rows

    def run(spark, sf_dir):
        return dimension(rows(spark, sf_dir), FIXTURE.dims[name])

    run.__name__ = f"q_{name}"
    return run


def q_pivot_codes(spark, sf_dir):
    return totals_pivot(fixture_silver(spark, sf_dir), FIXTURE.summary)


def q_list_aggregate(spark, sf_dir):
    return list_aggregate(fixture_rows(spark, sf_dir), FIXTURE.summary)


def q_summary(spark, sf_dir):
    """The mart reads silver twice, so silver is staged first."""
    return summary(materialize(fixture_silver(spark, sf_dir), "summary", unique=False), FIXTURE.summary)


def q_summary_onepass(spark, sf_dir):
    return summary_onepass(fixture_silver(spark, sf_dir), FIXTURE.summary)


def q_gold_checks(spark, sf_dir):
    """K1-K3 over the whole gold model built from the fixture.

    As in a real run, silver is materialised once (a parquet table in the
    shared checkpoint folder), the gold tables are published, and the checks
    scan the published tables instead of recomputing their lineage per check.
    """
    silver_df = materialize(fixture_silver(spark, sf_dir), "gold-silver", unique=False)
    paths = publish_gold(gold(silver_df, FIXTURE), FIXTURE, scratch_path(spark, "gold", unique=False))
    return gold_checks(read_gold(spark, paths, FIXTURE), FIXTURE)


# Region codes of the driver tables: the expected source list of a run.
FIXTURE_DISTRICTS = ["0", "1", "2", "3", "4"]


def q_tally_run(spark, sf_dir):
    """The whole process end to end (S1-S9, P*, W*, U*, D*, G*): the fixture
    tally is written as ISO-8859-1 pipe text, one directory per district,
    then ingested, quarantined, published to bronze, normalised, classified,
    expanded, gated (report only: the fixture has violations on purpose),
    published to silver and modelled into gold; returns the published mart."""
    root = scratch_path(spark, "tally-run", unique=False)
    text = f"{root}/raw"
    raw = tally_bronze(spark, sf_dir)
    lines = raw.select(F.col("dist_codigo").alias("dist"),
                       F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in FIXTURE.bronze_columns]).alias("v"))
    with shuffles_removed(spark):
        (lines.write.mode("overwrite").partitionBy("dist").option("encoding", "ISO-8859-1").option("quote", "")
         .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
         .option("compression", "gzip").csv(text))
    spec = replace(FIXTURE, source=replace(FIXTURE.source, source_pattern=r"/dist=([^/]+)/"))
    result = run(spark, text, spec, f"{root}/out", expected=FIXTURE_DISTRICTS, enforce_quality=False, stage_mart=True)
    return read_table(spark, result.tables["resumen_mesa"], spec.gold["resumen_mesa"])


QUERIES: dict[str, Query] = {
    "csv_ingest": q_csv_ingest,
    "ingest_report": q_ingest_report,
    "ingest_clean": q_ingest_clean,
    "ingest_rejects": q_ingest_rejects,
    "ingest_balance": q_ingest_balance,
    "ingest_unreadable": q_ingest_unreadable,
    "provenance": q_provenance,
    "publish_roundtrip": q_publish_roundtrip,
    "district_reload": q_district_reload,
    "project_rename": q_project_rename,
    "null_sentinel": q_null_sentinel,
    "blank_to_null": q_blank_to_null,
    "pad_code": q_pad_code,
    "composite_id": q_composite_id,
    "clean_label": q_clean_label,
    "safe_int": q_safe_int,
    "row_kind": q_row_kind,
    "path_key": q_path_key,
    "joined_key": q_joined_key,
    "lookup_map": q_lookup_map,
    "lookup_table": q_lookup_table,
    "entity_class": q_entity_class,
    "measure_to_row": q_measure_to_row,
    "dq_geo_null": q_dq_geo_null,
    "dq_zero_sum": q_dq_zero_sum,
    "dq_domain": q_dq_domain,
    "dq_null_measure": q_dq_null_measure,
    "dq_id_length": q_dq_id_length,
    "dq_id_mixed": q_dq_id_mixed,
    "dq_report": q_dq_report,
    "dq_violations": q_dq_violations,
    "dq_observed": q_dq_observed,
    "dq_contract": q_dq_contract,
    "key_collisions": q_key_collisions,
    "dq_code_width": q_dq_code_width,
    "pk_duplicates": q_pk_duplicates,
    "fk_orphans": q_fk_orphans,
    "null_contract": q_null_contract,
    "fact": q_fact,
    "dim_mesa": _dim("dim_mesa"),
    "dim_circuito": _dim("dim_circuito"),
    "dim_seccion": _dim("dim_seccion"),
    "dim_distrito": _dim("dim_distrito"),
    "dim_categoria": _dim("dim_categoria"),
    "dim_campo": _dim("dim_campo"),
    "dim_seccion_one": _dim_one("dim_seccion"),
    "dim_circuito_one": _dim_one("dim_circuito"),
    "summary_one": q_summary_one,
    "clustered_class": q_clustered_class,
    "clustered_zero_sum": q_clustered_zero_sum,
    "clustered_summary": q_clustered_summary,
    "pivot_codes": q_pivot_codes,
    "list_aggregate": q_list_aggregate,
    "summary": q_summary,
    "summary_onepass": q_summary_onepass,
    "gold_checks": q_gold_checks,
    "tally_run": q_tally_run,
}
