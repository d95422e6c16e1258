"""Bronze -> silver -> gold, stage by stage.

Every stage is a lazy ``DataFrame -> DataFrame`` function; ``run`` wires them
with written tables in between, which cuts lineage (a lost executor recomputes
from the last written table, not from the text files) and lets each gate scan
a columnar table instead of recomputing its input.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from tallymart.functions.codes import clean_label, composite_id, to_int
from tallymart.operators.classify import entity_class, row_kind
from tallymart.operators.clean import align, blank_to_null, pad_codes, project, trim_sentinel
from tallymart.operators.mart import summary, summary_onepass
from tallymart.operators.model import dimension, fact
from tallymart.operators.quality import (
    captured,
    enforce,
    evaluate,
    fk_orphans,
    key_collisions,
    observe_rules,
    observed_counts,
    pk_duplicates,
    stack_rows,
)
from tallymart.operators.reshape import expand_measure
from tallymart.plans.layout import BUILT_KEYS, contract_rules, truncation_rules
from tallymart.session import drop_scratch, scratch_path, shuffles_removed
from tallymart.sources.delimited import (
    INGESTED_AT,
    OK,
    SOURCE,
    SOURCE_FILE,
    failed_sources,
    ingest_report,
    quarantine,
    read_staged,
    rejected_lines,
    stage_delimited,
)
from tallymart.sources.sink import (
    Folder,
    beside,
    drop_folders,
    is_path,
    partition_value,
    publish,
    publish_clustered,
    read_table,
    replace_partitions,
    replace_table,
    stray_partitions,
)
from tallymart.spec import Contract, TallySpec


#: The summary mart among the gold tables.
MART = "resumen_mesa"
#: Key checks that run side by side: each has shuffles of its own on disk.
CHECKS_AT_ONCE = 2


def clean_bronze(raw: DataFrame, spec: TallySpec) -> DataFrame:
    """Trim + sentinel on the text fields only (P3); audit columns keep their types."""
    text = [f.name for f in spec.source.schema.fields if f.name in raw.columns]
    return trim_sentinel(raw, spec.sentinel, text)


def bronze_contract(spec: TallySpec) -> Contract:
    """Bronze: every text field plus the two audit columns, partitioned by
    the district code when the spec names one."""
    fields = list(spec.source.schema.fields) + [
        StructField(SOURCE_FILE, StringType(), True),
        StructField(INGESTED_AT, TimestampType(), True),
    ]
    parts = (spec.bronze_partition,) if spec.bronze_partition else ()
    return Contract("bronze", StructType(fields), partition_by=parts)


def pre_pad(bronze: DataFrame, spec: TallySpec) -> DataFrame:
    """Renamed, blank-nulled rows before code padding (P1, P2, P4): the input
    of the truncation pre-check (``layout.truncation_rules``)."""
    return blank_to_null(project(bronze, {c: spec.rename.get(c, c) for c in spec.bronze_columns}))


def normalize(bronze: DataFrame, spec: TallySpec) -> DataFrame:
    """Row-local silver derivations (P1, P2, P4-P9), one collapsed projection."""
    df = pad_codes(pre_pad(bronze, spec), spec.widths)
    key = spec.id_key
    df = df.withColumn(key.output, composite_id(key))
    df = df.withColumn(spec.label_output, clean_label(*spec.label_parts, unicode=spec.label_unicode))
    df = df.withColumns({c: to_int(c) for c in spec.int_columns})
    return row_kind(df, spec.kind)


def silver(bronze: DataFrame, spec: TallySpec, method: str | None = "join") -> DataFrame:
    """Normalise, classify entities, add measure rows, align to the contract;
    ``method=None`` leaves the entity class out."""
    df = normalize(bronze, spec)
    if method is not None:
        df = entity_class(df, spec.classes, method=method)
    df = expand_measure(df, spec.measure_row)
    return align(df, [c for c in spec.silver.names if method is not None or c != spec.classes.output])


def gold(
    silver_df: DataFrame,
    spec: TallySpec,
    onepass: bool = True,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Fact, six dimensions and the summary mart.

    The mart uses the one-scan plan by default (measured faster on a parquet
    silver and exact on any input); ``onepass=False`` gives the pivot + join.
    ``stage``: see ``summary_onepass``.
    """
    tables = {"fact_resultados": fact(silver_df, spec.fact.columns)}
    for name, dim in spec.dims.items():
        tables[name] = dimension(silver_df, dim)
    tables[MART] = summary_onepass(silver_df, spec.summary, stage) if onepass else summary(silver_df, spec.summary)
    return tables


def table_checks(df: DataFrame, contract: Contract) -> DataFrame:
    """Primary-key and NOT NULL checks of one table (K1, K3): NULLs are
    counted in an aggregate without a key, so only the key columns are
    shuffled, to count keys that occur twice.
    ``(check, table, detail, violations)``."""
    not_null = [c for c in contract.not_null if c in df.columns]
    key = list(contract.primary_key)
    parts = []
    if key:
        twice = pk_duplicates(df.select(*key), key).agg(F.count(F.lit(1)).alias("violations"))
        parts.append(twice.select(F.lit("primary_key").alias("check"), F.lit(",".join(key)).alias("detail"), "violations"))
    if not_null:
        nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(not_null)])
        entries = [(F.lit("not_null"), F.lit(c), F.col(f"n{i}")) for i, c in enumerate(not_null)]
        parts.append(stack_rows(nulls, entries, ("check", "detail", "violations")))
    out = reduce(DataFrame.unionByName, parts)
    return out.select("check", F.lit(contract.name).alias("table"), "detail",
                      F.col("violations").cast("bigint").alias("violations"))


def collision_parts(silver_df: DataFrame, spec: TallySpec) -> list[DataFrame]:
    """Built keys that stand for several tuples of their parts (edges 12, 13),
    a table of one row per key in the form of ``gold_checks``."""
    out = []
    for name, (key, parts) in BUILT_KEYS.items():
        found = key_collisions(silver_df, key, parts).agg(F.count(F.lit(1)).alias("violations"))
        out.append(found.select(F.lit("collision").alias("check"), F.lit(spec.silver.name).alias("table"),
                                F.lit(f"{name} <- {','.join(parts)}").alias("detail"), "violations"))
    return out


def collision_checks(silver_df: DataFrame, spec: TallySpec) -> DataFrame:
    """All of ``collision_parts`` as one table."""
    return reduce(DataFrame.unionByName, collision_parts(silver_df, spec))


def check_parts(tables: dict[str, DataFrame], spec: TallySpec) -> list[DataFrame]:
    """The checks of ``gold_checks``, a table per gold table and foreign key."""
    parts = [table_checks(tables[name], contract) for name, contract in spec.gold.items() if name in tables]
    for fk in spec.foreign_keys:
        if fk.child in tables and fk.parent in tables:
            orphans = fk_orphans(tables[fk.child], fk.columns, tables[fk.parent], fk.parent_columns)
            agg = orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations"))
            detail = f"{','.join(fk.columns)} -> {fk.parent}({','.join(fk.parent_columns)})"
            parts.append(agg.select(F.lit("foreign_key").alias("check"), F.lit(fk.child).alias("table"),
                                    F.lit(detail).alias("detail"), F.col("violations").cast("bigint")))
    return parts


def gold_checks(tables: dict[str, DataFrame], spec: TallySpec) -> DataFrame:
    """Key and NOT NULL checks over the gold tables (K1-K3), one row per check:
    ``(check, table, detail, violations)``; foreign keys count orphan rows."""
    return reduce(DataFrame.unionByName, check_parts(tables, spec))


Target = Callable[[str], str]


#: Reports published beside the tables.
INGEST_REPORT, QUALITY_REPORT, VIOLATIONS = "ingest_report", "quality_report", "quality_violations"
REJECTED, KEY_REPORT = "ingest_rejected", "key_report"
_REPORTS = (INGEST_REPORT, REJECTED, QUALITY_REPORT, VIOLATIONS, KEY_REPORT)
_CHECK_SCHEMA = "check string, table string, detail string, violations bigint"
_REPORT_SCHEMA = "rule string, position int, violations bigint, enforced boolean"


def path_targets(out_root: str) -> Target:
    """Table name -> storage path: ``<root>/bronze``, ``<root>/silver``,
    ``<root>/reports/<report>`` and ``<root>/gold/<table>``."""
    root = out_root.rstrip("/")
    folder = {"bronze": "", "silver": "", **dict.fromkeys(_REPORTS, "reports/")}
    return lambda name: f"{root}/{folder.get(name, 'gold/')}{name}"


def table_targets(prefix: str) -> Target:
    """Table name -> catalog table, e.g. ``table_targets("tally.")`` gives
    ``tally.silver``, ``tally.resumen_mesa``."""
    return lambda name: f"{prefix}{name}"


def _target(out: str | Target) -> Target:
    return out if callable(out) else path_targets(out)


def publish_tables(
    tables: dict[str, DataFrame],
    contracts: dict[str, Contract],
    root: str | Target,
    concurrency: int | None = None,
) -> dict[str, str]:
    """Write independent tables, each aligned to its contract, under a root
    path (``<root>/<table>``) or wherever a target function names them.

    The tables are independent jobs over the same input, so they are
    submitted from driver threads at once; Spark's scheduler runs their tasks
    side by side, which keeps executors busy while small jobs are in their
    final stages.
    """
    name_of = root if callable(root) else (lambda name, r=root.rstrip("/"): f"{r}/{name}")
    paths = {name: name_of(name) for name in tables}

    def write(name: str) -> None:
        publish(tables[name], paths[name], contract=contracts[name])

    with ThreadPoolExecutor(max_workers=max(1, concurrency or len(tables))) as pool:
        for future in [pool.submit(write, name) for name in tables]:
            future.result()
    return paths


def publish_gold(
    tables: dict[str, DataFrame], spec: TallySpec, root: str | Target, concurrency: int | None = None
) -> dict[str, str]:
    """Write every gold table aligned to its contract (see ``publish_tables``)."""
    return publish_tables(tables, dict(spec.gold), root, concurrency)


def read_gold(spark: SparkSession, paths: dict[str, str], spec: TallySpec) -> dict[str, DataFrame]:
    return {name: read_table(spark, path, spec.gold[name]) for name, path in paths.items()}


@dataclass
class RunResult:
    """What a run did; the published reports hold all of it.

    ``ingest``: failed sources; ``quality``: violations of every gate;
    ``truncated``: codes longer than their width, per column; ``keys``: key
    checks of the gold tables that found something; ``replaced``: partitions
    of bronze that a reload replaced; ``tables``: where each table went.
    """

    ingest: list[tuple[str, str, int, int]] = field(default_factory=list)
    quality: list[tuple[str, int]] = field(default_factory=list)
    truncated: list[tuple[str, int]] = field(default_factory=list)
    keys: list[tuple[str, str, str, int]] = field(default_factory=list)
    replaced: list[str] = field(default_factory=list)
    tables: dict[str, str] = field(default_factory=dict)


class IngestError(RuntimeError):
    pass


@contextmanager
def _staging(spark: SparkSession, name: str, target: str):
    """A table of this run alone, removed when the stage is over unless it has
    been renamed: beside its target, or in scratch for a catalog table."""
    path = beside(target) if is_path(target) else scratch_path(spark, name)
    try:
        yield path
    finally:
        if is_path(target):
            Folder(spark, path).delete(path)
        else:
            drop_scratch(spark, path)


def ingest(
    spark: SparkSession,
    paths,
    spec: TallySpec,
    out: str | Target,
    expected=None,
    enforce_sources: bool = True,
    result: RunResult | None = None,
    reload: list[str] | None = None,
) -> str:
    """Bronze stage (S1-S3, S5, S9): parse every file once, clean it and write
    it, partitioned as bronze is and by source, beside bronze; publish a report
    per source and every line that is kept out; drop the folders of sources
    that failed; rename the rest into place.  Nothing is written twice.

    A source that is missing, empty, unreadable, incomplete, malformed,
    misplaced or unexpected has its row in the report and never affects another
    one; the stage raises afterwards if any failed (good sources stay loaded,
    as a per-file loop would).  Without any OK source bronze stays as it was.

    ``reload``: partition values (districts) that this delivery may replace.
    Their partitions are replaced one by one and all others keep their files;
    rows of any other partition stop the stage before anything is replaced.
    """
    result = result or RunResult()
    target = _target(out)
    path = target("bronze")
    if reload is not None and not (is_path(path) and spec.bronze_partition):
        raise ValueError("a reload needs bronze at a path, partitioned")
    parts = (spec.bronze_partition, SOURCE) if spec.bronze_partition else (SOURCE,)
    with _staging(spark, "bronze-staging", path) as staging:
        failed = stage_delimited(spark, paths, spec.source, staging, lambda df: clean_bronze(df, spec), parts)
        staged = read_staged(spark, spec.source, staging)
        corrupt = spec.source.corrupt_column
        found = ingest_report(staged, expected, corrupt, failed=failed, placement=spec.source.placement)
        publish(found.coalesce(1), target(INGEST_REPORT))
        report = read_table(spark, target(INGEST_REPORT))
        result.tables[INGEST_REPORT] = target(INGEST_REPORT)
        result.ingest = failed_sources(report)
        publish(rejected_lines(staged, report, spec.source), target(REJECTED))
        result.tables[REJECTED] = target(REJECTED)
        loaded = {r["source"] for r in report.filter(F.col("status") == OK).select("source").collect()}
        if not loaded:
            raise IngestError(f"no source can be loaded, bronze is unchanged: {_told(result.ingest)}")
        if not is_path(path):
            publish(quarantine(staged, report, corrupt), path, contract=bronze_contract(spec))
        else:
            pattern = "/".join(["*=*"] * len(parts))
            drop_folders(spark, staging, pattern, lambda name: partition_value(name) not in loaded)
            _drop_empty(spark, staging)
            if reload is None:
                replace_table(spark, staging, path)
            else:
                stray = stray_partitions(spark, staging, reload)
                if stray:
                    raise IngestError(f"rows of partitions that are not reloaded, bronze is unchanged: {', '.join(stray)}")
                result.replaced = replace_partitions(spark, staging, path)
    result.tables["bronze"] = path
    if result.ingest and enforce_sources:
        raise IngestError(f"ingest finished with failed source(s): {_told(result.ingest)}")
    return path


def _drop_empty(spark: SparkSession, table: str) -> None:
    """Remove partition folders that hold nothing any more, which would
    otherwise replace ones that do."""
    folder = Folder(spark, table)
    full = {name.partition("/")[0] for name in folder.children("*=*/*")}
    drop_folders(spark, table, "*=*", lambda name: name not in full)


def _told(failed) -> str:
    return "; ".join(f"{s}: {status} ({n} rows, {b} malformed)" for s, status, n, b in failed)


def build_silver(
    spark: SparkSession,
    spec: TallySpec,
    out: str | Target,
    enforce_quality: bool = True,
    result: RunResult | None = None,
    enforce_widths: bool = False,
    buckets: int | None = None,
) -> str:
    """Silver stage, from the published bronze: write, gate, rename.

    Silver is written once, beside its place.  That write counts its rows and
    what every row rule objects to; the grouped rules, and the rows of row
    rules that fired, are captured from the written copy, one scan each.  The
    report and the violations of this run (none, when nothing fired) replace
    those of the last one; silver is renamed into place if no gate fired, and
    otherwise stays as it was.

    Codes cut to their width are in the report; they are a gate where
    ``enforce_widths`` is set.  ``buckets`` clusters a catalog table of silver
    by the entity key (see ``publish_clustered``).
    """
    result = result or RunResult()
    target = _target(out)
    path = target("silver")
    if buckets and is_path(path):
        raise ValueError("only catalog tables can be bucketed")
    bronze = read_table(spark, target("bronze"), bronze_contract(spec))
    rules = (*spec.rules, *contract_rules(spec))
    with _staging(spark, "silver-staging", path) as staging:
        rows, seen = observe_rules(silver(bronze, spec), rules, "silver")
        publish(rows, staging, contract=spec.silver, swap=False)
        n_rows, counts = observed_counts(seen, rules)
        staged = read_table(spark, staging, spec.silver)
        publish(captured(staged, rules, {name for name, n in counts.items() if n}), target(VIOLATIONS))
        result.tables[VIOLATIONS] = target(VIOLATIONS)
        # Row rules were counted by the write; groups and distinct values are rows of the violations.
        listed = {r.name for r in rules if r.grouped or r.distinct}
        tally = read_table(spark, target(VIOLATIONS)).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
        kept = {r["rule"]: int(r["n"]) for r in tally.collect()}  # a row per rule
        result.quality = [(r.name, kept.get(r.name, 0) if r.name in listed else counts[r.name]) for r in rules]
        result.quality.append(("silver_has_rows", int(n_rows == 0)))
        cut = evaluate(pre_pad(bronze, spec), truncation_rules(spec.widths))
        result.truncated = [(r["rule"], int(r["violations"])) for r in cut.orderBy("position").collect()]
        told = [(*r, True) for r in result.quality] + [(*r, enforce_widths) for r in result.truncated]
        entries = [(name, i, n, enforced) for i, (name, n, enforced) in enumerate(told)]
        publish(spark.createDataFrame(entries, _REPORT_SCHEMA).coalesce(1), target(QUALITY_REPORT))
        result.tables[QUALITY_REPORT] = target(QUALITY_REPORT)
        if enforce_quality:
            enforce(read_table(spark, target(QUALITY_REPORT)).filter("enforced"))
        if is_path(path):
            replace_table(spark, staging, path)
        elif buckets:
            publish_clustered(staged, path, spec.silver, spec.classes.key, buckets)
        else:
            publish(staged, path, contract=spec.silver)
    result.tables["silver"] = path
    return path


def build_gold(
    spark: SparkSession,
    spec: TallySpec,
    out: str | Target,
    onepass: bool = True,
    result: RunResult | None = None,
    check_keys: bool = True,
    stage_mart: bool = False,
) -> dict[str, str]:
    """Gold stage, from the published silver: the eight tables, side by side,
    then a report of their declared keys (K1-K3) and of built keys that
    collide, which never stops a run.

    The mart, whose shuffles are the largest, comes before the others; with
    ``stage_mart`` its first level is written, so that those of its two levels
    are not on disk at once.  The checks (each a few rows) run a few at a time."""
    result = result or RunResult()
    target = _target(out)
    rows = read_table(spark, target("silver"), spec.silver)
    with _staging(spark, "mart-staging", target(MART)) as staging:

        def stage(level1: DataFrame) -> DataFrame:
            publish(level1, staging, swap=False)
            return spark.read.schema(level1.schema).parquet(staging)

        tables = gold(rows, spec, onepass=onepass, stage=stage if stage_mart else None)
        first = publish_gold({MART: tables[MART]}, spec, target)
    paths = publish_gold({name: df for name, df in tables.items() if name != MART}, spec, target) | first
    result.tables.update(paths)
    if check_keys:
        parts = check_parts(read_gold(spark, paths, spec), spec) + collision_parts(rows, spec)
        with ThreadPoolExecutor(max_workers=CHECKS_AT_ONCE) as pool:
            found = [tuple(r) for some in pool.map(DataFrame.collect, parts) for r in some]  # a row per check
        publish(spark.createDataFrame(found, _CHECK_SCHEMA).coalesce(1), target(KEY_REPORT))
        result.tables[KEY_REPORT] = target(KEY_REPORT)
        found = read_table(spark, target(KEY_REPORT)).filter("violations > 0").orderBy("check", "table", "detail")
        result.keys = [tuple(r) for r in found.collect()]  # at most a row per check
    return paths


def run(
    spark: SparkSession,
    paths,
    spec: TallySpec,
    out: str | Target,
    expected=None,
    enforce_sources: bool = True,
    enforce_quality: bool = True,
    onepass: bool = True,
    reload: list[str] | None = None,
    enforce_widths: bool = False,
    buckets: int | None = None,
    check_keys: bool = True,
    stage_mart: bool = False,
) -> RunResult:
    """Full refresh of bronze, silver and gold under the root path ``out``
    (or into the catalog tables a target function such as
    ``table_targets("tally.")`` names): three stages that can be started
    anew, each from the table the one before has published.  With ``reload``
    bronze keeps all other districts; silver and gold are made anew from it.
    ``stage_mart`` trades one more write for disk (see ``build_gold``)."""
    result = RunResult()
    with shuffles_removed(spark):
        ingest(spark, paths, spec, out, expected, enforce_sources, result, reload)
        build_silver(spark, spec, out, enforce_quality, result, enforce_widths, buckets)
        build_gold(spark, spec, out, onepass, result, check_keys, stage_mart)
    return result
