"""Delimited text sources with per-source quarantine.

All files of a family are read in **one** multi-file scan with an explicit
schema.  Every row carries its source id (derived from the file path) and the
raw line when it is malformed, so one grouped aggregate reports rows and bad
rows per source, and a semi-join keeps only the rows of clean sources.  What
is kept out goes to a table of rejected lines, so every line is accounted for.
A file that cannot be read is found by halving the list of files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallymart.sources.sink import CODEC
from tallymart.spec import SourceSpec

SOURCE = "_source"
SOURCE_FILE = "_source_file"
INGESTED_AT = "_ingestion_timestamp"

# Report statuses, in the order they are tested.
UNREADABLE = "UNREADABLE"
NO_ROWS = "NO_ROWS"
INCOMPLETE = "INCOMPLETE"
UNEXPECTED = "UNEXPECTED"
MALFORMED = "MALFORMED"
MISPLACED = "MISPLACED"
OK = "OK"

_FAILURES = "source string, failure string, path string, error string"


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    spec: SourceSpec,
    provenance: bool = True,
) -> DataFrame:
    """Scan delimited files with an explicit all-column schema.

    In PERMISSIVE mode a malformed line (too few or too many fields, an
    unbalanced quote) keeps its raw text in ``spec.corrupt_column``.  CSV
    column pruning is switched off for this reader so a malformed line is
    detected even when a query reads few columns.  With ``provenance`` the
    source file, its id and the ingestion time are added (S3).
    """
    schema = spec.schema
    options = {
        "sep": spec.sep,
        "header": str(spec.header).lower(),
        "encoding": spec.encoding,
        "quote": spec.quote,
        "mode": spec.mode,
    }
    if spec.mode.upper() == "PERMISSIVE":
        schema = StructType(list(schema.fields) + [StructField(spec.corrupt_column, StringType(), True)])
        options["columnNameOfCorruptRecord"] = spec.corrupt_column
        options["columnPruning"] = "false"
    reader = spark.read.schema(schema).options(**options)
    df = reader.csv(list(paths) if not isinstance(paths, str) else paths)
    return with_provenance(df, spec) if provenance else df


def file_path():
    """The scanned file's path, decoded from its URI form (spaces are stored
    as %20).  A literal '+' is protected first: URL decoding would read it as
    a space.  Evaluated for every line, so nothing is decoded where the path
    holds no %."""
    uri = F.col("_metadata.file_path")
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(uri, F.lit("%")), decoded).otherwise(uri)


def _source_of(path, spec: SourceSpec):
    """Source id of a decoded path: the regex group of ``spec.source_pattern``,
    or the file name where the pattern does not match.  Never NULL or empty
    for a file, so no row can slip past a comparison of sources."""
    name = F.regexp_extract(path, r"([^/]+)/*$", 1)
    if not spec.source_pattern:
        return name
    return F.coalesce(F.nullif(F.regexp_extract(path, spec.source_pattern, 1), F.lit("")), name)


def source_id(spec: SourceSpec):
    """Source id column of a scan."""
    return _source_of(file_path(), spec)


def with_provenance(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Add ``_source``, ``_source_file`` and ``_ingestion_timestamp`` (S3)."""
    return df.withColumns(
        {
            SOURCE: source_id(spec),
            SOURCE_FILE: file_path(),
            INGESTED_AT: F.current_timestamp(),
        }
    )


def split_paths(spark: SparkSession, paths: str | Sequence[str]) -> tuple[list[str], list[str]]:
    """(present, missing) of the paths or globs given: one that is missing is
    its own source's fault and must not fail the scan of the others.  Asks the
    file system for each, no Spark job."""
    present, missing = [], []
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in [paths] if isinstance(paths, str) else list(paths):
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        found = path.getFileSystem(conf).globStatus(path)
        (present if found else missing).append(p)
    return present, missing


def empty_scan(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """What ``read_delimited`` returns, without a row."""
    fields = [*spec.schema.fields, StructField(spec.corrupt_column, StringType(), True)]
    rows = spark.createDataFrame([], StructType(fields))
    return rows.withColumns({
        SOURCE: F.lit(""), SOURCE_FILE: F.lit(""), INGESTED_AT: F.current_timestamp()
    })


def first_line(error: Exception) -> str:
    """What went wrong, in one line: the innermost cause that Spark names."""
    lines = [x.strip() for x in str(error).splitlines() if x.strip()]
    causes = [x.removeprefix("Caused by: ") for x in lines if x.startswith("Caused by: ")]
    return (causes[-1] if causes else lines[0] if lines else type(error).__name__)[:500]


def unreadable(files: Sequence[str], scan: Callable[[list[str]], None], failed: Exception | None = None) -> list[tuple[str, str]]:
    """(file, error) of every file that ``scan`` (reads files to their end, or
    raises) cannot read, by halving: k bad ones of n cost about 2 k log2(n)
    scans, of halves that get smaller.  ``failed``: the error of a scan of all
    ``files`` that has failed already."""
    files = list(files)
    if failed is None:
        try:
            scan(files)
            return []
        except (Py4JJavaError, PySparkException) as err:
            failed = err
    if len(files) < 2:
        return [(f, first_line(failed)) for f in files]
    half = len(files) // 2
    left = unreadable(files[:half], scan)
    # A clean left half leaves the known failure to the right one.
    return left + unreadable(files[half:], scan, None if left else failed)


def unreadable_files(df: DataFrame, spec: SourceSpec, failed: Exception | None = None) -> list[tuple[str, str]]:
    """(file, error) of the files of a scan that cannot be read to their end.
    Only for a scan that has failed."""
    spark = df.sparkSession

    def scan(files: list[str]) -> None:
        read_delimited(spark, files, spec, provenance=False).write.format("noop").mode("overwrite").save()

    return unreadable([unquote(uri) for uri in df.inputFiles()], scan, failed)


def stage_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    spec: SourceSpec,
    target: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: Sequence[str] = (SOURCE,),
) -> DataFrame:
    """Parse every readable file once into a table at ``target``, partitioned
    by source; returns what could not be staged, ``(source, failure, path,
    error)``, one row per path or file.

    Input splits come from per-source files, so each task writes the files of
    one source; the record cap bounds file size for a very large source.
    ``prepare`` is applied to the rows before they are written.
    """

    def write(df: DataFrame) -> None:
        rows = prepare(df) if prepare else df
        writer = rows.write.mode("overwrite").option("maxRecordsPerFile", "5000000").option("compression", CODEC)
        writer.partitionBy(*partition_by).parquet(target)

    present, missing = split_paths(spark, paths)
    failures = [(p, NO_ROWS, "no such path") for p in missing]
    raw = read_delimited(spark, present, spec) if present else empty_scan(spark, spec)
    try:
        write(raw)
    except (Py4JJavaError, PySparkException) as err:
        bad = unreadable_files(raw, spec) if present else []
        if not bad:
            raise err
        failures += [(p, UNREADABLE, why) for p, why in bad]
        unusable = {p for p, _ in bad}
        good = [p for p in map(unquote, raw.inputFiles()) if p not in unusable]
        write(read_delimited(spark, good, spec) if good else empty_scan(spark, spec))
    failed = spark.createDataFrame(failures, "path string, failure string, error string")
    return failed.select(_source_of(F.col("path"), spec).alias("source"), "failure", "path", "error")


def read_staged(spark: SparkSession, spec: SourceSpec, target: str) -> DataFrame:
    """Scan of a staged table, with an explicit schema: source ids such as
    '01' must not be inferred as numbers."""
    return spark.read.schema(empty_scan(spark, spec).schema).parquet(target)


def ingest_report(
    raw: DataFrame,
    expected: Iterable[str] | None = None,
    corrupt_column: str = "_corrupt_record",
    key_column: str | None = None,
    failed: DataFrame | None = None,
    placement: str | None = None,
) -> DataFrame:
    """Rows and malformed rows per source with a status.

    ``(source, rows, bad_rows, null_key_rows, misplaced_rows, status, error)``; status is
    UNREADABLE for a source with a file that cannot be read, NO_ROWS for an
    expected source with no row (missing or empty file), INCOMPLETE for one
    that has rows but lacks a path that was named, UNEXPECTED for a source
    outside ``expected``, MALFORMED when any row failed to parse, MISPLACED
    when ``placement`` (see ``SourceSpec``) fails for any row that has parsed,
    otherwise OK.  ``error`` tells the first path at fault and why, and how many there
    are.  ``null_key_rows`` counts rows without their key field (default: the
    first column); they are rows like any other and left to the gates, but
    reading the field also keeps a data column in the scan, which Spark
    requires next to the corrupt-record column.  One grouped aggregate over
    the scan; the expected list is a parameter, ``failed`` the result of
    ``stage_delimited``.
    """
    spark = raw.sparkSession
    key = key_column or raw.columns[0]
    # FAILFAST scans have no corrupt-record column: a malformed line fails
    # the job instead, so every row that arrives here parsed.
    bad_rows = F.count(F.col(corrupt_column)) if corrupt_column in raw.columns else F.lit(0).cast("bigint")
    astray = F.lit(False)
    if placement:
        parsed = F.col(corrupt_column).isNull() if corrupt_column in raw.columns else F.lit(True)
        astray = parsed & ~F.coalesce(F.expr(placement), F.lit(False))
    report = raw.groupBy(F.col(SOURCE).alias("source")).agg(
        F.count(F.lit(1)).alias("rows"),
        bad_rows.alias("bad_rows"),
        F.count_if(F.col(key).isNull()).alias("null_key_rows"),
        F.count_if(astray).alias("misplaced_rows"),
    )
    if expected is None:
        report = report.withColumn("__expected", F.lit(True))
    else:
        wanted = spark.createDataFrame([(s,) for s in expected], "source string").distinct()
        report = wanted.withColumn("__expected", F.lit(True)).join(report, on="source", how="full")
    if failed is None:
        failed = spark.createDataFrame([], _FAILURES)
    worst = failed.groupBy("source").agg(
        F.max("failure").alias("__failure"),  # UNREADABLE before NO_ROWS
        F.count(F.lit(1)).alias("__paths"),
        F.min(F.struct(F.col("failure") != F.lit(UNREADABLE), "path", "error")).alias("__first"),
    )
    report = report.join(worst, on="source", how="full")
    counts = {
        c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in ("rows", "bad_rows", "null_key_rows", "misplaced_rows")
    }
    failure = F.col("__failure")
    status = (
        F.when(failure == UNREADABLE, F.lit(UNREADABLE))
        .when((counts["rows"] == 0) & (F.col("__expected").isNotNull() | failure.isNotNull()), F.lit(NO_ROWS))
        .when(failure.isNotNull(), F.lit(INCOMPLETE))
        .when(F.col("__expected").isNull(), F.lit(UNEXPECTED))
        .when(counts["bad_rows"] > 0, F.lit(MALFORMED))
        .when(counts["misplaced_rows"] > 0, F.lit(MISPLACED))
        .otherwise(F.lit(OK))
    )
    more = F.when(F.col("__paths") > 1, F.concat(F.lit(" (and "), F.col("__paths") - 1, F.lit(" more)"))).otherwise(F.lit(""))
    error = F.concat(F.col("__first.path"), F.lit(": "), F.col("__first.error"), more)
    return report.select("source", *[c.alias(n) for n, c in counts.items()], status.alias("status"), error.alias("error"))


def line_fault(line: Column, spec: SourceSpec) -> Column:
    """Why a line does not parse: its number of separators, or its quotes."""
    fields = F.length(line) - F.length(F.replace(line, F.lit(spec.sep), F.lit(""))) + 1
    quotes = F.length(line) - F.length(F.replace(line, F.lit(spec.quote), F.lit(""))) if spec.quote else F.lit(0)
    n = len(spec.schema.fields)
    return (
        F.when(quotes > 0, F.lit("BAD_QUOTING"))
        .when(fields < n, F.lit("TOO_FEW_FIELDS"))
        .when(fields > n, F.lit("TOO_MANY_FIELDS"))
        .otherwise(F.lit("MALFORMED"))
    )


def rejected_lines(raw: DataFrame, report: DataFrame, spec: SourceSpec) -> DataFrame:
    """Every line of a scan that ``quarantine`` keeps out (S2): ``(source,
    file, reason, line)``.

    A malformed line is given as it stands in the file, with its fault; a
    line that parsed but belongs to a source that is not OK (or that the
    report does not know) is held back with it, ``SOURCE_<status>``, spelled
    from its fields.  From the rows of the same parse: with the loaded rows
    they are all lines of all readable files.
    """
    status = report.select(F.col("source").alias(SOURCE), "status")
    rows = raw.join(status, on=SOURCE, how="left").filter(~F.col("status").eqNullSafe(F.lit(OK)))
    options = {"sep": spec.sep, "quote": spec.quote or "\u0000", "emptyValue": "",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    spelled = F.to_csv(F.struct(*[f.name for f in spec.schema.fields]), options)
    held = F.concat(F.lit("SOURCE_"), F.coalesce("status", F.lit(UNEXPECTED)))
    if spec.corrupt_column not in raw.columns:
        reason, line = held, spelled
    else:
        corrupt = F.col(spec.corrupt_column)
        reason = F.when(corrupt.isNotNull(), line_fault(corrupt, spec)).otherwise(held)
        line = F.coalesce(corrupt, spelled)
    return rows.select(F.col(SOURCE).alias("source"), F.col(SOURCE_FILE).alias("file"), reason.alias("reason"), line.alias("line"))


def quarantine(raw: DataFrame, report: DataFrame, corrupt_column: str = "_corrupt_record") -> DataFrame:
    """Rows of OK sources only, without the corrupt-record column.

    An equi-join, so a source the report does not know is kept out; Spark
    broadcasts the list of sources where its measured size allows it.
    """
    ok = report.filter(F.col("status") == F.lit(OK)).select(F.col("source").alias(SOURCE))
    return raw.join(ok, on=SOURCE, how="left_semi").drop(corrupt_column)


def failed_sources(report: DataFrame, limit: int = 1000) -> list[tuple[str, str, int, int]]:
    """The first ``limit`` non-OK sources of a report, for a message; the
    report itself has them all."""
    rows = report.filter(F.col("status") != F.lit(OK)).orderBy("source").limit(limit).collect()
    return [(r["source"], r["status"], int(r["rows"]), int(r["bad_rows"])) for r in rows]
