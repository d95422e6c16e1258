"""Session helpers: a local session for tests and benchmarks, and scratch
locations derived from the cluster's shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SKEW_CONF = "spark.sql.adaptive.forceOptimizeSkewedJoin"


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int | None = None,
    app: str = "tallymart",
    event_log_dir: str | None = None,
) -> SparkSession:
    """A local-mode session with AQE on, the UI off and UTC time.

    Only for tests and benchmarks: on a cluster, use the session the platform
    provides and keep its checkpoint folder.
    """
    if shuffle_partitions is None:
        shuffle_partitions = (os.cpu_count() or 8) if cores == "*" else int(cores)
    parts = shuffle_partitions
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TALLYMART_DRIVER_MEMORY", "8g"))
    )
    if event_log_dir:
        # Stage and task times without the UI: Spark's event log, read offline.
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the session names.

    Only a session whose executors are this very process (master ``local``)
    may do without: it gets a temporary folder.  On a cluster a folder of the
    driver's own disk would lose every executor's part of a table, so a
    missing setting is an error there.
    """
    current = spark.sparkContext.getCheckpointDir() or spark.conf.get(CHECKPOINT_CONF, None)
    if not current:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="tallymart-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, current)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return spark.sparkContext.getCheckpointDir() or current


def shared_root(spark: SparkSession) -> str:
    """The shared folder itself (``spark.checkpoint.dir``), not the
    per-context subfolder Spark adds for RDD checkpoints."""
    ensure_checkpoint_dir(spark)
    return (spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()).rstrip("/")


def scratch_path(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A location in this application's scratch folder, for intermediate
    tables that cut lineage (staging, round trips): fresh when ``unique``,
    otherwise stable, so a query that overwrites it on every call keeps one
    copy.  ``drop_scratch`` removes one, or all of the application's."""
    suffix = f"-{uuid.uuid4().hex}" if unique else ""
    return f"{_scratch_root(spark)}/{name}{suffix}"


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/tallymart-scratch/{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession, path: str | None = None) -> None:
    """Remove a scratch table that nothing reads any more (default: the whole
    scratch folder of this application, at the end of a job)."""
    root = _scratch_root(spark)
    if path is not None and not path.startswith(f"{root}/"):
        raise ValueError(f"{path} is not a scratch table of this application")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path or root)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def _set(spark: SparkSession, name: str, value: str):
    """A setting of the session, put back afterwards."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shuffles_removed(spark: SparkSession):
    """Inside, Spark removes the shuffle files of a query when it is over, not
    when the driver happens to collect garbage: a job of many writes then
    takes the disk of its largest one instead of all.  Only for work whose
    queries are run once, as each write is."""
    return _set(spark, CLEANUP_CONF, "true")


def hot_keys_split(spark: SparkSession):
    """Inside, AQE splits the hot partitions of a join even where the steps
    after it must then shuffle rows that otherwise stay where they are."""
    return _set(spark, SKEW_CONF, "true")


def materialize(df, name: str, fmt: str = "parquet", unique: bool = True):
    """Write ``df`` once under the shared checkpoint folder and return a scan
    of it: cuts lineage like ``checkpoint()``, but the copy is a columnar
    table, so every later consumer reads only the columns it needs.  With
    ``unique=False`` the copy replaces the previous one of the same name."""
    spark = df.sparkSession
    path = scratch_path(spark, name, unique)
    df.write.format(fmt).mode("overwrite").save(path)
    return spark.read.format(fmt).schema(df.schema).load(path)


#: More reducers than this make shuffle blocks too small to be worth reading.
MAX_REDUCERS = 20_000


def scale_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized from the input, for a cluster run.

    Shuffle partitions are ``input / target``, at least twice the cores (so
    every core has work) and at most ``MAX_REDUCERS``: blocks are the product
    of splits and reducers, and beyond that AQE's skew handling and spilling
    do better than smaller blocks.  Input splits grow where they would be more
    than four times as many as that.  AQE coalesces by size rather than
    keeping the default parallelism, as Spark advises for busy clusters (on a
    laptop-sized input that collapses small shuffles into one task, measured
    ~50% slower on local[8], so ``local_session`` keeps Spark's default).
    Apply with ``spark.conf.set`` (all are runtime SQL settings).
    """
    partitions = min(MAX_REDUCERS, max(2 * cores, -(-input_bytes // target_partition_bytes)))
    split = max(target_partition_bytes, -(-input_bytes // (4 * MAX_REDUCERS)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(split),
    }


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the files under ``paths`` (their lengths only are read)."""
    files = spark.read.format("binaryFile").load(paths).select("length")
    return int(files.agg({"length": "sum"}).first()[0] or 0)
