"""Table sinks and contracts.

Writes always align columns **by name** to the contract before writing, so a
partition column moved last by the table format, or a renamed column, can
never shift values into the wrong place the way a positional insert does.

A table at a path is written to a folder beside it and then renamed into
place, as a whole or one partition at a time: readers find the old files or
the new ones, never some of each, and a write that dies leaves the old table.
Where a driver dies between the two renames, ``recover_table`` (called by the
next write) puts the old table back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.spec import Contract

#: Codec of parquet files: codes and ids take about a third less than with
#: Spark's default.
CODEC = "zstd"


def is_path(target: str) -> bool:
    """A target with a slash or a scheme is a storage path; anything else is
    a catalog table name (``schema.table``)."""
    return "/" in target or ":" in target


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Select the contract's columns by name, in order, cast to its types.

    A missing column fails at analysis time.  NOT NULL is checked by
    ``quality.null_contract``, not here, so conforming stays lazy.
    """
    missing = [n for n in contract.names if n not in df.columns]
    if missing:
        raise ValueError(f"{contract.name}: missing column(s) {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.schema.fields])


class Folder:
    """Metadata operations on the file system of a path (no data is read)."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.fs = self._of(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    @property
    def parent(self) -> str:
        return self.path.rpartition("/")[0]

    @property
    def name(self) -> str:
        return self.path.rpartition("/")[2]

    def exists(self, path: str | None = None) -> bool:
        return self.fs.exists(self._of(path or self.path))

    def delete(self, path: str) -> None:
        self.fs.delete(self._of(path), True)

    def move(self, source: str, target: str) -> None:
        """One rename; the target must not exist, its folder is made."""
        self.fs.mkdirs(self._of(target.rpartition("/")[0]))
        if self.exists(target) or not self.fs.rename(self._of(source), self._of(target)):
            raise OSError(f"cannot rename {source} to {target}")

    def children(self, pattern: str) -> list[str]:
        """Names under the folder that match a glob, relative to it."""
        root = self.fs.makeQualified(self._of(self.path)).toString().rstrip("/") + "/"
        found = self.fs.globStatus(self._of(f"{self.path}/{pattern}")) or []
        return sorted(s.getPath().toString().removeprefix(root) for s in found)


def beside(target: str, kind: str = "_staging") -> str:
    """A fresh folder on the same file system as a table, hidden to scans."""
    parent, _, name = target.rstrip("/").rpartition("/")
    return f"{parent}/{kind}-{name.replace('=', '-')}-{uuid.uuid4().hex}"


def recover_table(spark: SparkSession, target: str) -> bool:
    """Put back a table that was moved aside by a replacement that died
    before the new one was in its place."""
    folder = Folder(spark, target)
    if folder.exists():
        return False
    kept = Folder(spark, folder.parent).children(f"_replaced-{folder.name}-{'?' * 32}")
    if not kept:
        return False
    folder.move(f"{folder.parent}/{kept[-1]}", folder.path)
    return True


def replace_table(spark: SparkSession, staged: str, target: str) -> None:
    """Put the table written at ``staged`` in the place of ``target``."""
    recover_table(spark, target)
    folder, aside = Folder(spark, target), beside(target, "_replaced")
    old = folder.exists()
    if old:
        folder.move(folder.path, aside)
    try:
        folder.move(staged, folder.path)
    except Exception:
        if old:
            folder.move(aside, folder.path)
        raise
    if old:
        folder.delete(aside)
    spark.catalog.refreshByPath(target)


def replace_partitions(spark: SparkSession, staged: str, target: str) -> list[str]:
    """Put every partition folder of the table at ``staged`` in the place of
    the same one of ``target`` (S5); the others keep their files.  Returns the
    names of the partitions."""
    recover_table(spark, target)
    folder, new = Folder(spark, target), Folder(spark, staged)
    names = new.children("*=*")
    for name in names:
        aside, place = beside(f"{folder.parent}/{name}", "_replaced"), f"{folder.path}/{name}"
        old = folder.exists(place)
        if old:
            folder.move(place, aside)
        try:
            folder.move(f"{new.path}/{name}", place)
        except Exception:
            if old:
                folder.move(aside, place)
            raise
        if old:
            folder.delete(aside)
    folder.delete(new.path)
    spark.catalog.refreshByPath(target)
    return names


def partition_value(name: str) -> str:
    """The value in a partition folder's name."""
    return unquote(name.partition("=")[2])


def publish_partitions(
    df: DataFrame,
    target: str,
    contract: Contract,
    allowed: Iterable[str] | None = None,
    max_records_per_file: int | None = 5_000_000,
) -> list[str]:
    """Replace only the partitions (by the contract's first partition column)
    that ``df`` has rows of (S5), and return their folder names.

    ``allowed``: values that may be replaced; a row of any other stops the
    write before anything is replaced, for it would wipe out a partition that
    was not delivered.
    """
    spark, staged = df.sparkSession, beside(target)
    publish(df, staged, contract, max_records_per_file=max_records_per_file, swap=False)
    stray = stray_partitions(spark, staged, allowed)
    if stray:
        Folder(spark, staged).delete(staged)
        raise ValueError(f"rows of partitions that are not to be replaced: {', '.join(stray)}")
    return replace_partitions(spark, staged, target)


def stray_partitions(spark: SparkSession, staged: str, allowed: Iterable[str] | None) -> list[str]:
    """Partition values of a table that are none of the ``allowed``."""
    if allowed is None:
        return []
    return sorted({partition_value(n) for n in Folder(spark, staged).children("*=*")} - set(allowed))


def drop_folders(spark: SparkSession, table: str, pattern: str, unwanted: Callable[[str], bool]) -> None:
    """Delete the folders of a table (a glob under it) that are unwanted by
    their last name."""
    folder = Folder(spark, table)
    for name in folder.children(pattern):
        if unwanted(name.rpartition("/")[2]):
            folder.delete(f"{folder.path}/{name}")


def publish_clustered(
    df: DataFrame, table: str, contract: Contract, key: Sequence[str], buckets: int, splits: int = 4, location: str | None = None
) -> None:
    """Full-refresh write of a catalog table bucketed and sorted by ``key``:
    aggregates, windows and joins whose keys hold ``key`` need no exchange.

    Rows are dealt to tasks by bucket and a hash of the row, so a key with a
    third of all rows is written by ``splits`` tasks, and a bucket has about
    that many files.  Reading, a bucket is one task: aggregates stream it in
    bounded memory, but for tables with such a key the plain form is faster,
    whose shuffles are combined map-side and whose joins AQE splits.
    ``location`` makes it an external table there.
    """
    out = conform(df, contract)
    place = [F.pmod(F.hash(*key), F.lit(buckets)), F.pmod(F.xxhash64(*out.columns), F.lit(splits))]
    writer = out.repartition(buckets * splits, *place).write.format("parquet").mode("overwrite")
    writer = writer.bucketBy(buckets, *key).sortBy(*key)
    (writer.option("path", location) if location else writer).saveAsTable(table)


def publish(
    df: DataFrame,
    target: str,
    contract: Contract | None = None,
    partition_by: Sequence[str] | None = None,
    fmt: str = "parquet",
    mode: str = "overwrite",
    max_records_per_file: int | None = 5_000_000,
    swap: bool = True,
) -> None:
    """Full-refresh write of a table (S5-S7) to a path or a catalog table.

    One overwrite replaces the whole table, which makes re-runs idempotent; at
    a path it is written beside the old one and renamed into place (``swap``).
    Partition columns default to the contract's.  Files are capped at
    ``max_records_per_file`` rows, so a district holding a third of the data
    is written as many bounded files rather than one huge one, without a
    repartition (which would send that district to a single task).
    """
    out = conform(df, contract) if contract is not None else df
    parts = list(partition_by if partition_by is not None else (contract.partition_by if contract else ()))
    writer = out.write.format(fmt).mode(mode)
    if fmt == "parquet":
        writer = writer.option("compression", CODEC)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    if parts:
        writer = writer.partitionBy(*parts)
    if not is_path(target):
        writer.saveAsTable(target)
    elif swap and mode == "overwrite":
        staged = beside(target)
        try:
            writer.save(staged)
        except Exception:
            Folder(df.sparkSession, staged).delete(staged)
            raise
        replace_table(df.sparkSession, staged, target)
    else:
        writer.save(target)


def read_table(spark: SparkSession, target: str, contract: Contract | None = None, fmt: str = "parquet") -> DataFrame:
    """Scan a published table (S4) by path or catalog name, aligned by name
    to its contract.

    For a path, the scan uses the contract's schema, so partition values such
    as district ``'01'`` stay text instead of being inferred as the number 1
    (a catalog table already records its schema).
    """
    if not is_path(target):
        df = spark.table(target)
        return conform(df, contract) if contract is not None else df
    reader = spark.read.format(fmt)
    if contract is None:
        return reader.load(target)
    return conform(reader.schema(contract.schema).load(target), contract)
