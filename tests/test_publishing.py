"""Tables are replaced as a whole or a district at a time, never half."""

import os
from dataclasses import replace

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallymart.plans.elections import ELECTION
from tallymart.plans.medallion import IngestError, run, table_targets
from tallymart.sources import sink
from tallymart.spec import Contract
from test_medallion import bronze_counts, good_files, table_lines, write

T = Contract("t", StructType([StructField("v", StringType()), StructField("d", StringType())]), partition_by=("d",))


def files(path):
    return {os.path.relpath(os.path.join(a, n), path): os.stat(os.path.join(a, n)).st_mtime_ns
            for a, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


def rows(spark, path):
    return sorted(tuple(r) for r in sink.read_table(spark, path, T).collect())


def frame(spark, *values):
    return spark.createDataFrame([(v, v[0]) for v in values], "v string, d string")


def test_a_write_that_dies_leaves_the_old_table(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    sink.publish(frame(spark, "a1", "b1"), path, T)
    broken = spark.range(0, 1000, 1, 4).select(
        F.when(F.col("id") > 900, F.raise_error(F.lit("dead"))).otherwise(F.col("id").cast("string")).alias("v"), F.lit("a").alias("d")
    )
    with pytest.raises((Py4JJavaError, PySparkException)):
        sink.publish(broken, path, T)
    assert rows(spark, path) == [("a1", "a"), ("b1", "b")] and os.listdir(tmp_dir) == ["t"]


def test_a_table_may_be_made_from_itself(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    sink.publish(frame(spark, "a1", "b1"), path, T)
    sink.publish(sink.read_table(spark, path, T).withColumn("v", F.concat("v", F.lit("!"))), path, T)
    assert rows(spark, path) == [("a1!", "a"), ("b1!", "b")]


def test_a_driver_that_died_between_the_renames(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    sink.publish(frame(spark, "a1"), path, T)
    os.rename(path, sink.beside(path, "_replaced"))
    assert sink.recover_table(spark, path) and not sink.recover_table(spark, path)
    assert rows(spark, path) == [("a1", "a")]
    os.rename(path, sink.beside(path, "_replaced"))
    assert sink.publish_partitions(frame(spark, "b1"), path, T) == ["d=b"]
    assert rows(spark, path) == [("a1", "a"), ("b1", "b")]


def test_a_rename_that_fails_puts_the_old_table_back(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/t"
    sink.publish(frame(spark, "a1"), path, T)
    move = sink.Folder.move

    def fails_into_place(self, source, target):
        if "_staging" in source:
            raise OSError("no")
        move(self, source, target)

    monkeypatch.setattr(sink.Folder, "move", fails_into_place)
    with pytest.raises(OSError):
        sink.publish(frame(spark, "b1"), path, T)
    assert rows(spark, path) == [("a1", "a")]


def test_only_partitions_that_are_delivered_are_replaced(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    sink.publish(frame(spark, "a1", "b1", "c1", "c2"), path, T)
    before = files(path)
    assert sink.publish_partitions(frame(spark, "b2", "b3", "d4"), path, T, allowed=["b", "d"]) == ["d=b", "d=d"]
    assert rows(spark, path) == [("a1", "a"), ("b2", "b"), ("b3", "b"), ("c1", "c"), ("c2", "c"), ("d4", "d")]
    after = files(path)
    kept = {n: t for n, t in before.items() if not n.startswith("d=b/")}
    assert kept.items() <= after.items() and not {n for n in before if n.startswith("d=b/")} & set(after)
    with pytest.raises(ValueError, match="not to be replaced: a"):
        sink.publish_partitions(frame(spark, "b9", "a9"), path, T, allowed=["b"])
    assert files(path) == after and os.listdir(tmp_dir) == ["t"]


def test_a_district_is_delivered_again(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    os.makedirs(src)
    good_files(src)
    run(spark, f"{src}/*.txt", ELECTION, out, expected=["01", "02"])
    before = files(f"{out}/bronze")
    write(src, "02", table_lines("02", "9") + table_lines("02", "10"))
    res = run(spark, f"{src}/2025 - 02*.txt", ELECTION, out, expected=["02"], reload=["02"])
    assert res.replaced == ["dist_codigo=02"]
    assert bronze_counts(spark, out) == {"2025 - 01 - RESULTADOS.txt": 8, "2025 - 02 - RESULTADOS.txt": 8}
    one = {n: t for n, t in before.items() if n.startswith("dist_codigo=1/")}
    assert one and one.items() <= files(f"{out}/bronze").items()
    mart = sink.read_table(spark, res.tables["resumen_mesa"], ELECTION.gold["resumen_mesa"])
    assert {r["id_mesa"] for r in mart.collect()} == {"010020000300004X", "01002NNNNN00005X", "020020000300009X", "020020000300010X"}


def test_a_reload_never_touches_other_districts(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    os.makedirs(src)
    good_files(src)
    run(spark, f"{src}/*.txt", ELECTION, out, expected=["01", "02"])
    before = files(f"{out}/bronze")
    write(src, "02", table_lines("02", "9") + table_lines("1", "10"))
    with pytest.raises(IngestError, match="not reloaded, bronze is unchanged: 1"):
        run(spark, f"{src}/2025 - 02*.txt", ELECTION, out, expected=["02"], reload=["02"])
    write(src, "02", ["too|short"])
    with pytest.raises(IngestError, match="bronze is unchanged"):
        run(spark, f"{src}/2025 - 02*.txt", ELECTION, out, expected=["02"], reload=["02"])
    assert files(f"{out}/bronze") == before
    with pytest.raises(ValueError):
        run(spark, f"{src}/*.txt", ELECTION, table_targets("tmreload_"), reload=["02"])
    with pytest.raises(ValueError):
        run(spark, f"{src}/*.txt", replace(ELECTION, bronze_partition=None), out, reload=["02"])


def test_every_table_is_written_once(spark, tmp_dir, monkeypatch):
    from pyspark.sql import DataFrameWriter

    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    os.makedirs(src)
    good_files(src)
    written = []
    for name in ("save", "parquet"):
        plain = getattr(DataFrameWriter, name)
        monkeypatch.setattr(DataFrameWriter, name, lambda self, path=None, *a, _plain=plain, **k: (written.append(path), _plain(self, path, *a, **k))[1])
    run(spark, f"{src}/*.txt", ELECTION, out, expected=["01", "02"])
    of = [p.rpartition("/")[2].removeprefix("_staging-").rpartition("-")[0] for p in written if p]
    assert of.count("bronze") == of.count("silver") == 1
    assert sorted(of) == sorted({"bronze", "silver", "ingest_report", "ingest_rejected", "quality_report", "quality_violations",
                                 "key_report", *ELECTION.gold})
    assert sorted(os.listdir(out)) == ["bronze", "gold", "reports", "silver"]


def test_an_unpartitioned_bronze(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    os.makedirs(src)
    good_files(src)
    write(src, "03", ["too|short"])
    run(spark, f"{src}/*.txt", replace(ELECTION, bronze_partition=None), out, enforce_sources=False)
    assert bronze_counts(spark, out) == {"2025 - 01 - RESULTADOS.txt": 8, "2025 - 02 - RESULTADOS.txt": 4}
