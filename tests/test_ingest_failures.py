"""Sources that fail: every path and every line is accounted for."""

import gzip
import math
import os
from dataclasses import replace

import pytest
from pyspark.errors import PySparkException

from tallymart.plans.elections import ELECTION
from tallymart.plans.medallion import IngestError, run
from tallymart.sources.delimited import ingest_report, read_delimited, rejected_lines, unreadable
from tallymart.sources.sink import read_table
from tallymart.spec import SourceSpec, text_schema
from test_medallion import bronze_counts, good_files, line, table_lines, write

GZ = replace(ELECTION, source=replace(ELECTION.source, source_pattern=r"2025 - (\d{2}) - [^/]*$"))


@pytest.mark.parametrize("bad", [[0], [63], [5, 6], [0, 17, 40], list(range(64))])
def test_bad_files_are_found_by_halving(bad):
    scanned = []

    def scan(files):
        scanned.append(files)
        if any(int(f) in bad for f in files):
            raise PySparkException("Caused by: outer\nCaused by: broken\nno")

    found = unreadable([str(i) for i in range(64)], scan)
    assert found == [(str(i), "broken") for i in bad]
    if len(bad) < 64:
        assert len(scanned) <= 1 + 2 * len(bad) * math.ceil(math.log2(64))
    # a failure that is known already is not looked for again
    before = len(scanned)
    unreadable([str(i) for i in range(64)], scan, PySparkException("known"))
    assert len(scanned) - before < before


def test_an_error_of_no_file_is_no_finding():
    assert unreadable(["a", "b"], lambda files: None) == []


def test_a_lost_part_file_fails_its_source(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    os.makedirs(src)
    good_files(src)
    parts = [f"{src}/2025 - 01 - RESULTADOS.txt", f"{src}/2025 - 02 - RESULTADOS.txt", f"{src}/2025 - 01 - PARTE 2.txt"]
    with pytest.raises(IngestError, match="01: INCOMPLETE"):
        run(spark, parts, GZ, out, expected=["01", "02"])
    assert bronze_counts(spark, out) == {"2025 - 02 - RESULTADOS.txt": 4}
    report = {r["source"]: r for r in read_table(spark, f"{out}/reports/ingest_report").collect()}
    assert (report["01"]["rows"], report["01"]["status"]) == (8, "INCOMPLETE")
    assert report["01"]["error"].endswith("PARTE 2.txt: no such path") and report["02"]["error"] is None
    held = read_table(spark, f"{out}/reports/ingest_rejected").collect()
    assert {(r["source"], r["reason"]) for r in held} == {("01", "SOURCE_INCOMPLETE")} and len(held) == 8


def test_a_cut_file_fails_its_source_only(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    os.makedirs(src)
    good_files(src)
    packed = gzip.compress(("\n".join(table_lines("03", "1") * 50) + "\n").encode("iso-8859-1"))
    for name, data in (("A", packed), ("B", packed[: len(packed) // 2])):
        with open(f"{src}/2025 - 03 - {name}.txt.gz", "wb") as fh:
            fh.write(data)
    with pytest.raises(IngestError, match="03: UNREADABLE"):
        run(spark, f"{src}/*", GZ, out, expected=["01", "02", "03"])
    assert bronze_counts(spark, out) == {"2025 - 01 - RESULTADOS.txt": 8, "2025 - 02 - RESULTADOS.txt": 4}
    report = {r["source"]: r for r in read_table(spark, f"{out}/reports/ingest_report").collect()}
    assert report["03"]["status"] == "UNREADABLE" and "03 - B.txt.gz" in report["03"]["error"]
    assert "end of input" in report["03"]["error"]


def test_rejected_and_loaded_lines_are_all_lines(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    os.makedirs(src)
    good_files(src)
    short = table_lines("03", "1")
    short[1] = short[1].rsplit("|", 3)[0]
    long_ = [table_lines("04", "1")[0] + "|extra"]
    quoted = [line("05", "2", '"UNCLOSED', "3", "C", "1", "DN", "501", "L", "1", "2")]
    write(src, "03", short)
    write(src, "04", long_)
    write(src, "05", quoted)
    with open(f"{src}/LEEME.txt", "w") as fh:
        fh.write("not a tally\n")
    with pytest.raises(IngestError):
        run(spark, f"{src}/*.txt", ELECTION, out, expected=["01", "02", "03", "04", "05"])
    lines = {}
    for name in os.listdir(src):
        with open(f"{src}/{name}", encoding="iso-8859-1") as fh:
            lines[name] = sum(1 for x in fh if x.strip())
    got = bronze_counts(spark, out)
    rejected = read_table(spark, f"{out}/reports/ingest_rejected").collect()
    for r in rejected:
        name = r["file"].split("/")[-1]
        got[name] = got.get(name, 0) + 1
    assert got == lines
    reasons = {(r["source"], r["reason"]) for r in rejected}
    assert reasons == {("03", "TOO_FEW_FIELDS"), ("03", "SOURCE_MALFORMED"), ("04", "TOO_MANY_FIELDS"), ("05", "BAD_QUOTING"),
                       ("LEEME.txt", "TOO_FEW_FIELDS")}
    assert {r["line"] for r in rejected if r["reason"] == "TOO_FEW_FIELDS"} == {short[1], "not a tally"}


def test_a_clean_run_has_an_empty_table_of_rejected_lines(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    os.makedirs(src)
    good_files(src)
    write(src, "03", ["too|short"])
    run(spark, f"{src}/*.txt", ELECTION, out, enforce_sources=False)
    assert read_table(spark, f"{out}/reports/ingest_rejected").count() == 1
    write(src, "03", table_lines("03", "1"))
    res = run(spark, f"{src}/*.txt", ELECTION, out)
    assert res.ingest == [] and read_table(spark, f"{out}/reports/ingest_rejected").count() == 0


def test_held_back_lines_parse_to_their_fields(spark, tmp_dir):
    path = os.path.join(tmp_dir, "2025 - 01 - RESULTADOS.txt")
    with open(path, "wb") as fh:
        fh.write('01|"LISTA A|B"|7\n01||x\n01|short\n'.encode("iso-8859-1"))
    spec = SourceSpec(schema=text_schema(["d", "name", "n"]), source_pattern=r"2025 - (\d{2}) - RESULTADOS\.txt$")
    raw = read_delimited(spark, path, spec)
    raw.write.parquet(f"{tmp_dir}/staged")
    staged = spark.read.parquet(f"{tmp_dir}/staged")
    rejected = rejected_lines(staged, ingest_report(staged, ["01"]), spec)
    held = [r["line"] for r in rejected.filter("reason = 'SOURCE_MALFORMED'").collect()]
    again = spark.read.schema("d string, name string, n string").options(sep="|").csv(spark.sparkContext.parallelize(held))
    assert sorted(map(tuple, again.collect()), key=repr) == [("01", "LISTA A|B", "7"), ("01", None, "x")]


def test_rows_in_another_district_s_file_are_misplaced(spark, tmp_dir):
    src, out = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "out")
    os.makedirs(src)
    good_files(src)
    write(src, "02", table_lines("02", "7") + table_lines("01", "8"))
    strict = replace(ELECTION, source=replace(ELECTION.source, placement="lpad(dist_codigo, 2, '0') = _source"))
    with pytest.raises(IngestError, match="02: MISPLACED"):
        run(spark, f"{src}/*.txt", strict, out, expected=["01", "02"])
    assert bronze_counts(spark, out) == {"2025 - 01 - RESULTADOS.txt": 8}
    report = {r["source"]: r["misplaced_rows"] for r in read_table(spark, f"{out}/reports/ingest_report").collect()}
    assert report == {"01": 0, "02": 4}
