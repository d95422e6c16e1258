"""Column functions: one test per edge note of the inventory."""

from pyspark.sql import functions as F

from tallymart.functions import clean_label, composite_id, joined_key, lookup, pad_code, path_key, row_kind, to_int
from tallymart.operators import blank_to_null, trim_sentinel


def one(spark, expr, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("out")).first()["out"]


def test_pad_code_keeps_last_chars_and_pads(spark):
    df = spark.createDataFrame([("7",), ("1234567",), ("12A",), ("",), (None,)], "c string")
    got = [r["p"] for r in df.select(pad_code("c", 5).alias("p")).collect()]
    assert got == ["00007", "34567", "0012A", "00000", None]


def test_truncation_collides_codes(spark):
    df = spark.createDataFrame([("1990",), ("0",)], "c string")
    assert [r["p"] for r in df.select(pad_code("c", 3).alias("p")).collect()] == ["990", "000"]


def test_composite_id_placeholders(spark):
    df = spark.createDataFrame([("01", "002", None, "00004")], "d string, s string, c string, m string")
    out = df.select(composite_id({"d": "NN", "s": "NNN", "c": "NNNNN", "m": "NNNNN"}, "X").alias("id")).first()["id"]
    assert out == "01002NNNNN00004X" and len(out) == 16


def test_composite_id_from_padded_parts(spark):
    df = spark.createDataFrame([("1", "2", "3", "4")], "d string, s string, c string, m string")
    padded = df.select(pad_code("d", 2).alias("d"), pad_code("s", 3).alias("s"), pad_code("c", 5).alias("c"),
                       pad_code("m", 5).alias("m"))
    out = padded.select(composite_id({"d": "NN", "s": "NNN", "c": "NNNNN", "m": "NNNNN"}).alias("id")).first()["id"]
    assert out == "010020000300004X"


def test_clean_label_ascii_drops_accents_and_punctuation(spark):
    df = spark.createDataFrame([("501", "UNIÓN - CÍVICA")], "n string, d string")
    assert df.select(clean_label("n", "d").alias("l")).first()["l"] == "501 UNIN CVICA"


def test_clean_label_unicode_keeps_accents(spark):
    df = spark.createDataFrame([("501", "UNIÓN - CÍVICA")], "n string, d string")
    assert df.select(clean_label("n", "d", unicode=True).alias("l")).first()["l"] == "501 UNIÓN CÍVICA"


def test_clean_label_skips_null_parts(spark):
    df = spark.createDataFrame([(None, "  LISTA   AZUL  ")], "n string, d string")
    assert df.select(clean_label("n", "d").alias("l")).first()["l"] == "LISTA AZUL"


def test_to_int_malformed_is_null(spark):
    df = spark.createDataFrame([("12",), (" 7 ",), ("1.5",), ("abc",), ("99999999999",), (None,), ("-5",)], "v string")
    got = [r["i"] for r in df.select(to_int("v").alias("i")).collect()]
    assert got == [12, 7, None, None, None, None, -5]


def test_to_int_default(spark):
    df = spark.createDataFrame([("abc",), ("3",)], "v string")
    assert [r["i"] for r in df.select(to_int("v", 0).alias("i")).collect()] == [0, 3]


def test_row_kind_null_is_no(spark):
    df = spark.createDataFrame([("994",), ("501",), (None,)], "c string")
    got = [r["k"] for r in df.select(row_kind("c", ["994", "000"]).alias("k")).collect()]
    assert got == ["MESA", "AGRUPACION", "AGRUPACION"]


def test_path_and_joined_keys_skip_nulls(spark):
    df = spark.createDataFrame([("01", None, "00003", "A-B")], "a string, b string, c string, d string")
    row = df.select(path_key("a", "b", "c").alias("p"), joined_key("a", "b", "d").alias("j")).first()
    assert row["p"] == "0100003" and row["j"] == "01-A-B"


def test_lookup_unknown_is_null(spark):
    df = spark.createDataFrame([("01",), ("99",)], "c string")
    got = [r["n"] for r in df.select(lookup("c", {"01": "CAPITAL_FEDERAL"}).alias("n")).collect()]
    assert got == ["CAPITAL_FEDERAL", None]


def test_trim_sentinel_spaces_only(spark):
    df = spark.createDataFrame([(" \\N ",), ("\ta\t",), ("\u00a0b ",), (" c ",)], "v string")
    got = [r["v"] for r in trim_sentinel(df).collect()]
    assert got == [None, "\ta\t", "\u00a0b", "c"]  # tab and NBSP survive


def test_trim_sentinel_leaves_non_strings(spark):
    df = spark.createDataFrame([(" x ", 1)], "s string, n int").withColumn("ts", F.current_timestamp())
    out = trim_sentinel(df)
    assert dict(out.dtypes) == {"s": "string", "n": "int", "ts": "timestamp"}


def test_blank_to_null_strings_only(spark):
    df = spark.createDataFrame([("", 0, "x")], "a string, n int, b string")
    row = blank_to_null(df).first()
    assert row["a"] is None and row["n"] == 0 and row["b"] == "x"


def test_trim_sentinel_unicode_option(spark):
    df = spark.createDataFrame([(" \tb  ",), (" \\N\t",)], "v string")
    got = [r["v"] for r in trim_sentinel(df, unicode=True).collect()]
    assert got == ["b", None]


def test_scale_conf_sizes_partitions():
    from tallymart.session import scale_conf

    conf = scale_conf(100 * 2**40, cores=8000)  # 100 TB on 1000 x 8 cores
    assert int(conf["spark.sql.shuffle.partitions"]) == 20000
    assert scale_conf(10 * 2**20, cores=8)["spark.sql.shuffle.partitions"] == "16"
