"""Property tests: the column functions against plain-Python definitions of
the same rules, on generated strings (one Spark job per example batch)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallymart.functions import clean_label, pad_code, to_int

TEXT = st.text(
    alphabet=st.sampled_from(list("abcXYZ019 _-.,;:!?#ºÓóñÑ\t  é€😀")), max_size=24
)
CODES = st.one_of(st.none(), st.text(alphabet=st.sampled_from(list("0123456789AB ")), max_size=9))
NUMS = st.text(alphabet=st.sampled_from(list("0123456789+-. eE")), max_size=12)

FAST = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def py_pad(s, n):
    return None if s is None else s[-n:].rjust(n, "0")


def py_label(*parts):
    text = " ".join(p for p in parts if p is not None)
    text = re.sub(r"[^\w\s]", "", text, flags=re.ASCII)
    text = re.sub(r"\s{2,}", " ", text, flags=re.ASCII)
    return text.strip(" ")


def py_int(s):
    if s is None:
        return None
    t = s.strip(" ")
    if not re.fullmatch(r"[+-]?[0-9]+", t):
        return None
    v = int(t)
    return v if -(2**31) <= v < 2**31 else None


@FAST
@given(st.lists(CODES, min_size=1, max_size=40), st.integers(min_value=1, max_value=6))
def test_pad_code_matches_definition(spark, values, width):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r["p"] for r in df.select("i", pad_code("v", width).alias("p")).orderBy("i").collect()]
    assert got == [py_pad(v, width) for v in values]


@FAST
@given(st.lists(st.tuples(st.one_of(st.none(), TEXT), st.one_of(st.none(), TEXT)), min_size=1, max_size=40))
def test_clean_label_matches_definition(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    got = [r["l"] for r in df.select("i", clean_label("a", "b").alias("l")).orderBy("i").collect()]
    assert got == [py_label(a, b) for a, b in pairs]


@FAST
@given(st.lists(st.one_of(st.none(), NUMS, st.integers(-(2**33), 2**33).map(str)), min_size=1, max_size=40))
def test_to_int_matches_definition(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = [r["n"] for r in df.select("i", to_int("v").alias("n")).orderBy("i").collect()]
    assert got == [py_int(v) for v in values]


ROW = st.tuples(
    st.sampled_from(["1", "2", "3"]),                    # mesa
    st.sampled_from(["DN", "SN", "\\N"]),                 # category (NULL via sentinel)
    st.sampled_from(["501", "502", "990", "992", "994"]),  # code
    st.sampled_from(["CENTRO", "NORTE", ""]),             # circuit description (blank -> NULL)
    st.one_of(st.integers(-3, 30).map(str), st.just("x")),  # count (malformed -> NULL)
)


@FAST
@given(st.lists(ROW, min_size=1, max_size=30))
def test_onepass_mart_equals_joined_mart(spark, rows):
    from helpers import bronze, row
    from tallymart.operators import summary, summary_onepass
    from tallymart.plans.elections import ELECTION
    from tallymart.plans.medallion import clean_bronze, silver

    raw = [row(mesa=m, cat=c, code=k, circ_d=d, cant=n) for m, c, k, d, n in rows]
    s = silver(clean_bronze(bronze(spark, raw), ELECTION), ELECTION)
    a = sorted((tuple(r) for r in summary(s, ELECTION.summary).collect()), key=repr)
    b = sorted((tuple(r) for r in summary_onepass(s, ELECTION.summary).collect()), key=repr)
    assert a == b


SECTION = st.sampled_from(["CAPITAL", "RESIDENTES EXTERIOR", "PRIV LIBERTAD", "\\N", "PLAZA ARGENTINA PRIV"])


@FAST
@given(st.lists(st.tuples(st.sampled_from(["1", "2", "3", "4"]), SECTION, ROW), min_size=1, max_size=30))
def test_classification_and_expansion_forms_agree(spark, rows):
    from helpers import bronze, row
    from tallymart.operators import entity_class, expand_measure, expand_measure_union
    from tallymart.plans.elections import ELECTION
    from tallymart.plans.medallion import clean_bronze, normalize

    raw = [row(mesa=m, secc_d=sd, cat=c, code=k, circ_d=d, cant=n) for m, sd, (_, c, k, d, n) in rows]
    norm = normalize(clean_bronze(bronze(spark, raw), ELECTION), ELECTION)

    def rows_of(df):
        return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)

    by_join = entity_class(norm, ELECTION.classes, method="join")
    assert rows_of(by_join) == rows_of(entity_class(norm, ELECTION.classes, method="window"))
    assert rows_of(expand_measure(by_join, ELECTION.measure_row)) == rows_of(
        expand_measure_union(by_join, ELECTION.measure_row)
    )


KEYS = st.one_of(st.none(), st.integers(0, 6))


@FAST
@given(st.lists(st.tuples(KEYS, KEYS), min_size=1, max_size=40), st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=8))
def test_key_checks_match_brute_force(spark, child_rows, parent_keys):
    from collections import Counter

    from tallymart.operators import fk_orphans, pk_duplicates

    child = spark.createDataFrame(child_rows, "a int, b int")
    parent = spark.createDataFrame([(k,) for k in parent_keys], "p int")
    dup = {(r["a"], r["b"]): r["n"] for r in pk_duplicates(child, ["a", "b"]).collect()}
    assert dup == {k: n for k, n in Counter(child_rows).items() if n > 1}
    orphans = {r["a"]: r["n"] for r in fk_orphans(child, ["a"], parent, ["p"]).collect()}
    present = {k for k in parent_keys if k is not None}
    want = Counter(a for a, _ in child_rows if a is not None and a not in present)
    assert orphans == dict(want)
