import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from awkward import docs, empty, rows
from tallymart.llm import secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def entropy(text):
    out = []
    for m in re.finditer("[A-Za-z0-9+/_-]{24,}", text):
        value = m[0]
        if any(re.search(a, value) for a in secrets.ALLOW):
            continue
        kind = next((k for k in secrets.CLASSES if re.search(k.pattern, value)), None)
        if kind is None:
            continue
        hot = []
        for i in range(len(value) - kind.window + 1):
            w = value[i : i + kind.window]
            h = -sum(w.count(c) / len(w) * math.log2(w.count(c) / len(w)) for c in set(w))
            if h >= kind.bits - 1e-9:
                hot.append(i)
        if hot:
            out.append((m.start() + hot[0], 3, m.start() + hot[-1] + kind.window))
    known = base(text)
    return [x for x in out if not any(a <= x[0] and x[2] <= b for a, _, b in known)]


def found(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = secrets.find_secrets(frame).select("row.*", "base", "spans").collect()
    tuples = lambda s: [(x["start"], x["order"], x["end"]) for x in s]
    return {r["doc_id"]: (tuples(r["base"]), tuples(r["spans"])) for r in out}


TEXTS = [
    None, "", "no secret", "😀 password: 'abcdefghijkl' x", "TOKEN:secret: abcdefghijkl secret=abcdefghijklmnop",
    "passwordpassword=aaaaaaaaaaaa", "AKIAAKIA12345678901 AKIA123 AKIAABCDEFGHIJKLMN", "é" * 30 + "deadbeefdeadbeef" * 3,
    "deadbeefdeadbee g 0123456789abcdef", "apikey=abc.def=ghi/jkl+mno api_key = 'x' API_KEY:short",
    "zq aZ3kLm9QwE7rTy2UiOp5AsDf8GhJk1 b aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1", "550e8400-e29b-41d4-a716-446655440000",
    "EXAMPLEaZ3kLm9QwE7rTy2UiOp5AsDf8GhJk1 0A1B2C3D4E5F60718293A4B5C6D7E8F9", "secret=" + "k3" * 200,
    " ".join(f"password=abcdefghijklm{i}" for i in range(700)), "https://a.b/some/long-path-of-words-in-2020/and_more_of_it",
]


def test_spans_equal_brute_force(spark):
    got = found(spark, TEXTS)
    for i, t in enumerate(TEXTS):
        assert got[i][0] == base(t or ""), t
        assert got[i][1] == sorted(base(t or "") + entropy(t or "")), t
    assert any(x[1] == 3 for _, spans in got.values() for x in spans)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(
    ["password", "token=", "secret", ":", "=", " ", "'", '"', "AKIA", "ABCD1234", "deadbeef", "09af", "é", "😀", "aZ9kQ2xL", "_", "api_key", "\n", "x.y"]
), max_size=25).map("".join), min_size=30, max_size=30))
def test_random_texts(spark, texts):
    got = found(spark, texts)
    for i, t in enumerate(texts):
        assert got[i] == (base(t), sorted(base(t) + entropy(t))), t


def test_digest_strings_and_order(spark):
    frame = spark.createDataFrame([("password=deadbeefdeadbeef",)], "t string")
    r = frame.select(secrets.spelled(secrets.scan(F.col("t"))["spans"]).alias("s")).first()
    assert r["s"] == "assign:0:25,hex:9:25"


def test_redaction_masks_all_and_nothing_else(spark):
    frame = docs(spark)
    out = secrets.redact(frame, length_col="n_chars")
    assert out.columns == frame.columns and out.dtypes == frame.dtypes
    got = out.collect()
    assert len(got) == len(rows())
    want = []
    for r in rows():
        t = r[1]
        if t is not None:
            spans, merged = sorted(base(t) + entropy(t)), []
            for a, _, b in spans:
                if merged and a < merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            for a, b in reversed(merged):
                t = t[:a] + "[SECRET]" + t[b:]
        want.append((r[0], t, None if t is None else len(t)))
    key = lambda x: str(x)
    assert sorted(((r["doc_id"], r["text"], r["n_chars"]) for r in got), key=key) == sorted(want, key=key)


def test_empty_table_and_native_plan(spark):
    assert secrets.redact(empty(spark)).collect() == []
    plan = secrets.redact(docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_keys_beside_separators_or_example_words(spark):
    key, hexes = "3ax6xnjp29jd6fds4gc373sgvjxteol0", "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"
    keys = [(p, k) for p in ("", "key-", "/v1/hook/", "ID-", "Key_", "docs/example/") for k in (key, key.upper(), hexes)]
    keys += [("", "9A7B3-QK4ZP-X81MD-T6WHC-5RJVE"), ("", "qwJkXvZpLmNbRtYsDfGhKcAoEiUx")]
    plain = ["some/long/path_of_words-in/the-repository", "SOME_LONG_CONSTANT_OF_WORDS_2020", "InternationalizationServiceFactoryBean"]
    got = found(spark, [f"see {p}{k} there" for p, k in keys] + plain)
    for i, (p, k) in enumerate(keys):
        spans = [x for x in got[i][1] if x[1] == 3]
        at = 4 + len(p)
        assert sum(max(0, min(b, at + len(k)) - max(a, at)) for a, _, b in spans) >= 24, (p, k)
    assert all(got[len(keys) + i][1] == [] for i in range(len(plain)))
