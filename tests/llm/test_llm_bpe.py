import base64
import random

import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F

from awkward import docs, empty, rows
from tallymart.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
ORACLE = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def ids(model, text):
    return list(memoryview(model.encode(text)).cast("I"))


def test_random_texts_equal_the_library():
    model, rng = bpe.Bpe(RANKS, P.PATTERN), random.Random(1)
    parts = ["a", "ab", " ", "  ", "\n", "\t", "\r\n", "\x1c", "\x85", "\xa0", "'s", "'ll", "12", "é", "!", "日本", "😀", "the", "tion"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 3, 8, 40])))
        got = ids(model, text)
        assert got == ORACLE.encode_ordinary(text)
        assert model.decode(got) == text.encode()


def test_seams_of_long_pieces():
    model, rng = bpe.Bpe(RANKS, P.PATTERN, leaf=4), random.Random(2)
    for alphabet in ("a", "ab", "etaoin", "theinger", "éàü", "日本語"):
        for n in (5, 9, 33, 100, 700):
            text = "".join(rng.choice(alphabet) for _ in range(n))
            assert ids(model, text) == ORACLE.encode_ordinary(text)


def test_joining_is_associative_with_a_unit():
    model, rng = bpe.Bpe(RANKS, P.PATTERN, leaf=4), random.Random(3)
    for _ in range(200):
        a, b, c = ("".join(rng.choice("abcdetin") for _ in range(rng.randint(0, 30))).encode() for _ in range(3))
        x, y, z = map(model.tree, (a, b, c))
        assert model.joined(model.joined(x, y), z) == model.joined(x, model.joined(y, z)) == model.merged(a + b + c)
        assert model.joined([], x) == x == model.joined(x, [])


def test_all_merge_loops_agree():
    model, rng = bpe.Bpe(RANKS, P.PATTERN), random.Random(4)
    for _ in range(300):
        data = "".join(rng.choice("aabcdeé ") for _ in range(rng.randint(1, 60))).encode()
        assert model._merged_short(data) == model._merged_long(data)
    data = ["".join(rng.choice("aabcdeé therion日") for _ in range(rng.randint(1, 9))).encode() for _ in range(2000)]
    assert [list(memoryview(x).cast("I")) for x in model.leaves(data)] == [model._merged_short(d) for d in data]


def test_very_long_piece():
    model = bpe.Bpe(RANKS, P.PATTERN)
    text = "ab" * 20_000
    assert ids(model, text) == ORACLE.encode_ordinary(text)


def test_tables_start_afresh(monkeypatch):
    monkeypatch.setattr(bpe, "UNIT_BYTES", 20_000)
    monkeypatch.setattr(bpe, "PIECE_BYTES", 10_000)
    model = bpe.Bpe(RANKS, P.PATTERN)
    for i in range(40):
        text = " ".join(f"w{i}x{j}" for j in range(20))
        assert ids(model, text) == ORACLE.encode_ordinary(text)
        assert len(model.table.young) <= 50


def test_awkward_rows_round_trip(spark):
    frame = docs(spark).withColumn("ids", F.lit(1)).withColumn("n_tokens", F.lit(2))
    out = bpe.encode(frame, PATH, P.PATTERN)
    assert out.columns == [*frame.columns, "n_tokens_", "ids_"]
    got = out.select("text", "n_tokens_", bpe.unpacked(F.col("ids_")).alias("list"), bpe.decoded(F.col("ids_"), PATH, P.PATTERN).alias("back")).collect()
    assert len(got) == len(rows())
    for r in got:
        assert r["list"] == ORACLE.encode_ordinary(r["text"] or "") and r["n_tokens_"] == len(r["list"])
        assert bytes(r["back"]) == (r["text"] or "").encode()


def test_decoded_rows(spark):
    frame = docs(spark).withColumn("ids", F.lit(1)).withColumn("decoded", F.lit(2))
    out = bpe.encode_decoded(frame, PATH, P.PATTERN)
    assert out.columns == [*frame.columns, "n_tokens", "ids_", "decoded_"]
    got = out.select("text", "n_tokens", bpe.unpacked(F.col("ids_")).alias("list"), "decoded_").collect()
    assert len(got) == len(rows())
    for r in got:
        assert r["list"] == ORACLE.encode_ordinary(r["text"] or "") and r["n_tokens"] == len(r["list"])
        assert bytes(r["decoded_"]) == (r["text"] or "").encode()
    assert bpe.encode_decoded(empty(spark), PATH, P.PATTERN).collect() == []


def test_the_query_encodes_a_text_once(spark, tmp_path):
    from tallymart.llm.queries import op8_bpe

    docs(spark).drop("id").write.parquet(str(tmp_path / "documents.parquet"))
    plan = op8_bpe(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    # Of one Python step, no function inside another or beside it.
    assert plan.count("run(") == 1, plan


def test_checked_rows(spark):
    frame = docs(spark).withColumn("ids", F.lit(1))
    out = bpe.encode_checked(frame, PATH, P.PATTERN)
    assert out.columns == [*frame.columns, "n_tokens", "ids_", "round_trip"]
    got = out.collect()
    assert len(got) == len(rows()) and all(r["round_trip"] for r in got)
    assert all(r["ids_"] == ORACLE.encode_ordinary(r["text"] or "") and r["n_tokens"] == len(r["ids_"]) for r in got)
    assert bpe.encode_checked(empty(spark), PATH, P.PATTERN).collect() == []


def test_a_memory_is_bounded_in_bytes():
    memo = bpe.Memo(lambda keys: [k.encode() for k in keys], 100_000)
    for i in range(200):
        keys = {f"k{i}-{j}" for j in range(20)} | {"x" * 5_000 + str(i), "often"}
        found = memo.having(keys)
        assert all(found[k] == k.encode() for k in keys)
        held = sum(2 * len(k) + bpe.OVERHEAD for d in (memo.young, memo.old) for k in d)
        assert held <= 2 * 100_000


def test_empty_table(spark):
    assert bpe.encode(empty(spark), PATH, P.PATTERN).collect() == []
