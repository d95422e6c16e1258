import string
import tempfile
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from awkward import docs, empty, rows
from tallymart.llm import tokenfile

PATH = P.path("word_bpe_49k.json")


def check(ids):
    x = np.array(ids, np.uint64)
    words, blocks = tokenfile.pack(x)
    assert (tokenfile.unpack(words) == x).all() and len(tokenfile.unpack(words)) == len(x)
    assert len(blocks) == -(-len(x) // tokenfile.BLOCK)
    for i, a in enumerate(blocks):
        b = blocks[i + 1] if i + 1 < len(blocks) else len(words)
        part = x[i * tokenfile.BLOCK : (i + 1) * tokenfile.BLOCK]
        assert (tokenfile.unpack(words[a:b]) == part).all()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.just(0), st.integers(0, 1), st.integers(0, 70_000), st.integers(0, 2**64 - 1)), max_size=300))
def test_any_ids_round_trip(ids):
    check(ids)


def test_runs_escapes_and_block_edges():
    rng = np.random.default_rng(0)
    for x in (np.zeros(5000), np.ones(3000), np.arange(4096), np.full(1025, 2.0**60)):
        check(x.astype(np.uint64))
    check(rng.integers(0, 2**64, 3000, dtype=np.uint64) >> rng.integers(0, 64, 3000).astype(np.uint64))


def test_packing_is_dense():
    words, _ = tokenfile.pack(np.arange(1024, dtype=np.uint64) % 4096)
    assert len(words) <= 1024 // 5 + 5


@pytest.fixture(scope="module")
def oracle():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def test_lookup_equals_the_library(oracle, monkeypatch):
    monkeypatch.setattr(tokenfile, "TABLE_BYTES", 8_000)
    lookup, rng = tokenfile.Lookup(PATH), np.random.default_rng(1)
    parts = ["a", "B", " ", "\n", "\x1c", "\x85", "　", "'s", "12", "É", "é", "́", "!", "日", "😀", "\x01", "<|endoftext|>", "<|EndOfText|>", "<|", "Σ", "İ", "ß", "the"]
    for _ in range(1500):
        text = "".join(rng.choice(parts, rng.integers(0, 12)))
        (packed,) = lookup.encode([text.encode()])
        assert np.frombuffer(packed, "<u4").tolist() + [2] == oracle(text)


def test_marks_behind_letters_are_learnt_apart(oracle):
    lookup, rng, asked = tokenfile.Lookup(PATH), np.random.default_rng(2), []
    marks, stems = [*string.punctuation], ["a", "it", "Zuber", "cióng", "ªµß", "re", "s", "日", "e\u0301", "12", "x1", ""]
    words = [str(rng.choice(stems)) + "".join(rng.choice(marks, rng.integers(0, 5))) for _ in range(3000)]
    for text in (" ".join(words), *(" ".join(words[a : a + 7]) for a in range(0, 3000, 7))):
        (packed,) = lookup.encode([text.encode()])
        assert np.frombuffer(packed, "<u4").tolist() + [2] == oracle(text)
    fresh = tokenfile.Lookup(PATH)
    plain = fresh._ids
    fresh._ids = lambda text: asked.append(text) or plain(text)
    (packed,) = fresh.encode(["zuber### osarie*** cióng&&& state, (x) ###".encode()])
    assert np.frombuffer(packed, "<u4").tolist() + [2] == oracle("zuber### osarie*** cióng&&& state, (x) ###")
    # Letters go to the library's model; only marks and mixed strings take the long way.
    assert sorted(set(" ".join(asked).split()) - {tokenfile.MARK}) == ["###", "&&&", "(x)", "***", ","]


def test_memory_holds_letters_and_marks_once(oracle):
    lookup = tokenfile.Lookup(PATH)
    texts = ["zuber zuber, Zuber. ZUBER!", " zuber!,\x0b", "", " \t", "(zuber)", "12, 12", "\x1czuber.\xa0zuber,"]
    for text, packed in zip(texts, lookup.encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() + [2] == oracle(text)
    held = {"", "zuber", ",", ".", "!", "!,", "(zuber)", "12,", "12", "\x1czuber.\xa0zuber,"}
    assert set(lookup.table.young) == {w.encode() for w in held}


def test_rows_of_any_text_column(oracle):
    lookup = tokenfile.Lookup(PATH)
    for kind in (pa.string(), pa.large_string()):
        for texts in ([], [None], [""], ["  "], [None, "A b", "", "x<|endoftext|>Y.", None, "é,\né ", "<|EndOfText|> Q"]):
            for column in (pa.array(texts, kind), pa.array(["cut off, É", *texts, "cut"], kind).slice(1, len(texts))):
                ids, sizes = lookup.rows(column)
                assert sizes.tolist() == [len(oracle(t)) - 1 for t in texts]
                assert ids.tolist() == [i for t in texts for i in oracle(t)[:-1]]


def test_chunks_do_not_depend_on_slices(oracle, monkeypatch):
    task = type("Task", (), {"get": classmethod(lambda c: c), "partitionId": staticmethod(lambda: 7)})
    monkeypatch.setattr(tokenfile, "TaskContext", task)
    monkeypatch.setattr(tokenfile, "CHUNK", 50)
    rng, found = np.random.default_rng(3), []
    texts = [None if n == 3 else " ".join(rng.choice(["the", "Zuber,", "é!", "\n", "12"], n)) for n in rng.integers(0, 90, 120)]
    for size in (1, 64, 1000, 1 << 20):
        monkeypatch.setattr(tokenfile, "_SLICE", size)
        for rows_in in (120, 17):
            table = pa.table({"id": pa.array(range(120), pa.int64()), "text": pa.array(texts, pa.string())})
            found.append([b.to_pydict() for b in tokenfile._encode(PATH, 2, pa.int64())(iter(table.to_batches(rows_in)))])
    assert all(x == found[0] for x in found)
    first = 0
    for i, c in enumerate(found[0]):
        ids = [j for d in c["docs"][0] for j in oracle(texts[d])]
        assert tokenfile.unpack(np.frombuffer(c["words"][0], "<u8")).tolist() == ids
        assert (c["part"], c["chunk"], c["first"], c["n_ids"]) == ([7], [i], [first], [len(ids)])
        assert c["lengths"][0] == [len(oracle(texts[d])) for d in c["docs"][0]]
        assert i + 1 == len(found[0]) or len(ids) - c["lengths"][0][-1] < 50 <= len(ids)  # closed as soon as full
        first += len(ids)
    assert [d for c in found[0] for d in c["docs"][0]] == list(range(120))


def expected(oracle, table):
    out, start = [], 0
    for doc, text in sorted(table, key=lambda r: (r[0] is None, r[0] or 0)):
        ids = np.array(oracle(text), "<u4")
        out.append((doc, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out, start


def test_files_hold_every_row_in_order(spark, oracle, monkeypatch):
    target = tempfile.mkdtemp(prefix="tallymart-tokens-") + "/files"
    frame = docs(spark).drop("id")
    tokenfile.write_tokens(frame, target, PATH, 2)
    got = tokenfile.read_tokens(spark, target).select("id", "start", "n_tokens", F.crc32("ids").alias("crc"), tokenfile.ids_of(F.col("ids")).alias("list")).collect()
    want, total = expected(oracle, [(r[0], r[1]) for r in rows()])
    assert sorted((str(r["id"]), r["n_tokens"], r["crc"]) for r in got) == sorted((str(a), b, c) for a, b, c in want)
    got.sort(key=lambda r: r["start"])
    assert [r["id"] for r in got] == [w[0] for w in want]
    at = 0
    for r in got:
        assert r["start"] == at and len(r["list"]) == r["n_tokens"]
        at += r["n_tokens"]
    assert at == total


def test_empty_table(spark):
    target = tempfile.mkdtemp(prefix="tallymart-tokens-") + "/files"
    tokenfile.write_tokens(empty(spark).drop("id"), target, PATH, 2)
    assert tokenfile.read_tokens(spark, target).collect() == []
