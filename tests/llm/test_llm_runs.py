import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest

from awkward import docs, empty, rows
from tallymart.llm import runs
from tallymart.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_lyndon(a):
    out = []
    for i in range(len(a)):
        j = i + 1
        while j < len(a) and a[j:] > a[i:]:
            j += 1
        out.append(j - i)
    return out


def brute_runs(a, min_length, min_exponent):
    n, out = len(a), []
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and a[i] == a[i + p]:
                i += 1
            length = i - start + p
            smaller = any(a[start : i + p - q] == a[start + q : i + p] for q in range(1, p))
            if i > start and length >= 2 * p and not smaller and length >= max(min_length, min_exponent * p):
                out.append((start, length, p))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def wanted(words):
    """What the contract asks of one document."""
    found = quick_runs(words)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    dropped = {i for s, n, p in found for i in range(s + p, s + n)}
    text = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    collapsed = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (len(found), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(collapsed.encode()).hexdigest())


def quick_runs(words):
    """Brute force over all periods, each by one comparison of arrays."""
    codes = {w: i for i, w in enumerate(dict.fromkeys(words))}
    a, n, out = np.array([codes[w] for w in words], int), len(words), {}
    for p in range(1, n // 4 + 1):
        same = np.concatenate([[0], a[p:] == a[:-p], [0]]).astype(int)
        edges = np.flatnonzero(np.diff(same))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = end - start + p
            if length >= max(6, 4 * p):
                out.setdefault((start, length), p)  # the smallest period comes first
    return sorted(((s, n, p) for (s, n), p in out.items()), key=lambda r: (r[0], r[2]))


def test_lyndon_arrays_and_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(1500):
        letters, n = rng.choice([1, 2, 3, 5]), rng.randint(0, 30)
        a = [rng.randrange(letters) for _ in range(n)]
        if n and rng.random() < 0.5:
            a = (a[: rng.randint(1, n)] * n)[: n + 5]
        ranks = {x: i for i, x in enumerate(sorted(set(a)))}
        a = [ranks[x] for x in a]
        assert runs.lyndon_array(a) == brute_lyndon(a)
        assert runs.lyndon_array(a, reverse=True) == brute_lyndon([-x for x in a])
        for least in ((2, 2), (6, 3), (6, 4)):
            assert runs.find_runs(np.array(a), *least) == brute_runs(a, *least)


@pytest.mark.parametrize("a", [[0] * 50_000, list(range(50_000)), list(range(50_000, 0, -1)), [0, 1] * 30_000, [0, 0, 1] * 9_000 + [1] * 9_000])
def test_long_regular_texts(a):
    found = runs.find_runs(np.array(a))
    words = [str(x) for x in a]
    if len(set(a)) < 4:
        assert found == [r for r in [(0, 50_000, 1), (0, 60_000, 2), (0, 27_000, 3), (26_999, 9_001, 1)]
                         if r in found] and found
        assert all(words[s + p : s + n] == words[s : s + n - p] for s, n, p in found)
    else:
        assert found == []


def test_awkward_documents(spark):
    got = runs.text_runs(docs(spark)).collect()
    assert len(got) == len(rows())
    for r in got:
        words = WORD.findall(r["text"] or "")
        assert [tuple(x) for x in r["runs"]] == quick_runs(words)
        dropped = {i for s, n, p in quick_runs(words) for i in range(s + p, s + n)}
        assert r["kept"] == [w for i, w in enumerate(words) if i not in dropped]
        assert (r["size"], r["row"]) != (None, 1)
    assert runs.text_runs(empty(spark)).collect() == []


def test_names_that_are_taken_and_null_items(spark):
    frame = spark.createDataFrame([(1, ["a", None] * 4), (2, None), (3, [])], "runs long, kept array<string>")
    out = runs.runs_of_words(frame, frame["kept"])
    assert out.columns == ["runs", "kept", "runs_", "kept_"]
    got = {r["runs"]: ([tuple(x) for x in r["runs_"]], r["kept_"]) for r in out.collect()}
    assert got == {1: ([(0, 8, 2)], ["a", None]), 2: ([], []), 3: ([], [])}


def test_least_exponent_is_two(spark):
    with pytest.raises(ValueError):
        runs.text_runs(empty(spark), min_exponent=1)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_op11_equals_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op11_runs"](spark, SF).collect()
    assert len(got) == len(texts) and sum(r["n_runs"] > 0 for r in got) > 10
    for r in got:
        assert tuple(r)[1:] == wanted(planted(WORD.findall(texts[r["doc_id"]] or ""), r["doc_id"]))
