import collections
import math
import random

import numpy as np
from pyspark.sql import functions as F

from awkward import docs, empty, rows
from tallymart.llm import gru, lm


def test_a_later_piece_starts_from_the_state_before_it(monkeypatch):
    monkeypatch.setattr(gru, "PIECE", 100)
    rng = np.random.default_rng(4)
    p = {k: (0.4 * rng.standard_normal(s)).astype(np.float32) for k, s in gru.SHAPES.items()}
    text = np.append(rng.integers(1, gru.START, 250), gru.END).astype(np.int32)
    # The state that reading the whole text would have there, or nearly so.
    whole = gru.states_after(p, np.concatenate([[gru.START], text[:99]])[None, :])
    warm = gru.states_after(p, text[99 - gru.WARM : 99][None, :])
    assert np.abs(whole - warm).max() < 0.05
    seen = []
    plain = gru.gradients

    def watched(p, x, target, valid, h, given=None):
        seen.extend((given or {}).items())
        return plain(p, x, target, valid, h, given)

    monkeypatch.setattr(gru, "gradients", watched)
    trainer = gru.Trainer(p, 0.0)
    mean = trainer.learn([text, text[:40], np.empty(0, np.int32)])
    assert sum(len(lanes) for _, (lanes, _) in seen) == 2 and trainer.tokens == 291
    states = np.concatenate([states for _, (_, states) in seen])
    assert np.abs(states - warm).max(axis=1).min() < 1e-6
    exact = gru.score(p, [text, text[:40]]).sum()
    assert abs(mean * 291 - exact) < 0.02 * abs(exact)
    assert gru.Trainer(p, 0.1).learn([]) == 0.0


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    p = {k: 0.3 * rng.standard_normal(s) for k, s in gru.SHAPES.items()}
    x, target = rng.integers(0, gru.START + 1, (5, 3)), rng.integers(0, gru.START, (5, 3))
    valid, h = rng.random((5, 3)) < 0.8, rng.standard_normal((3, gru.HIDDEN))
    _, grad, _ = gru.gradients(p, x, target, valid, h)
    for k in gru.SHAPES:
        for flat in np.argsort(-abs(grad[k]).ravel())[:3]:
            at = np.unravel_index(flat, grad[k].shape)
            ends = []
            for e in (1e-5, -1e-5):
                q = {a: b.copy() for a, b in p.items()}
                q[k][at] += e
                ends.append(gru.gradients(q, x, target, valid, h)[0])
            slope = -(ends[0] - ends[1]) / 2e-5 / valid.sum()
            assert math.isclose(grad[k][at], slope, rel_tol=1e-4, abs_tol=1e-7)


def test_targets_are_ordered_by_class():
    codes = np.random.default_rng(6).integers(-1, gru.START, 700)
    short, classes = gru._by_class(codes)
    assert sorted(short) == np.flatnonzero((codes >= 0) & (codes < gru.SHORTLIST)).tolist()
    assert [at.start for _, at, _ in classes] == [0, *(at.stop for _, at, _ in classes[:-1])] and classes[-1][1].stop == len(short)
    for k, at, place in classes:
        assert (codes[short[at]] == k * gru.WIDTH + place).all() and (np.diff(place) >= 0).all()
    none, empty_classes = gru._by_class(np.full(5, -1))
    assert len(none) == 0 and empty_classes == []


def slow_score(p, codes):
    """One text, one token at a time, in plain formulas."""
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    h, x, total, n = np.zeros(gru.HIDDEN), gru.START, 0.0, gru.HIDDEN
    for c in codes:
        g, u = p["gates"][x].astype(float), h @ p["state"]
        z, r = sigmoid(g[:n] + u[:n]), sigmoid(g[n : 2 * n] + u[n : 2 * n])
        new = np.tanh(g[2 * n :] + r * u[2 * n :])
        h = (1 - z) * new + z * h
        logits = h @ p["class_w"] + p["class_b"]
        k = c // gru.WIDTH if c < gru.SHORTLIST else gru.SHORTLIST // gru.WIDTH + c - gru.SHORTLIST
        total += logits[k] - np.log(np.exp(logits).sum())
        if c < gru.SHORTLIST:
            words = slice(k * gru.WIDTH, (k + 1) * gru.WIDTH)
            inner = p["word_w"][words] @ h + p["word_b"][words]
            total += inner[c % gru.WIDTH] - np.log(np.exp(inner).sum())
        x = c
    return total


def test_batched_score_equals_plain_formulas():
    rng = np.random.default_rng(1)
    p = {k: (0.4 * rng.standard_normal(s)).astype(np.float32) for k, s in gru.SHAPES.items()}
    texts = [np.append(rng.integers(0, gru.START, n), gru.END).astype(np.int32) for n in (0, 1, 5, 15, 16, 17, 100, 333)]
    got = gru.score(p, texts)
    assert np.allclose(got, [slow_score(p, t) for t in texts], rtol=1e-4)
    assert np.allclose(gru.score(p, texts[::-1]), got[::-1], rtol=1e-4)


def test_output_is_a_distribution():
    rng = np.random.default_rng(2)
    p = {k: (0.4 * rng.standard_normal(s)).astype(np.float32) for k, s in gru.SHAPES.items()}
    total = sum(np.exp(gru.score(p, [np.array([c], np.int32) for c in range(gru.START)])))
    assert math.isclose(total, 1, rel_tol=1e-4)


def test_training_learns_what_follows():
    rng = np.random.default_rng(3)
    texts = []
    for _ in range(300):
        a = int(rng.integers(1, 20))
        texts.append(np.array([(a + i) % 20 + 1 for i in range(40)] + [gru.END], np.int32))
    p = gru.initial(np.bincount(np.concatenate(texts), minlength=30)[:30], np.zeros(gru.TAIL))
    before = gru.score(p, texts).sum()
    trainer = gru.Trainer(p, 0.02)
    for _ in range(6):
        trainer.learn(texts)
    assert gru.score(trainer.p, texts).sum() > 0.6 * before


def corpus(n, seed=0):
    rng, out = random.Random(seed), []
    for i in range(n):
        words = [f"{'ab'[i % 2]}{rng.randint(0, 60)}" for _ in range(rng.randint(0, 60))]
        out.append((i, " ".join(words + [f"rare{rng.randint(0, 900)}"]), "held"))
    return out


def brute(table, train):
    counts = collections.Counter()
    for t in train:
        counts.update((t or "").encode().lower().split())
    n, v, ends = sum(counts.values()) + len(train), len(counts) + (len(train) > 0), len(train)
    down = math.log10(n + 0.5 * (v + 1))
    out = []
    for t in table:
        w = (t or "").encode().lower().split()
        base = sum(math.log10(counts[x] + 0.5) - down for x in w) + math.log10(ends + 0.5) - down
        out.append((len(w) + 1, sum(x in counts for x in w) + (ends > 0), n, base))
    return out


def check(spark, frame, train, **options):
    out = lm.score_texts(frame, train, **options).collect()
    want = brute([r["text"] for r in out], [r["text"] for r in frame.where(train).collect()])
    for r, (n_tokens, n_known, n, base) in zip(out, want):
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n_tokens, n_known, n)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and r["score"] < 0
    return out


def test_counts_and_base_scores_with_and_without_the_join(spark):
    table = spark.createDataFrame(corpus(120), "id long, text string, mark string").repartition(3)
    train = F.col("id") % 5 != 1
    a = check(spark, table, train)
    b = check(spark, table, train, head=20)
    # The head's size moves tokens from the table to the join, nothing else.
    scores = lambda out: {r["id"]: r["score"] for r in out}
    few = scores(b)
    assert len(few) == 120 and set(few) == set(scores(a))


def test_network_beats_the_unigram_on_held_out_texts(spark):
    table = spark.createDataFrame(corpus(600, seed=4), "id long, text string, mark string").repartition(2)
    train = F.col("id") % 5 != 1
    out = [r for r in check(spark, table, train) if r["id"] % 5 == 1]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_awkward_rows(spark):
    frame = docs(spark).withColumnRenamed("fp", "score")
    train = F.col("doc_id") > 3  # not for a NULL id
    out = lm.score_texts(frame, train)
    assert out.columns == [*frame.columns, "n_tokens", "n_known", "train_tokens", "base_score", "score_"]
    got = out.collect()
    want = brute([r["text"] for r in got], [r["text"] for r in frame.where(train).collect()])
    assert len(got) == len(rows())
    for r, (n_tokens, n_known, n, base) in zip(got, want):
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n_tokens, n_known, n)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)


def test_no_training_and_no_documents(spark):
    assert lm.score_texts(empty(spark), F.lit(True)).collect() == []
    out = lm.score_texts(docs(spark), F.lit(False)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and abs(r["base_score"]) < 1e-6 for r in out)


def test_codes_of_known_and_unknown_tokens():
    codes = lm.Codes(lm.Vocabulary(3, 10, 4, [b"a", b"b", b"c"], [4, 3, 1], 2, (np.zeros(gru.TAIL), np.zeros(gru.TAIL))))
    tail = lambda t: gru.SHORTLIST + gru.tail_class(t)
    code, up, below = codes.of_text([b"a", b"zz", b"c", b"b"])
    assert code.tolist() == [1, tail(b"zz"), tail(b"c"), 2, gru.END] and below.tolist() == [1]
    assert np.allclose(10**up, [4.5, 1, 1.5, 3.5, 3.5])
    assert codes.of_text([])[0].tolist() == [gru.END]


def test_a_long_text_among_many_costs_its_own_length():
    import tracemalloc

    texts = [np.array([1, gru.END], np.int32)] * 600 + [np.append(np.full(60_000, 2), gru.END).astype(np.int32)]
    tracemalloc.start()
    lanes = gru.Lanes(texts, gru.LANES)
    read = np.zeros(len(texts), int)
    for a, b, running in lanes.windows(1000):
        owner = lanes.window(a, b, running)[2]
        read += np.bincount(owner[owner >= 0], minlength=len(texts))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert read.tolist() == [len(t) for t in texts]
    assert peak < 100e6


def test_a_text_above_the_chunk_stands_alone():
    sizes = [[len(t) for t in c] for c in lm._chunks(iter([np.zeros(n) for n in (3, 4, 50, 2, 9, 1)]), 10)]
    assert sizes == [[3, 4], [50], [2], [9, 1]]


ODD = [None, "", " ", "a", "\n\n A b  ", "...", "a... É,", "x\x1fy\x85z\xa0Z\x0b\x0cq\r\t", "漢" * 3, "b a  B"]


def test_texts_are_split_and_counted_as_whole_columns(monkeypatch):
    import pyarrow as pa

    want = [(t or "").encode().lower().split() for t in ODD]
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(ODD, kind)
        sizes, tokens = lm.tokens_of(column)
        assert sizes.tolist() == [len(t) for t in want]
        assert [t.encode() for t in tokens.to_pylist()] == [x for t in want for x in t]
        for most in (lm.COUNT_SLICE, 4):  # a text above it stands alone
            monkeypatch.setattr(lm, "COUNT_SLICE", most)
            assert [t for part in lm._slices(column, most) for t in part.to_pylist()] == ODD
            found = collections.Counter()
            for b in lm._count(iter([pa.RecordBatch.from_arrays([column], names=["text"])])):
                found.update(dict(zip(b.column(0).to_pylist(), b.column(1).to_pylist())))
            assert found == collections.Counter(x for t in want for x in t)
        monkeypatch.undo()
    assert [len(x) for x in lm.tokens_of(pa.array([], pa.string()))] == [0, 0]


def test_columns_are_coded_as_their_texts_are():
    import pyarrow as pa

    known = lm.Vocabulary(3, 10, 4, [b"a", b"b", b"\xc3\x89,", b"z\xc2\xa0z"], [4, 3, 1, 1], 2, (np.ones(gru.TAIL), np.ones(gru.TAIL)))
    codes = lm.Codes(known)
    rows = codes.struct(*lm.tokens_of(pa.array(ODD))).to_pylist()
    assert len(rows) == len(ODD)
    for t, r in zip(ODD, rows):
        tokens = (t or "").encode().lower().split()
        code, up, below = codes.of_text(tokens)
        assert [c - gru.SHORTLIST for c in code[:-1] if c >= gru.SHORTLIST] == [gru.tail_class(x) for x in tokens if x not in (b"a", b"b")]
        assert r["codes"] == code.astype(lm.CODE).tobytes() and r["rare"] == [tokens[i] for i in below]
        assert (r["n_tokens"], r["n_known"]) == (len(code), len(code) - len(below))
        assert math.isclose(r["base"], up.sum() - len(code) * codes.base_down, abs_tol=1e-12)
        tail = code >= gru.SHORTLIST
        assert math.isclose(r["tail"], up[tail].sum() - codes.tail_down[code[tail] - gru.SHORTLIST].sum(), abs_tol=1e-12)


def test_the_head_is_found_from_a_row_a_step_of_counts(spark):
    rng = np.random.default_rng(8)
    c = np.concatenate([rng.zipf(1.3, 400).clip(1, 10**9), [1, 2, 3, 3, 10**12]]).tolist()
    counts = spark.createDataFrame([(str(i).encode(), x) for i, x in enumerate(c)], "token binary, c long").repartition(3)
    grid = sorted({1, *(int(1.1**i) for i in range(450))})
    for head in (0, 1, 7, 100, 10**6):
        n, kinds, least = lm._sizes(counts, head)
        assert (n, kinds) == (sum(c), len(c))
        assert least == next(g for g in grid if sum(x >= g for x in c) <= head)
    assert lm._sizes(counts.where("c < 0"), 5) == (0, 0, 1)


def test_few_lanes_are_scored_in_longer_windows():
    texts = [np.array([1, gru.END], np.int32)] * 300 + [np.append(np.full(9_000, 2), gru.END).astype(np.int32)]
    lanes = gru.Lanes(texts, 512)
    seen = list(lanes.windows(16, 8192))
    assert len(seen) < 5 and all((b - a) * n <= max(16 * n, 8192) for a, b, n in seen)
    assert [a for a, _, _ in seen] == [0, *(b for _, b, _ in seen[:-1])] and seen[-1][1] == 9_001
    rng = np.random.default_rng(9)
    p = {k: (0.4 * rng.standard_normal(s)).astype(np.float32) for k, s in gru.SHAPES.items()}
    assert math.isclose(gru.score(p, texts)[-1], slow_score(p, texts[-1]), rel_tol=1e-4)
