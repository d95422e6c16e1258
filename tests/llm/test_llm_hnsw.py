import collections

import numpy as np
from pyspark.sql import functions as F

from tallymart.llm import hnsw

SCHEMA = "vec_id long, embedding array<float>, label int, id string, score int"


def frame_of(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "x", 2) for i, v in rows], SCHEMA)


def brute(rows, k, is_query):
    usable = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        v = tuple(float(np.float32(x)) for x in v)
        usable[i] = min(usable.get(i, v), v)
    groups = collections.defaultdict(list)
    for i, v in usable.items():
        groups[len(v)].append((i, np.array(v)))
    out = {}
    for members in groups.values():
        ids, x = np.array([i for i, _ in members]), np.stack([v for _, v in members])
        for i, v in members:
            if is_query(i):
                s = (x * v).sum(axis=1)
                order = np.lexsort((ids, -s))
                out[i] = [(int(ids[j]), s[j]) for j in order if ids[j] != i][:k]
    return out


def searched(frame, **options):
    out = collections.defaultdict(list)
    for r in hnsw.nearest(frame, F.col("id") % 5 == 0, **options).orderBy("query_id", "rank").collect():
        out[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    return out


def recall(got, want):
    hits = sum(len({v for _, v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    return hits / max(1, sum(map(len, want.values())))


def test_recall_order_and_scores(spark):
    rng = np.random.default_rng(0)
    centers = rng.normal(size=(10, 16))
    rows = [(i, centers[i % 10] + 0.4 * rng.normal(size=16) * (1 + i % 3)) for i in range(1500)]
    got, want = searched(frame_of(spark, rows), shard=400), brute(rows, 20, lambda i: i % 5 == 0)
    assert recall(got, want) >= 0.95
    x = {i: np.array([float(np.float32(a)) for a in v]) for i, v in rows}
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(abs(s - x[q] @ x[v]) < 1e-9 for _, v, s in found)
        assert found == sorted(found, key=lambda f: (-f[2], f[1]))


def test_awkward_vectors(spark):
    v = [0.6, 0.8, 0.0]
    rows = [(None, v), (1, None), (2, []), (3, [0, 0, 0]), (4, [1, None, 2]), (6, [1, float("nan"), 0]), (7, [1, float("inf"), 0])]
    rows += [(i, v) for i in range(100, 160)]  # one very common vector
    rows += [(10, v), (10, v), (15, [1, 2, 3]), (15, [0.5, 9, 9]), (20, [1, 2]), (21, [3, 1]), (25, [7])]
    got, want = searched(frame_of(spark, rows)), brute(rows, 20, lambda i: i % 5 == 0)
    assert {q: [(v, s) for _, v, s in f] for q, f in got.items()} == {q: f for q, f in want.items() if f}


def test_few_candidates_are_all_returned(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4)) for i in range(18)]
    got = searched(frame_of(spark, rows))
    assert all(sorted(v for _, v, _ in f) == sorted(set(range(18)) - {q}) for q, f in got.items()) and len(got) == 4


def test_tables_without_vectors_or_queries(spark):
    assert searched(frame_of(spark, [])) == {}
    assert searched(frame_of(spark, [(1, [1.0]), (2, [2.0])])) == {}


def test_every_node_is_reached():
    rng = np.random.default_rng(3)
    tight = np.concatenate([rng.normal(size=(1, 8)) * 5 + 1e-3 * rng.normal(size=(150, 8)) for _ in range(6)])
    graph = hnsw.build(hnsw._equal_norms(tight))
    assert hnsw._reach(graph.layers[0], graph.entry).all()


def test_one_very_long_vector_spoils_nothing():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[7] *= 10_000
    asked = x[100:200]
    graph = hnsw.build(hnsw._equal_norms(x))
    found, _ = graph.search(np.column_stack([asked, np.zeros(100)]), hnsw.EF_SEARCH)
    hits = 0
    for q, row in zip(asked, found):
        near = set(np.argsort(-(x @ q))[:20].tolist())
        hits += len(near & set(row.tolist()))
    assert hits >= 0.9 * 20 * 100


def test_more_equal_scores_than_the_beam_holds(spark):
    rows = [(0, [1.0, 0.0]), *[(i, [1.0, float(i)]) for i in range(1, 301)], *[(i, [1.0, -float(i)]) for i in range(400, 500)]]
    got = searched(frame_of(spark, rows))
    assert [(v, s) for _, v, s in got[0]] == [(i, 1.0) for i in range(1, 21)]


def test_recall_over_full_shards_of_any_norm(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(2 * hnsw.SHARD, 64))
    x *= np.exp(rng.normal(size=(len(x), 1)))  # log-normal norms
    x = x.astype(np.float32).astype(float)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    out = hnsw.nearest(frame, F.col("id") % 160 == 0).collect()
    hits, asked = 0, range(0, len(x), 160)
    near = collections.defaultdict(set)
    for r in out:
        near[r["query_id"]].add(r["vec_id"])
    for i in asked:
        score = x @ x[i]
        score[i] = -np.inf
        hits += len(near[i] & set(np.argsort(-score)[:20].tolist()))
    print("recall", hits / (20 * len(asked)))
    assert hits >= 0.95 * 20 * len(asked)
