import collections
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from awkward import docs, empty, rows
from tallymart.llm import simhash


def brute_print(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in h) > len(h))


def brute_groups(prints, bits):
    parent = list(range(len(prints)))

    def find(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    x = np.array(prints, np.uint64)
    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x[i + 1 :] ^ x[i]) <= bits) + i + 1:
            parent[find(int(j))] = find(i)
    return [find(i) for i in range(len(x))]


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def test_fingerprints_and_groups_equal_brute_force(spark):
    out = simhash.near_duplicates(docs(spark)).collect()
    assert len(out) == len(rows())
    prints = [brute_print(r["text"]) for r in out]
    assert [signed(p) for p in prints] == [r["fingerprint"] for r in out]
    groups = collections.defaultdict(list)
    for r, g in zip(out, brute_groups(prints, 3)):
        groups[g].append(r)
    for members in groups.values():
        ids = [r["doc_id"] for r in members if r["doc_id"] is not None]
        assert {r["component_id"] for r in members} == {min(ids) if ids else None}


def test_added_names_do_not_clash(spark):
    frame = docs(spark).withColumn("fingerprint", F.lit("x")).withColumn("component_id", F.lit("y"))
    assert simhash.near_duplicates(frame).columns == [*frame.columns, "fingerprint_", "component_id_"]


def planted(rng, n, flips):
    """Fingerprints: random ones, chains and dense balls of neighbours."""
    out = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(n // 4):
        x = rng.choice(out)
        for b in rng.sample(range(64), rng.randint(1, flips)):
            x ^= 1 << b
        out.append(x)
    center = rng.getrandbits(64)
    out += [center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(200)]
    chain = rng.getrandbits(64)
    for _ in range(40):
        for b in rng.sample(range(64), 3):
            chain ^= 1 << b
        out.append(chain)
    return sorted(set(out))


def test_links_connect_what_brute_force_connects(spark):
    for bits, blocks, tile in ((3, 6, 50_000), (3, 5, 7), (2, 4, 50_000), (3, 4, 30)):
        prints = planted(random.Random(bits * blocks), 300, 4)
        frame = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
        pairs = simhash.links(frame, bits, blocks, tile)
        for r in pairs.collect():
            assert r["a"] != r["b"]
        got = {r["node"]: r["root"] for r in simhash.components(pairs).collect()}
        label = [got.get(signed(p), signed(p)) for p in prints]
        by_label, by_group = collections.defaultdict(set), collections.defaultdict(set)
        for p, a, b in zip(prints, label, brute_groups(prints, bits)):
            by_label[a].add(p)
            by_group[b].add(p)
        assert sorted(map(sorted, by_label.values())) == sorted(map(sorted, by_group.values()))
        assert all(k == min(map(signed, v)) for k, v in by_label.items() if len(v) > 1)


def test_links_of_a_dense_bucket_are_a_forest(spark):
    rng = random.Random(5)
    center = rng.getrandbits(64)
    near = np.array(sorted({center ^ (1 << a) ^ (1 << b) for a in range(60) for b in range(60)}), np.uint64)
    assert len(simhash.forest(near, 3)) == len(near) - 1


def test_one_of_each(spark):
    frame = docs(spark)
    kept = simhash.one_of_each(frame)
    assert kept.columns == frame.columns
    got = kept.collect()
    all_rows = frame.collect()
    groups = brute_groups([brute_print(r["text"]) for r in all_rows], 3)
    least = {}
    for r, g in zip(all_rows, groups):
        key = (r["doc_id"] is None, r["doc_id"] or 0)
        least[g] = min(least.get(g, key), key)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted(least.values())


def test_components_of_long_chains(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000 + i, 1000) for i in range(1, 50)] + [(5, 5)]
    got = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(50)}}


def test_empty_table(spark):
    assert simhash.near_duplicates(empty(spark)).collect() == []
    assert simhash.one_of_each(empty(spark)).collect() == []
