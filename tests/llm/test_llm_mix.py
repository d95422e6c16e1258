import collections

from pyspark.sql import functions as F

from awkward import docs, empty, rows
from tallymart.llm import mix


def words(text):
    return len((text or "").encode().split())


def test_targets_share_all_sizes_up_to_the_cap(spark):
    sizes = {"a": 10, "b": 1000, "c": 50, "d": 0, None: 200}
    sources = mix.weighted_sources(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    got = {r["source"]: r for r in mix.targets(sources).collect()}
    weights = dict(zip(["a", "b", "c", "d", None], [1, 2, 3, 1, 2]))
    assert {s: r["weight"] for s, r in got.items()} == weights
    # Brute force: share by weight, cap, share the excess again.
    total, capped = sum(sizes.values()), set()
    while True:
        free = total - sum(3 * sizes[s] for s in capped)
        want = {s: free * weights[s] / sum(w for x, w in weights.items() if x not in capped) for s in sizes if s not in capped}
        over = {s for s, w in want.items() if w > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    want.update({s: 3 * sizes[s] for s in capped})
    assert {s: round(r["target"], 6) for s, r in got.items()} == {s: round(w, 6) for s, w in want.items()}


def test_copies_match_systematic_sampling_in_one_list(spark):
    frame = spark.createDataFrame(
        [(i, "w " * (1 + i * 7 % 40), "ab"[i % 3 == 0]) for i in range(300)], "doc_id long, text string, source string"
    ).repartition(7)
    got = mix.mix(frame, keep=["doc_id", "source"]).collect()
    offsets = {
        r["s"]: r["o"] for r in spark.createDataFrame([("a",), ("b",)], "s string").select("s", mix.offset(F.col("s")).alias("o")).collect()
    }
    for source in "ab":
        mine = sorted((r for r in got if r["source"] == source), key=lambda r: (r["size"], r["doc_id"]))
        expected = mine[0]["target"] / mine[0]["source_size"]
        for k, r in enumerate(mine):
            assert r["copies"] == int((k + 1) * expected + offsets[source]) - int(k * expected + offsets[source])
            assert 0 <= r["copies"] <= 3
        taken = sum(r["size"] * r["copies"] for r in mine)
        assert abs(taken - mine[0]["target"]) <= 2 * max(r["size"] for r in mine)


def test_awkward_rows_keep_columns_and_agree_on_reruns(spark):
    frame = docs(spark)
    first = mix.mix(frame)
    assert first.columns == [*frame.columns, "size_", "source_size", "target", "copies"]
    a = sorted(map(str, first.drop("row").collect()))
    b = sorted(map(str, mix.mix(frame.repartition(5)).drop("row").collect()))
    assert a == b and len(a) == len(rows())
    assert all(r["size_"] == words(r["text"]) for r in first.collect())
    per_source = first.groupBy("source").agg(F.sum("size_").alias("n"), F.max("source_size").alias("s")).collect()
    assert all(r["n"] == r["s"] for r in per_source)


def test_emit_repeats_rows_as_taken(spark):
    frame = docs(spark)
    want = collections.Counter()
    for r in mix.mix(frame).collect():
        want[(r["doc_id"], r["text"], r["source"])] += r["copies"]
    out = mix.emit(frame)
    assert out.columns == frame.columns
    got = collections.Counter((r["doc_id"], r["text"], r["source"]) for r in out.collect())
    assert got == +want


def test_empty_table(spark):
    assert mix.mix(empty(spark)).collect() == []
    assert mix.emit(empty(spark)).collect() == []
