import collections

import corpus_pipeline
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from awkward import SCHEMA, rows
from tallymart.llm import mix
from test_llm_quality import brute
from test_llm_secrets import base, entropy
from test_llm_simhash import brute_groups, brute_print

GOOD = " ".join(f"word{i % 29}x{i}" for i in range(45))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    docs = [r[:5] for r in rows()]
    docs += [(100 + i, f"{GOOD} tail{i} password=abcdefghijkl{i:04d} end", "en", "ab"[i % 2], 1) for i in range(30)]
    docs += [(200 + i, docs[-1][1], "en", "c", 1) for i in range(5)]  # copies
    docs += [(300 + i, " ".join(f"n{i}w{j * 7919 % 1013}" for j in range(60 + 10 * i)), "de", "d", 1) for i in range(20)]
    schema = ", ".join(SCHEMA.split(", ")[:5])
    spark.createDataFrame(docs, schema).repartition(4).write.parquet(f"{root}/documents.parquet")
    labels = [(d[0], 1, 0) for d in docs if d[0] is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


def redacted(text):
    spans, merged = sorted(base(text) + entropy(text)), []
    for a, _, b in spans:
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    for a, b in reversed(merged):
        text = text[:a] + "[SECRET]" + text[b:]
    return text


def test_stages_are_the_dealt_ones():
    assert [f.__doc__ is not None and callable(f) for _, f in corpus_pipeline.STAGES] == [True] * 5
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_dedup", "secret_scan", "source_mix", "byte_bpe"]


def test_stages_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)

    def stage(name, frame):
        # As the contract has it: written and read again between the stages.
        stages[name](spark, frame, folder).write.mode("overwrite").parquet(f"{folder}/out/{name}")
        return spark.read.parquet(f"{folder}/out/{name}")

    kept = stage("quality_rules", docs)
    assert kept.columns == columns
    fine = lambda t: (n := brute(t))[0] >= 20 and 100 * n[4] <= 30 * n[0]
    want = [tuple(r) for r in docs.collect() if fine(r["text"])]  # too few labels to certify a rule
    assert collections.Counter(map(tuple, kept.collect())) == collections.Counter(want)

    single = stage("simhash_dedup", kept)
    assert single.columns == columns
    groups = collections.defaultdict(list)
    for r, g in zip(want, brute_groups([brute_print(r[1]) for r in want], 3)):
        groups[g].append((r[0] is None, r[0] or 0))
    got = single.collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted(map(min, groups.values()))

    clean = stage("secret_scan", single)
    assert clean.columns == columns
    want = collections.Counter((r["doc_id"], redacted(r["text"]), len(redacted(r["text"]))) for r in got)
    assert collections.Counter((r["doc_id"], r["text"], r["n_chars"]) for r in clean.collect()) == want

    mixed = stage("source_mix", clean)
    assert mixed.columns == columns
    copies = {r["doc_id"]: r["copies"] for r in mix.mix(clean, keep=["doc_id"]).collect()}
    taken = collections.Counter(r["doc_id"] for r in mixed.collect())
    assert taken == collections.Counter({k: n for k, n in copies.items() if n})

    tokens = stage("byte_bpe", mixed).collect()
    from test_llm_bpe import ORACLE

    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    assert collections.Counter(r["doc_id"] for r in tokens) == taken
    for r in tokens:
        assert r["ids"] == ORACLE.encode_ordinary(texts[r["doc_id"]]) and r["n_tokens"] == len(r["ids"]) and r["round_trip"]


def test_run_applies_all_stages(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    last = spark.read.parquet(f"{folder}/out/byte_bpe")
    key = lambda df: sorted(map(str, df.select("doc_id", "n_tokens", "ids").collect()))
    assert key(out) == key(last)


def test_empty_documents(spark, tmp_path):
    schema = ", ".join(SCHEMA.split(", ")[:5])
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_clashing_columns_pass_through(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for c in ("row", "id", "fp", "place", "size", "copies", "part", "rank", "stratum", "f", "kept", "spans", "ids", "target"):
        docs = docs.withColumn(c, F.lit(c))
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        r = out.first()
        assert all(r[c] == c for c in docs.columns[5:])
