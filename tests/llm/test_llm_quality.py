import collections
import re
from math import comb, isclose

from pyspark.sql import functions as F

from awkward import docs, empty, rows
from tallymart.llm import quality
from tallymart.llm.quality import Cutoffs


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    wins = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if wins[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_features_equal_brute_force(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    out = quality.judge(docs(spark), labels).select("row.*", *[F.col(c).alias(f"out_{c}") for c in quality.BASE], "base_failed", "kept").collect()
    assert len(out) == len(rows())
    for r in out:
        n = brute(r["text"])
        assert n == tuple(r[f"out_{c}"] for c in quality.BASE)
        failed = n[0] < 20 or 100 * n[4] > 30 * n[0]
        assert r["base_failed"] == failed
        assert r["kept"] == (not failed)  # without labels nothing is certified


def test_overlapping_and_adjacent_repeats(spark):
    w = [f"a{i}" for i in range(30)]
    texts = [w + w, w[:8] + w[:8], w[:8] * 3 + w, ["x"] * 9, ["x"] * 8, w[:9] + w[1:9], w]
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: r["n"] for r in frame.select("i", quality.features(F.col("t"))["n_repeat_words"].alias("n")).collect()}
    assert got == {i: brute(" ".join(t))[4] for i, t in enumerate(texts)}


def test_binomial_tail_is_exact(spark):
    cases = [(k, n) for n in (1, 7, 60, 500, 3000) for k in (0, 1, 2, 5, 20) if k < n * 0.02]
    frame = spark.createDataFrame(cases, "k long, n long")
    for r in frame.withColumn("p", quality.binomial_tail(F.col("k"), F.col("n"), 0.02)).collect():
        exact = sum(comb(r["n"], j) * 0.02**j * 0.98 ** (r["n"] - j) for j in range(r["k"] + 1))
        assert isclose(r["p"], exact, rel_tol=1e-8)


def test_cutoffs_stop_at_the_first_that_fails(spark):
    rules = (Cutoffs("x", "x", (0.8, 0.6, 0.4)), Cutoffs("y", "y", (5.0,)))
    # Stratum a: no good document above 0.6, many above 0.4; b: too few labels; NULL: all cutoffs hold.
    rows_ = [("a", True, 0.5 if i < 200 else 0.1, 0.0) for i in range(2000)]
    rows_ += [("a", False, 0.9, 9.0)] * 50 + [("b", True, 0.0, 0.0)] * 10 + [(None, True, 0.0, 0.0)] * 2000
    frame = spark.createDataFrame(rows_, "stratum string, good boolean, x double, y double")
    got = {(r["stratum"], r["rule"]): r["cutoff"] for r in quality.certify(frame, rules, 0.02, 0.05).collect()}
    assert got == {("a", 0): 0.6, ("a", 1): 5.0, ("b", 0): None, ("b", 1): None, (None, 0): 0.4, (None, 1): 5.0}


def test_rare_strata_are_judged_together(spark):
    rules = (Cutoffs("x", "x", (0.8, 0.6)), Cutoffs("y", "y", (5.0,)))
    many = [(f"r{i % 40}", True, 0.0, 0.0) for i in range(800)]  # twenty each: no certificate alone
    few = [(f"s{i % 4}", True, 0.0, 0.0) for i in range(80)]
    own = [("big", True, 0.7 if i < 100 else 0.0, 0.0) for i in range(1000)]
    for rows_, want in ((many + own, (0.6, 5.0)), (few + own, (None, None))):
        frame = spark.createDataFrame(rows_, "stratum string, good boolean, x double, y double")
        got = {(r["stratum"], r["rule"]): (r["pooled"], r["cutoff"]) for r in quality.certify(frame, rules, 0.02, 0.05).collect()}
        assert got.pop(("big", 0)) == (False, 0.8) and got.pop(("big", 1)) == (False, 5.0)
        assert set(got.values()) == {(True, c) for c in want}


def test_the_guarantee_holds_over_the_rules_together(spark):
    # Each rule alone rejects 1.5 % of the good documents, together 3 %: beyond the risk.
    rules = (Cutoffs("x", "x", (0.5,)), Cutoffs("y", "y", (0.5,)))
    rows_ = [("a", True, 1.0 if i < 15 else 0.0, 1.0 if 100 <= i < 115 else 0.0) for i in range(1000)] * 3
    frame = spark.createDataFrame(rows_, "stratum string, good boolean, x double, y double")
    got = {r["rule"]: r["cutoff"] for r in quality.certify(frame, rules, 0.02, 0.05).collect()}
    assert got == {0: 0.5, 1: None}


def test_rejected_good_documents_stay_within_the_risk():
    """Simulated: how often the walk ends at a step beyond the risk."""
    import numpy as np

    rng, ladder, broken = np.random.default_rng(0), quality.steps(), 0
    share = np.linspace(0.001, 0.05, len(ladder))  # of good documents rejected at each step
    for _ in range(2000):
        u = np.sort(rng.random(800))
        done = 0
        for p in share:
            k = int(np.searchsorted(u, p))
            if sum(comb(800, j) * 0.02**j * 0.98 ** (800 - j) for j in range(k + 1)) > 0.05:
                break
            done += 1
        broken += done and share[done - 1] > 0.02
    assert broken <= 0.05 * 2000


def test_documents_of_unlabelled_strata_get_the_pooled_cutoffs(spark):
    good = " ".join(f"word{i}" for i in range(40))
    junk = " ".join(f"#$% w{i}" for i in range(40))
    docs_ = [(i, f"{good} {i}", f"l{i % 30}") for i in range(600)] + [(9000 + i, f"{junk} {i}", f"new{i}") for i in range(5)]
    frame = spark.createDataFrame(docs_, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(600)], "doc_id long, quality int")
    assert {r["doc_id"] for r in quality.filter_quality(frame, labels).collect()} == set(range(600))


def test_verdict_rejects_junk_and_keeps_good(spark):
    good = " ".join(f"word{i}" for i in range(40))
    junk = " ".join(f"#$% w{i}" for i in range(40))
    texts = [(i, good + f" {i}", "en") for i in range(1500)] + [(9000 + i, junk + f" {i}", "en") for i in range(20)]
    frame = spark.createDataFrame(texts, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(
        [(i, 1) for i in range(1400)] + [(9000, 0), (9001, None), (None, 1), (77777, 1), (3, 1)], "doc_id long, quality int"
    )
    kept = quality.filter_quality(frame, labels)
    assert kept.columns == frame.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert ids == set(range(1500))


def test_conflicting_labels_are_not_good(spark):
    good = " ".join(f"word{i}" for i in range(40))
    frame = spark.createDataFrame([(1, good, None)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1), (1, 0)], "doc_id long, quality int")
    assert quality.judge(frame, labels).count() == 1


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.judge(empty(spark), labels).collect() == []
    assert quality.filter_quality(empty(spark), labels).columns == empty(spark).columns


def test_no_python_in_the_plan(spark):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    plan = quality.filter_quality(docs(spark), labels)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
