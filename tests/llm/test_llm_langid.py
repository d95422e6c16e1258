import random

import numpy as np

from awkward import docs, empty, rows
from tallymart.llm import langid

WORDS = {
    "en": "the and that with from this have which there about would their other people".split(),
    "de": "der und nicht mit auch sich eine über durch können werden zwischen schön straße".split(),
    "es": "que los para una por más como pero sus también año niño corazón está".split(),
    "ru": "что это как его она они был быть если когда только можно человек время".split(),
}


def corpus(n, seed=0):
    rng, out = random.Random(seed), []
    for i in range(n):
        lang = rng.choice(sorted(WORDS))
        out.append((i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(5, 60))), lang))
    return out


def brute_counts(text):
    """n-grams of one text, one character at a time."""
    out = np.zeros(langid.DIM, np.int64)
    x = [0]
    for c in text.lower() + "\0":
        if c.isalpha():
            x.append(ord(c))
        elif x[-1]:
            x.append(0)
    width = 32 - langid.DIM.bit_length() + 1
    mod = 2**32
    for a, b in zip(x, x[1:]):
        out[(((a * 0x9E3779B1 + b * 0x85EBCA77) % mod) * 0xC2B2AE3D % mod) >> width] += 1
    for a, b, c in zip(x, x[1:], x[2:]):
        if b:
            out[(((a * 0x27D4EB2F + b * 0x165667B1 + c * 0x9E3779B1) % mod) * 0x85EBCA6B % mod) >> width] += 1
    return out


def test_counts_equal_brute_force():
    texts = ["", "a", " a b ", "Hello, wörld! 123 日本 x", "\n\n", "İstanbul ß", "a" * 300, "x y", "٣ و"]
    got = langid.counts(texts)
    for i, t in enumerate(texts):
        assert (got[i] == brute_counts(t)).all(), t


def test_slices_cover_all_texts_once():
    texts = ["x" * n for n in (1, 600_000, 5, 5, 700_000, 1)] + ["y"] * 200
    covered = [i for s in langid._slices(texts) for i in range(s.start, s.stop)]
    assert covered == list(range(len(texts)))


def test_document_frequencies_cover_all_rows(spark):
    table = corpus(200)
    frame = spark.createDataFrame(table, "id long, text string, lang string").repartition(5)
    df = sum((brute_counts(t) > 0).astype(int) for _, t, _ in table)
    want = np.log((1 + len(table)) / (1 + df)) + 1
    langid.ship_package(spark)
    assert np.allclose(langid.inverse_frequencies(frame), want, atol=1e-5)


def test_held_out_accuracy_and_determinism(spark):
    train = spark.createDataFrame(corpus(400), "id long, text string, lang string").repartition(4)
    test = spark.createDataFrame(corpus(200, seed=9), "id long, text string, lang string")
    model = langid.fit(train, fit_docs=50)
    out = langid.identify(test, model).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in out)
    again = langid.fit(train.repartition(7), fit_docs=50)
    assert again["langs"] == model["langs"] and np.allclose(again["centroids"], model["centroids"], atol=1e-5)


def test_far_texts_are_rejected(spark):
    model = langid.fit(spark.createDataFrame(corpus(400), "id long, text string, lang string"))
    odd = spark.createDataFrame([(1, "日本語のテキストはまったく別の言語です"), (2, "qxz wvk jjq zzx")], "id long, text string")
    assert all(r["rejected"] for r in langid.identify(odd, model).collect())


def test_awkward_rows(spark):
    frame = docs(spark).withColumnRenamed("fp", "score")
    train = frame.drop("id").selectExpr("doc_id AS id", "text", "lang")
    out = langid.identify(frame, langid.fit(train))
    assert out.columns == [*frame.columns, "lang_pred", "score_", "rejected"]
    got = out.collect()
    assert len(got) == len(rows())
    for r in got:
        no_letters = not any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == no_letters
        if no_letters:
            assert r["score_"] == 0 and r["rejected"]
        else:
            assert r["lang_pred"] in {"en", "de", "fr"}


def test_empty_tables(spark):
    train = empty(spark).drop("id").selectExpr("doc_id AS id", "text", "lang")
    model = langid.fit(train)
    assert langid.identify(empty(spark), model).collect() == []
    assert {r["lang_pred"] for r in langid.identify(docs(spark), model).collect()} == {"und"}


def nearest_by_hand(model, text):
    """One text against one centroid after the other."""
    x = np.log1p(brute_counts(text)) * model["idf"]
    x = x / (np.linalg.norm(x) or 1)
    best = (-1.0, None, 0.0)
    for lang, c, least in zip(model["langs"], model["centroids"], model["least"]):
        cos = float(sum(a * b for a, b in zip(x, c) if a))
        if cos > best[0] + 1e-6:
            best = (cos, lang, least)
    return best


def test_predictions_equal_brute_force_in_any_number_of_blocks(spark):
    train = spark.createDataFrame(corpus(300), "id long, text string, lang string")
    model = langid.fit(train, fit_docs=60)
    assert len(model["langs"]) == 16
    table = corpus(40, seed=5) + [(90, "12 34", None), (91, None, None), (92, "the der que что", None)]
    frame = spark.createDataFrame(table, "id long, text string, lang string")
    for langs in (256, 3, 1):
        got = {r["id"]: r for r in langid.identify(frame, model, keep=["id"], langs=langs).collect()}
        assert len(got) == len(table)
        for i, text, _ in table:
            if not langid.has_letter(text):
                assert (got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) == ("und", 0.0, True)
                continue
            cos, lang, least = nearest_by_hand(model, text)
            assert got[i]["lang_pred"] == lang and abs(got[i]["score"] - cos) < 1e-4
            assert got[i]["rejected"] == (cos < least) or abs(cos - least) < 1e-4


def test_more_languages_than_a_block(spark):
    rng = random.Random(2)
    words = {f"l{i:03d}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(6)] for i in range(300)}
    table = [(1000 * j + i, " ".join(words[lang] * 2), lang) for i, lang in enumerate(words) for j in range(2)]
    frame = spark.createDataFrame(table, "id long, text string, lang string").repartition(4)
    out = langid.identify(frame, langid.fit(frame), keep=["id", "lang"]).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in out) == len(table)


def test_a_language_of_mostly_letterless_and_repeated_rows_is_learned(spark):
    table = [(i, "123 456", "xx") for i in range(500)] + [(7, "...", "xx")] * 500 + [(9, "zebu yak gnu emu", "xx")] * 300
    table += corpus(200)
    frame = spark.createDataFrame(table, "id long, text string, lang string").repartition(3)
    model = langid.fit(frame, fit_docs=20)
    assert "xx" in model["langs"]
    odd = spark.createDataFrame([(1, "yak zebu emu")], "id long, text string")
    assert langid.identify(odd, model).first()["lang_pred"] == "xx"
