"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tallymart.llm import bpe, hnsw, langid, lm, quality, runs, secrets, simhash, tokenfile, topk, unigram, whiten
from tallymart.llm.common import fold, table, words
from tallymart.llm.mix import mix
from tallymart.session import scratch_path

BYTE_BPE = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"
WORD_BPE = "word_bpe_49k.json"
END_ID = 2


def op1_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20."""
    return hnsw.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; learned from the folds 1 to 4."""
    docs = table(spark, sf_dir, "documents")
    held_out = (fold(F.col("doc_id"), 5) == 0).alias("held_out")
    train = docs.where(fold(F.col("doc_id"), 5) != 0).select(F.col("doc_id").alias("id"), "text", "lang")
    marked = docs.select("doc_id", held_out, "text")
    return langid.identify(marked, langid.fit(train), keep=["doc_id", "held_out"])


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and ids as read back from the token files."""
    target = scratch_path(spark, "token-files")
    tokenfile.write_tokens(table(spark, sf_dir, "documents"), target, public_tokenizers.path(WORD_BPE), END_ID)
    back = tokenfile.read_tokens(spark, target)
    return back.select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base features of every document and the verdict of the certified rules."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = quality.judge(docs, labels, keep=["doc_id"])
    return out.select(
        F.col("row.doc_id").alias("doc_id"),
        *quality.BASE,
        "base_failed",
        "kept",
        F.array_join("failed_rules", ",").alias("failed_rules"),
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token count and best score of every document."""
    docs = table(spark, sf_dir, "documents")
    return unigram.count_tokens(docs, public_tokenizers.path(PIECES), keep=["doc_id"])


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and spans of the secrets in every document."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents"), keep=["doc_id"])
    count = lambda kind: F.size(F.filter("base", lambda x: x["order"] == kind)).cast("long")
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.spelled(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        secrets.spelled(F.col("spans")).alias("spans"),
    )


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), keep=["doc_id"])
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return out.select("doc_id", digits.alias("fingerprint"), "component_id")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids of every document and of the bytes
    that they decode to."""
    path, pattern = public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN
    ids = bpe.encode_decoded(table(spark, sf_dir, "documents"), path, pattern, keep=["doc_id"])
    return ids.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document; learned from the folds other than 1."""
    docs = table(spark, sf_dir, "documents")
    marked = docs.select("doc_id", (fold(F.col("doc_id"), 5) == 1).alias("held_out"), "text")
    return lm.score_texts(marked, ~F.col("held_out"), keep=["doc_id", "held_out"])


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of every document when sources are mixed to their targets."""
    mixed = mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    taken = (F.col("size") * F.col("copies")).cast("long")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def _planted(ws: Column, doc_id: Column) -> Column:
    """The words of a document; where the crc32 of the id ends in 0, all words
    from a place on repeat with a period.  Without a lambda function: Spark
    does not take one inside the input of a Python function."""
    h, n = F.crc32(doc_id.cast("string").cast("binary")), F.size(ws)
    g = F.floor(h / 10)
    a = F.pmod(g, n).cast("int")
    p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(ws, a + 1, p), F.ceil((n - a) / p).cast("int")))
    repeated = F.concat(F.slice(ws, F.lit(1), a), F.slice(again, F.lit(1), n - a))
    return F.when((h % 10 == 0) & (n > 0), repeated).otherwise(ws)


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document's words (a tenth of the documents get
    planted ones), and its text without what they repeat."""
    docs = table(spark, sf_dir, "documents").select("doc_id", words(F.col("text")).alias("ws"))
    found = runs.runs_of_words(docs, _planted(F.col("ws"), F.col("doc_id")), keep=["doc_id"])
    best = F.col("best")
    found = found.select("doc_id", "runs", "kept", runs.longest(F.col("runs")).alias("best"))
    spelled = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(spelled, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.array_join("kept", " ").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest integer inner products of every vector whose id is
    divisible by 50."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op13_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the 8 leading components, whitened."""
    rows, model, error = whiten.whiten(table(spark, sf_dir, "embeddings"))
    shares = F.array(*map(F.lit, model.explained.tolist())) if model.values.size else F.array().cast("array<double>")
    return rows.select(F.col("id").alias("vec_id"), "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


QUERIES = {
    "op1_hnsw": op1_hnsw,
    "op2_langid": op2_langid,
    "op3_token_files": op3_token_files,
    "op4_quality": op4_quality,
    "op5_token_counts": op5_token_counts,
    "op6_secrets": op6_secrets,
    "op7_simhash": op7_simhash,
    "op8_bpe": op8_bpe,
    "op9_lm": op9_lm,
    "op10_mix": op10_mix,
    "op11_runs": op11_runs,
    "op12_topk": op12_topk,
    "op13_whiten": op13_whiten,
}
