"""Language identification by nearest centroids.

Texts become TF-IDF vectors of character bigrams and trigrams (lower-cased
letters, with word boundaries), hashed into ``DIM`` buckets: ``ln(1 + tf)``
times the smoothed inverse document frequency, normalised.  Every language has
several centroids, found by spherical k-means, and a text gets the language of
the centroid with the largest cosine; it is rejected where it is farther from
that centroid than nearly all texts of the centroid's cluster.

Document frequencies come from all training documents.  The centroids of a
language are fitted on at most ``FIT_DOCS`` of its labelled training documents
(those of the least hash, from about twice as many with a letter), so a
language takes ``CENTROIDS * DIM`` numbers at any size of input.  Texts are
compared with ``LANG_BLOCK`` languages at a time; where there are more, the
best language so far is written between the blocks, so no task holds the
centroids of all of them.

Defined results: a text that is NULL or has no letter gets ``und``, score 0,
and is rejected; so does every text where no language could be learned; equal
cosines go to the language first in code point order; repeated rows are
predicted each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.common import fresh, ship_package
from tallymart.session import materialize

DIM = 4096
CENTROIDS = 4
FIT_DOCS = 1000
#: Languages sent to the tasks at a time.
LANG_BLOCK = 256
ROUNDS = 12
#: Share of a cluster's own texts that lie within its radius.
RADIUS_SHARE = 0.995
UNKNOWN = "und"
_CHARS = 1 << 19
_DOCS = 64

_letters: list[np.ndarray] = []


def _is_letter(points: np.ndarray) -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0][points]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def counts(texts: list[str]) -> np.ndarray:
    """n-gram counts of each whole text: (len(texts), DIM)."""
    out = np.zeros(len(texts) * DIM, np.int64)
    lowered = [t.lower() for t in texts]
    points = np.frombuffer("\0".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lowered])
    letter = _is_letter(points)
    # Runs of letters, each followed by one boundary (0).
    used = letter.copy()
    used[1:] |= letter[:-1]
    x = np.where(letter, points, 0)[used].astype(np.uint32)
    doc = doc[used]
    x = np.concatenate([np.zeros(1, np.uint32), x])
    doc = np.concatenate([doc[:1], doc])
    width = np.uint32(32 - DIM.bit_length() + 1)
    two = (x[:-1] * np.uint32(0x9E3779B1) + x[1:] * np.uint32(0x85EBCA77)) * np.uint32(0xC2B2AE3D) >> width
    out += np.bincount(doc[1:] * DIM + two, minlength=out.size)
    if len(x) > 2:
        inner = x[1:-1] != 0
        three = (
            x[:-2] * np.uint32(0x27D4EB2F) + x[1:-1] * np.uint32(0x165667B1) + x[2:] * np.uint32(0x9E3779B1)
        ) * np.uint32(0x85EBCA6B) >> width
        out += np.bincount((doc[2:] * DIM + three)[inner], minlength=out.size)
    return out.reshape(len(texts), DIM)


def _slices(texts: list[str]) -> Iterator[slice]:
    """Runs of texts of bounded length and number (a longer text stands alone)."""
    begin = size = 0
    for i, t in enumerate(texts):
        if i > begin and (size + len(t) > _CHARS or i - begin >= _DOCS):
            yield slice(begin, i)
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield slice(begin, len(texts))


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF vectors (zero for a text without letters)."""
    x = np.log1p(counts(texts).astype(np.float32)) * idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(DIM, np.int64)
    n = 0
    for batch in batches:
        texts = [t for t in batch.column(0).to_pylist() if has_letter(t)]
        for s in _slices(texts):
            total += (counts(texts[s]) > 0).sum(axis=0)
            n += len(texts[s])
    yield pa.RecordBatch.from_arrays(
        [pa.array([n]), pa.array([total.tolist()], pa.list_(pa.int64()))], names=["n", "df"]
    )


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """ln((1 + n) / (1 + df)) + 1 over all rows of ``texts`` (text)."""
    parts = texts.select("text").mapInArrow(_document_frequencies, "n long, df array<long>")
    # Bucket -1 counts the documents.
    rows = (
        parts.select(F.posexplode(F.concat(F.array("n"), "df")).alias("bucket", "df"))
        .groupBy("bucket")
        .agg(F.sum("df").alias("df"))
        .collect()  # DIM + 1 rows
    )
    df = np.zeros(DIM + 1)
    for r in rows:
        df[r["bucket"]] = r["df"]
    return (np.log((1 + df[0]) / (1 + df[1:])) + 1).astype(np.float32)


def clusters(x: np.ndarray, k: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: unit centroids, and the least cosine that all but
    1 - RADIUS_SHARE of each cluster's members reach."""
    k = min(k, len(x))
    mean = x.mean(axis=0)
    chosen = [int(np.argmax(x @ mean))]
    while len(chosen) < k:  # the text farthest from those chosen
        chosen.append(int(np.argmin((x @ x[chosen].T).max(axis=1))))
    c = x[chosen]
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        sums = np.stack([x[own == j].sum(axis=0) if (own == j).any() else c[j] for j in range(k)])
        c = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    cos = x @ c.T
    own = cos.argmax(axis=1)
    least = [float(np.quantile(cos[own == j, j], 1 - RADIUS_SHARE)) if (own == j).any() else 1.0 for j in range(k)]
    return c.astype(np.float32), np.array(least)


def fit(train: DataFrame, fit_docs: int = FIT_DOCS, centroids: int = CENTROIDS) -> dict:
    """Model from ``train`` (id, text, lang): langs, centroids, radii, idf."""
    ship_package(train.sparkSession)
    idf = inverse_frequencies(train)
    hashed = F.xxhash64("id", "text")
    learned = train.where(F.col("lang").isNotNull() & F.regexp_like("text", F.lit(r"\p{L}")))
    # One row a language; equal rows share a hash, so they count once.
    sizes = materialize(learned.groupBy("lang").agg(F.count_distinct(hashed).alias("n")), "langid-sizes")
    # Of a language's n texts those whose hash, as a share of all values, is
    # below 2 fit_docs / n: about twice as many as wanted reach the window
    # that takes the least, at any size.
    bound = (F.least(F.lit(1.0), F.lit(2.0 * fit_docs) / F.col("n")) * float(2**62 - 1)).cast("long")
    learned = learned.join(sizes, on="lang").where(F.shiftrightunsigned(hashed, 2) <= bound)
    order = Window.partitionBy("lang").orderBy(hashed, "id")
    sample = learned.withColumn("at", F.row_number().over(order)).where(F.col("at") <= fit_docs)

    def vectorise(batches):
        for batch in batches:
            langs_of, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for s in _slices(texts):
                packed = [v.tobytes() for v in vectors(texts[s], idf)]
                yield pa.RecordBatch.from_arrays([pa.array(langs_of[s]), pa.array(packed, pa.binary())], names=["lang", "v"])

    def cluster(rows: pd.DataFrame) -> pd.DataFrame:
        packed = sorted(rows["v"])  # the order of the rows must not matter
        c, least = clusters(np.frombuffer(b"".join(packed), np.float32).reshape(len(packed), DIM), centroids)
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "j": range(len(c)), "c": [v.tobytes() for v in c], "least": least})

    packed = sample.select("lang", "text").mapInArrow(vectorise, "lang string, v binary")
    # At most fit_docs rows a language in a group.
    found = packed.groupBy("lang").applyInPandas(cluster, "lang string, j int, c binary, least double").collect()
    found.sort(key=lambda r: (r["lang"], r["j"]))
    return {
        "idf": idf,
        "langs": [r["lang"] for r in found],
        "centroids": np.frombuffer(b"".join(bytes(r["c"]) for r in found), np.float32).reshape(len(found), DIM),
        "least": np.array([r["least"] for r in found]),
    }


def predicted(spark, text: Column, model: dict) -> Column:
    """Struct (lang_pred, score, rejected) of a whole text."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double,rejected:boolean>")
    def run(values: pa.Array) -> pa.Array:
        m = shared.value
        texts = values.to_pylist()
        lang, score, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        real = [i for i, t in enumerate(texts) if has_letter(t)] if m["langs"] else []
        found = [texts[i] for i in real]
        for s in _slices(found):
            cos = vectors(found[s], m["idf"]) @ m["centroids"].T
            best = cos.argmax(axis=1)
            for i, b, c in zip(real[s], best.tolist(), cos.max(axis=1).tolist()):
                lang[i], score[i], rejected[i] = m["langs"][b], min(1.0, max(0.0, c)), c < m["least"][b]
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)], names=["lang_pred", "score", "rejected"])

    return run(text.cast("string"))


def blocks(model: dict, langs: int = LANG_BLOCK) -> list[dict]:
    """The model of at most ``langs`` languages each, in their order."""
    names = list(dict.fromkeys(model["langs"]))
    out = []
    for at in range(0, max(1, len(names)), langs):
        mine = set(names[at : at + langs])
        rows = [i for i, lang in enumerate(model["langs"]) if lang in mine]
        out.append({
            "idf": model["idf"], "langs": [model["langs"][i] for i in rows],
            "centroids": model["centroids"][rows], "least": model["least"][rows],
        })
    return out


def identify(
    docs: DataFrame, model: dict, text_col: str = "text", keep: list[str] | None = None, langs: int = LANG_BLOCK
) -> DataFrame:
    """Every row (columns ``keep``, default all) followed by ``lang_pred`` (the
    nearest learned language, ``und`` without letters), ``score`` (cosine) and
    ``rejected``.  Names the input uses already get underscores."""
    spark = docs.sparkSession
    ship_package(spark)
    kept = list(docs.columns if keep is None else keep)
    first, *rest = blocks(model, langs)
    text = F.col(text_col).cast("string")
    out = docs.select(F.struct(*kept).alias("row"), *([text.alias("text")] if rest else []), predicted(spark, text, first).alias("p"))
    for block in rest:
        both = materialize(out, "langid-best").withColumn("q", predicted(spark, F.col("text"), block))
        # Equal cosines stay with the language that comes first; ``und`` is the same in all blocks.
        better = F.col("q.score") > F.col("p.score")
        out = both.select("row", "text", F.when(better, F.col("q")).otherwise(F.col("p")).alias("p"))
    added = [F.col("p")[c].alias(fresh(kept, c)) for c in ("lang_pred", "score", "rejected")]
    return out.select(*[F.col("row")[c].alias(c) for c in kept], *added)
