"""Language-model scores of whole texts: a gated recurrent network over the
frequent tokens (``gru``), exact corpus counts for all of them.

Token counts are taken over every training document and written.  At most
``HEAD`` tokens, those above a count threshold, travel to the tasks; the
tokens below it that a text holds are joined to the counts by a shuffle, so
the vocabulary may grow without bound.  Texts are turned into codes once and
written; training and scoring read the codes.  The network is trained on all training
documents by local training and averaging: in each of ``ROUNDS`` rounds every
task trains the current parameters on its share of the round's documents, and
the results are averaged by tokens, ``FAN_IN`` at a time.  Parameters have a
fixed size.

Every text is its tokens and one end token.  ``base_score`` is the smoothed
unigram log10 probability, ``score`` that of the network, whose tail classes
hand over to a smoothed unigram within the class; both sum to one over the
known tokens and one unseen token.

Defined results: a NULL, empty or blank text is the end token alone; without
any training document all tokens are unseen; repeated rows are scored each;
the other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm import gru
from tallymart.llm.common import fresh, ship_package
from tallymart.session import materialize

HEAD = 1 << 18
ROUNDS = 3
RATES = (0.02, 0.01, 0.005)
FAN_IN = 32
#: How codes are packed.
CODE = np.dtype("<u2")
#: Bytes of texts that are counted or coded at a time.
COUNT_SLICE, CODE_SLICE = 8 << 20, 4 << 20

_kept: dict[str, object] = {}


def _slices(column: pa.Array, most: int) -> Iterator[pa.Array]:
    """Runs of at most ``most`` bytes of texts (a longer text stands alone)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(column):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield column.slice(at, to - at)
        at = to


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The number of tokens of each text, and all tokens one after another:
    A-Z lower-cased, split at exactly the six breaks."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(texts))
    filled = pc.if_else(pc.equal(pc.binary_length(trimmed), 0), pa.scalar(None, trimmed.type), trimmed)
    split = pc.ascii_split_whitespace(filled)
    sizes = pc.fill_null(pc.list_value_length(split), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return sizes, split.flatten()


def _as_strings(tokens: pa.Array) -> pa.Array:
    """Bytes as the strings that they are, whether or not they are valid UTF-8."""
    return tokens.view(pa.large_string() if pa.types.is_large_binary(tokens.type) else pa.string())


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def _sums(values: np.ndarray, to: np.ndarray) -> np.ndarray:
    """The sum of each run of ``values`` between two offsets."""
    ends = to.tolist()
    return np.array([values[a:b].sum() for a, b in zip(ends, ends[1:])], float)


def _tail_codes(tokens: pa.Array) -> np.ndarray:
    """``gru.tail_class`` of each token, as a code for the network."""
    if not len(tokens):
        return np.empty(0, CODE)
    stems = pc.ascii_rtrim(tokens, characters=gru.PUNCTUATION.decode())
    last = pc.binary_slice(stems.cast(pa.large_binary()), -2).dictionary_encode()
    code = np.array([gru.SHORTLIST + gru.tail_class(x) for x in last.dictionary.to_pylist()], CODE)
    return code[last.indices.to_numpy()]


def _release() -> None:
    """Give unused memory back: the other worker and Spark need it."""
    pa.default_memory_pool().release_unused()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = None
    for batch in batches:
        for texts in _slices(batch.column(0), COUNT_SLICE):
            found = tokens_of(texts)[1].value_counts()
            yield pa.RecordBatch.from_arrays([found.field(0).cast(pa.binary()), found.field(1)], names=["token", "c"])
    del found
    _release()


def token_counts(texts: DataFrame) -> DataFrame:
    """(token, c) over all rows of ``texts`` (text), written."""
    ship_package(texts.sparkSession)
    parts = texts.select(F.col("text").cast("string")).mapInArrow(_count, "token binary, c long")
    return materialize(parts.groupBy("token").agg(F.sum("c").alias("c")), "lm-counts")


#: The counts between which ``_reach`` tells.
GRID = np.array(sorted({1, *(int(1.1**i) for i in range(450))}), float)


def _reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of counts: how many reach a step of ``GRID`` but not the next, and their sum."""
    kinds, total = np.zeros(len(GRID), np.int64), np.zeros(len(GRID), np.int64)
    for batch in batches:
        c = batch.column(0).to_numpy()
        at = np.searchsorted(GRID, c, side="right") - 1
        kinds += np.bincount(at, minlength=len(GRID))
        np.add.at(total, at, c)
    at = np.flatnonzero(kinds)
    yield pa.RecordBatch.from_arrays(
        [pa.array(at.astype(np.int32)), pa.array(kinds[at]), pa.array(total[at])], names=["at", "kinds", "total"]
    )


def _sizes(counts: DataFrame, head: int) -> tuple[int, int, int]:
    """Over (token, c): the sum of the counts, the number of tokens, and the
    least count of ``GRID`` that at most ``head`` tokens reach."""
    steps = counts.select("c").mapInArrow(_reach, "at int, kinds long, total long").groupBy("at")
    found = steps.agg(F.sum("kinds").alias("kinds"), F.sum("total").alias("total")).collect()  # one row a step of the grid
    kinds = np.zeros(len(GRID), np.int64)
    for r in found:
        kinds[r["at"]] = r["kinds"]
    reach = np.cumsum(kinds[::-1])[::-1]
    return sum(r["total"] for r in found), int(kinds.sum()), int(GRID[np.flatnonzero(reach <= head)[0]])


def _tail_sums(shortlist: list[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, kinds = np.zeros(gru.TAIL, np.int64), np.zeros(gru.TAIL, np.int64)
        among = pa.array(shortlist, pa.binary())
        for batch in batches:
            tail = pc.invert(pc.is_in(batch.column(0), value_set=among))
            k = _tail_codes(_as_strings(batch.column(0).filter(tail))) - gru.SHORTLIST
            np.add.at(total, k, batch.column(1).filter(tail).to_numpy())
            kinds += np.bincount(k, minlength=gru.TAIL)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(gru.TAIL, dtype=np.int32)), pa.array(total), pa.array(kinds)], names=["k", "total", "kinds"]
        )

    return run


class Vocabulary:
    """What the tasks know of the corpus: the head's counts and the totals."""

    def __init__(self, n_docs: int, n: int, v: int, tokens: list[bytes], counts: list[int], short: int, tails):
        self.n, self.v, self.short = n, v, short
        self.tokens, self.counts, self.end_count = tokens, counts, n_docs
        self.tail_total, self.tail_kinds = tails


class Codes:
    """The shared vocabulary as lookups: a row for the end (0), one for each
    token of the head, with its ``code`` for the network and ``up``, the log10
    of its smoothed count."""

    def __init__(self, vocabulary: Vocabulary):
        v = self.vocabulary = vocabulary
        self.base_down = np.log10(v.n + 0.5 * (v.v + 1))
        self.tail_down = np.log10(v.tail_total + 0.5 * (v.tail_kinds + 1))
        self.tokens = pa.array(v.tokens, pa.large_binary())
        self.code = np.arange(len(v.tokens) + 1).astype(CODE)
        self.code[v.short + 1 :] = _tail_codes(_as_strings(self.tokens[v.short :]))
        self.up = np.log10(np.array([v.end_count, *v.counts], float) + 0.5)

    @classmethod
    def of(cls, shared, key: str) -> "Codes":
        """The lookups of a broadcast vocabulary, built once per worker."""
        if _kept.get("key") != key:
            _kept.clear()
            _kept["key"], _kept["codes"] = key, cls(shared.value)
        return _kept["codes"]

    def of_texts(self, sizes: np.ndarray, tokens: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of texts of ``sizes`` tokens, each followed by its end: codes, their
        ``up`` (0 for a token below the head), and the places among ``tokens``
        of those below the head."""
        found = pc.index_in(tokens.cast(pa.large_binary()), value_set=self.tokens)
        rows = pc.fill_null(found, -1).to_numpy() + 1
        below = np.flatnonzero(rows == 0)
        place = np.arange(len(rows), dtype=np.int32)
        place += np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        code = np.full(len(rows) + len(sizes), gru.END, CODE)
        up = np.full(len(code), self.up[0])
        code[place], up[place] = self.code[rows], self.up[rows]
        code[place[below]] = _tail_codes(tokens.take(pa.array(below)))
        up[place[below]] = 0.0
        return code, up, below

    def struct(self, sizes: np.ndarray, tokens: pa.Array) -> pa.Array:
        """What ``_coded`` returns of texts of ``sizes`` tokens."""
        code, up, below = self.of_texts(sizes, tokens)
        n, tail = sizes + 1, code >= gru.SHORTLIST
        to = _offsets(n)
        tail_to = _offsets(tail)[to]
        rare_to = np.searchsorted(below, _offsets(sizes))
        known = n - np.diff(rare_to) - (self.vocabulary.end_count == 0)
        tail_up, tail_down = up[tail], self.tail_down[code[tail] - gru.SHORTLIST]
        base = _sums(up, to) - n * self.base_down
        tails = _sums(tail_up, tail_to) - _sums(tail_down, tail_to)
        packed = pa.Array.from_buffers(
            pa.binary(), len(n), [None, pa.py_buffer((to * CODE.itemsize).astype(np.int32)), pa.py_buffer(code)]
        )
        rare = pa.ListArray.from_arrays(pa.array(rare_to, pa.int32()), tokens.take(pa.array(below)).cast(pa.binary()))
        return pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base), pa.array(tails), packed, rare],
            names=["n_tokens", "n_known", "base", "tail", "codes", "rare"],
        )

    def of_text(self, tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same of one text."""
        return self.of_texts(np.array([len(tokens)]), _as_strings(pa.array(tokens, pa.large_binary())))


def vocabulary(train: DataFrame, head: int = HEAD) -> tuple[Vocabulary, DataFrame]:
    """From ``train`` (text): the shared vocabulary, and the written counts of
    the tokens below the head (token, c)."""
    counts = token_counts(train)
    n_docs = train.count()
    n, kinds, least = _sizes(counts, head)
    # At most ``head`` rows.
    top = counts.where(F.col("c") >= least).toArrow()
    pairs = sorted(zip(top.column("token").to_pylist(), top.column("c").to_pylist()), key=lambda x: (-x[1], x[0]))
    short = min(len(pairs), gru.SHORTLIST - 1)
    tails = (
        counts.mapInArrow(_tail_sums([t for t, _ in pairs[:short]]), "k int, total long, kinds long")
        .groupBy("k")
        .agg(F.sum("total").alias("total"), F.sum("kinds").alias("kinds"))
        .collect()  # one row a tail class
    )
    total, sorts = np.zeros(gru.TAIL), np.zeros(gru.TAIL)
    for r in tails:
        total[r["k"]], sorts[r["k"]] = r["total"], r["kinds"]
    known = Vocabulary(
        n_docs,
        n + n_docs,
        kinds + (n_docs > 0),
        [t for t, _ in pairs],
        [c for _, c in pairs],
        short,
        (total, sorts),
    )
    return known, counts.where(F.col("c") < least)


def _train(parameters, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = gru.Trainer(gru.unflat(parameters.value), rate)
        held, size = [], 0
        for batch in batches:
            for packed in batch.column(0):
                held.append(_unpacked(packed))
                size += len(held[-1])
                if size >= gru.CHUNK // 2:
                    trainer.learn(held)
                    held, size = [], 0
        if held:
            trainer.learn(held)
        if trainer.tokens:
            yield _weighted(gru.flat(trainer.p), trainer.tokens)

    return run


def _unpacked(packed: pa.Scalar) -> np.ndarray:
    return np.frombuffer(packed.as_py(), CODE).astype(np.int32)


def _weighted(p: np.ndarray, weight: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([p.astype(np.float32).tobytes()], pa.binary()), pa.array([weight], pa.int64())], names=["p", "weight"]
    )


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, weight = 0.0, 0
    for batch in batches:
        for p, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            total, weight = total + np.frombuffer(p, np.float32).astype(np.float64) * w, weight + w
    if weight:
        yield _weighted(total / weight, weight)


def trained(rows: DataFrame, known: Vocabulary, rounds: int = ROUNDS) -> np.ndarray:
    """Parameters fitted to ``rows`` (place, codes)."""
    spark = rows.sparkSession
    short = np.array([known.end_count, *known.counts[: known.short]], float)
    p = gru.flat(gru.initial(short, known.tail_total))
    for i in range(rounds):
        mine = rows.where(F.pmod(F.xxhash64("place"), F.lit(rounds)) == i).select("codes")
        parameters = spark.sparkContext.broadcast(p)
        rate = RATES[min(i, len(RATES) - 1)]
        local = materialize(mine.mapInArrow(_train(parameters, rate), "p binary, weight long"), "lm-local")
        parts = local.count()
        while parts > 1:
            parts = -(-parts // FAN_IN)
            local = materialize(local.repartition(parts).mapInArrow(_average, "p binary, weight long"), "lm-average")
        row = local.first()
        if row is not None:
            p = np.frombuffer(bytes(row["p"]), np.float32)
    return p


def _coded(shared, key: str):
    """Arrow UDF: a text's codes for the network, the parts of its scores that
    the shared vocabulary settles, and the tokens still to be joined."""

    @F.arrow_udf("struct<n_tokens:bigint,n_known:bigint,base:double,tail:double,codes:binary,rare:array<binary>>")
    def run(column: pa.Array) -> pa.Array:
        codes = Codes.of(shared, key)
        parts = [codes.struct(*tokens_of(texts)) for texts in _slices(column, CODE_SLICE)]
        out = pa.concat_arrays(parts) if parts else codes.struct(*tokens_of(column))
        del parts
        _release()
        return out

    return run


def _chunks(texts: Iterator[np.ndarray], most: int) -> Iterator[list[np.ndarray]]:
    """Runs of at most ``most`` tokens (a longer text stands alone)."""
    held, size = [], 0
    for t in texts:
        if held and size + len(t) > most:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def _likelihood(parameters):
    """Arrow UDF: log10 likelihood of packed codes."""

    @F.arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        p = gru.unflat(parameters.value)
        out = []
        for held in _chunks(map(_unpacked, column), gru.CHUNK):
            out += gru.score(p, held).tolist()
        return pa.array(np.array(out) / np.log(10), pa.float64())

    return run


def score_texts(
    docs: DataFrame,
    train: Column,
    text_col: str = "text",
    keep: list[str] | None = None,
    head: int = HEAD,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Every row of ``docs`` (columns ``keep``, default all) followed by
    ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``,
    learned from the rows for which ``train`` is true.  Names the input uses
    already get underscores."""
    spark = docs.sparkSession
    ship_package(spark)
    kept = list(docs.columns if keep is None else keep)
    text = F.col(text_col).cast("string")
    learn = F.coalesce(train, F.lit(False))
    known, below = vocabulary(docs.where(learn).select(text.alias("text")), head)
    shared = spark.sparkContext.broadcast(known)
    key = f"{spark.sparkContext.applicationId}-{id(known)}-{known.n}-{known.v}"
    coded = docs.select(F.struct(*kept).alias("row"), learn.alias("learn"), _coded(shared, key)(text).alias("s"))
    # Texts become codes once; training and scoring read those.
    rows = materialize(coded.select(F.monotonically_increasing_id().alias("place"), "row", "learn", "s.*"), "lm-rows")
    parameters = spark.sparkContext.broadcast(trained(rows.where("learn"), known, rounds))
    scored = rows.select(
        "place", "row", "n_tokens", "n_known", "base", (F.col("tail") + _likelihood(parameters)(F.col("codes"))).alias("score")
    )
    # Tokens below the head: their counts come by a join.
    up = F.log10(F.coalesce(F.col("c"), F.lit(0)) + F.lit(0.5))
    joined = (
        rows.select("place", F.explode("rare").alias("token"))
        .join(below, "token", "left")
        .groupBy(F.col("place").alias("of_place"))
        .agg(F.sum(up).alias("up"), F.count("c").alias("found"))
    )
    add = lambda c: F.col(c) + F.coalesce("up", F.lit(0.0))
    added = {
        "n_tokens": F.col("n_tokens"),
        "n_known": F.col("n_known") + F.coalesce("found", F.lit(0)),
        "train_tokens": F.lit(known.n).cast("long"),
        "base_score": add("base"),
        "score": add("score"),
    }
    return scored.join(joined, F.col("place") == F.col("of_place"), "left").select(
        *[F.col("row")[c].alias(c) for c in kept], *[c.alias(fresh(kept, name)) for name, c in added.items()]
    )
