"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance are found without forming it.  A
block of vectors ``Q`` is multiplied by the covariance in one distributed pass
over the rows, ``Xᵀ(XQ)/n`` with ``X`` centred before it is multiplied: every
task adds up its rows, partial sums are added in a tree, and only matrices of
(dimensions x block) reach the driver.  The three-term recurrence of Chebyshev
polynomials, one pass a degree, damps the unwanted part of the spectrum (from
0 to the least Ritz value of the block) and lets the rest grow; QR makes the
block orthonormal again, Rayleigh-Ritz rotates it to eigenvectors.  Two guard
columns are drawn anew every round, so a direction that the start lacked
enters.  The block grows when rounds do not converge, up to all dimensions.

The result is certified by the residuals ``|Vv - ev|`` of the wanted pairs:
they are at most ``TOLERANCE`` times the largest eigenvalue, or have stopped
falling below ``ROUNDING`` times it.  By Weyl's bound every eigenvalue is as
exact.  An iteration that reaches neither raises ``ArithmeticError``.

Entries are whole numbers, ``floor(scale * c) + offset``, so the sums and the
deviations are exact and ``(n*x - S) / n`` is centred without cancellation.

Defined results: a vector that is NULL or holds a NULL or non-finite entry, or
one of 2**53 and more after scaling, takes no part; one that is shorter than
the longest counts as followed by zeros; repeated rows and rows of one id each
count; components whose eigenvalue is not above rounding are not returned (one
vector, or equal ones, have none); a deviation beyond a long is NULL; extra
columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.common import ship_package
from tallymart.session import materialize

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
GUARD, FRESH = 16, 2
DEGREE, ROUNDS = 10, 60
TOLERANCE, ROUNDING = 2e-14, 1e-11
SEED = 42
#: Vectors in a row of the written table, at most, and entries.
CHUNK, ENTRIES = 4096, 1 << 22
#: Partial sums that the driver adds.
FAN_IN = 64
_BOUND = 2.0**53
_LONG = 2**63 - 1

_CHUNKS = "ids binary, no_id binary, x binary"


@dataclass(frozen=True)
class Whitening:
    """What was fitted: ``vectors`` (dimensions x components) with their
    eigenvalues, exact sums, and what certifies them."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residuals: np.ndarray = field(default_factory=lambda: np.empty(0))
    passes: int = 0

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace


def _whole(vectors: pa.Array, width: int, scale: int, offset: int) -> np.ndarray:
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(vectors), width))
    out[np.arange(width) < sizes[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return np.floor(out * scale).astype(np.int64) + offset


@dataclass(frozen=True)
class Chunks:
    """A written table of packed matrices, their width, and whether so many
    tasks read it that partial sums need a level of their own."""

    table: DataFrame
    width: int
    wide: bool


def chunks_of(vectors: DataFrame, id_col: str, vector_col: str, scale: int = SCALE, offset: int = OFFSET) -> Chunks:
    """The usable vectors as packed matrices of whole numbers."""
    ship_package(vectors.sparkSession)
    v = F.col("vector")
    usable = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * scale < _BOUND))
    given = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = given.where(usable)
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    step = max(1, min(CHUNK, ENTRIES // max(1, width)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                ids = part.column("id")
                values = [
                    ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
                    ids.is_null().to_numpy(zero_copy_only=False).tobytes(),
                    _whole(part.column("vector"), width, scale, offset).astype("<i8").tobytes(),
                ]
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in values], names=["ids", "no_id", "x"])

    table = materialize(rows.mapInArrow(run, _CHUNKS), "whiten-chunks")
    return Chunks(table, width, table.rdd.getNumPartitions() > FAN_IN)


def _matrices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for ids, x in zip(batch.column("ids"), batch.column("x")):
            n = len(ids.as_buffer()) // 8
            yield np.frombuffer(x.as_buffer(), "<i8").reshape(n, width)


def _added(chunks: Chunks, part: Callable[[np.ndarray], list]):
    """The sums of ``part(matrix)`` (a list of arrays) over all chunks, or
    None where there are none: added in tasks, in a level of sums where there
    are many tasks, and then here."""
    width = chunks.width

    def packed(value) -> Iterator[pa.RecordBatch]:
        if value is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(value)], pa.binary())], names=["sums"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from packed(_sum(map(part, _matrices(batches, width))))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from packed(_sum(pickle.loads(b.as_py()) for batch in batches for b in batch.column("sums")))

    sums = chunks.table.select("ids", "x").mapInArrow(first, "sums binary")
    if chunks.wide:
        sums = sums.repartition(FAN_IN).mapInArrow(again, "sums binary")
    return _sum(pickle.loads(r[0]) for r in sums.collect())


def _sum(payloads):
    out = None
    for p in payloads:
        out = list(p) if out is None else [a + b for a, b in zip(out, p)]
    return out


def _differences(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n*x - S``, exact: in 64 bits where that fits, else as objects."""
    most = int(np.abs(x).max(initial=0))
    if n * most + max(map(abs, sums), default=0) <= _LONG:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (_differences(x, n, sums) / n).astype(float)


def fit(chunks: Chunks, components: int = COMPONENTS, tolerance: float = TOLERANCE) -> Whitening:
    """The leading components of the covariance of all vectors of ``chunks``."""
    width = chunks.width

    def counted(x):
        wide = x.astype(object) if np.abs(x).max(initial=0) * len(x) >= _LONG else x
        return [len(x), wide.sum(axis=0).astype(object)]

    found = _added(chunks, counted)
    if found is None or not width:
        return Whitening(found[0] if found else 0, [], np.zeros((width, 0)), np.zeros(0), 0.0)
    n, sums = int(found[0]), [int(s) for s in found[1]]
    passes = 0

    def product(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def part(x):
            c = _centred(x, n, sums)
            return [c.T @ (c @ q)]

        return _added(chunks, part)[0] / n

    def squares(x):
        c = _centred(x, n, sums)
        return [(c * c).sum()]

    trace = float(_added(chunks, squares)[0]) / n
    if not trace > 0:
        return Whitening(n, sums, np.zeros((width, 0)), np.zeros(0), trace)
    rng = np.random.default_rng(SEED)
    k, block = min(components, width), min(width, components + GUARD)
    q = np.linalg.qr(rng.normal(size=(width, block)))[0]
    last, stalled = np.inf, 0
    for done in range(ROUNDS):
        aq = product(q)
        values, turn = np.linalg.eigh((q.T @ aq + aq.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, aq = q @ turn, aq @ turn
        residuals = np.linalg.norm(aq - q * values, axis=0)[:k]
        worst = residuals.max() / values[0]
        stalled = stalled + 1 if worst > last / 4 else 0
        last = min(last, worst)
        if worst <= tolerance or (stalled >= 2 and worst <= ROUNDING):
            kept = values[:k] > width * np.finfo(float).eps * values[0] * 16
            at = np.abs(q[:, :k]).argmax(axis=0)
            signed = q[:, :k] * np.where(q[at, np.arange(k)] < 0, -1.0, 1.0)
            return Whitening(n, sums, signed[:, kept], values[:k][kept], trace, residuals[kept], passes)
        if done % 4 == 3:
            block = min(width, 2 * block)
        held = q.shape[1] - min(FRESH, q.shape[1] - k)
        q = np.linalg.qr(np.column_stack([q[:, :held], rng.normal(size=(width, block - held))]))[0]
        if block < width:  # a block of all dimensions holds every eigenvector
            low = max(values[held - 1], np.finfo(float).eps * values[0])
            q = np.linalg.qr(_filtered(product, q, low, values[0]))[0]
    raise ArithmeticError(f"residuals of {worst:.1e} after {ROUNDS} rounds")


def _filtered(product, q: np.ndarray, low: float, high: float) -> np.ndarray:
    """Chebyshev polynomial of the covariance that is small on [0, low],
    scaled to about 1 at ``high``, times ``q``."""
    half = low / 2
    ratio = half / (high - half)
    scale, y = ratio, (product(q) - half * q) * (ratio / half)
    before = q
    for _ in range(DEGREE - 1):
        new = 1 / (2 / ratio - scale)
        before, y = y, (product(y) - half * y) * (2 * new / half) - (scale * new) * before
        scale = new
    return y


def identity_error(chunks: Chunks, model: Whitening) -> float:
    """Largest entry of |covariance of the whitened rows - identity|."""
    if not model.values.size:
        return 0.0
    turn = model.vectors / np.sqrt(model.values)

    def part(x):
        w = _centred(x, model.n, model.sums) @ turn
        return [w.sum(axis=0), w.T @ w]

    total, squares = _added(chunks, part)
    mean = total / model.n
    return float(np.abs(squares / model.n - np.outer(mean, mean) - np.eye(len(mean))).max())


def apply(chunks: Chunks, model: Whitening) -> DataFrame:
    """Every vector of ``chunks``: id, deviation, whitened (an array)."""
    turn, width = model.vectors / np.sqrt(model.values), chunks.width

    def deviations(x):
        d = _differences(x, model.n, model.sums)
        if d.dtype != object and float(np.abs(d).max(initial=0)) ** 2 * max(1, width) < _LONG:
            return (d * d).sum(axis=1).tolist()
        return [v if v <= _LONG else None for v in (sum(int(a) ** 2 for a in row) for row in d)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                ids = np.frombuffer(one.column("ids")[0].as_buffer(), "<i8")
                no_id = np.frombuffer(one.column("no_id")[0].as_buffer(), bool)
                x = next(_matrices(iter([one]), width))
                w = _centred(x, model.n, model.sums) @ turn
                ends = pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64(), mask=no_id),
                        pa.array(deviations(x), pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(w.ravel(), pa.float64())),
                    ],
                    names=["id", "deviation", "whitened"],
                )

    return chunks.table.mapInArrow(run, "id long, deviation long, whitened array<double>")


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> tuple[DataFrame, Whitening, float]:
    """Whitened rows (id, deviation, whitened), what was fitted, and the error
    of the covariance of all whitened rows against the identity."""
    chunks = chunks_of(vectors, id_col, vector_col)
    model = fit(chunks, components)
    return apply(chunks, model), model, identity_error(chunks, model)
