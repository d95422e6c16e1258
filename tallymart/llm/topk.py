"""Exact top-k search by integer inner product, block at a time.

Vectors are ordered so that neighbours are alike: by the nearest of some
centroids and the product with it.  That order is cut into shards (rows of a
written table) and every shard into blocks, ranges of ``BLOCK`` documents.  A
block has a forward index, its vectors as integers, and for every dimension
(a term) its greatest and least value.  A query's bound on a block is the sum
over terms of its weight times the greatest value, or the least where the
weight is negative.  A query scores blocks from the highest bound down, until
the bound of the next falls below its k-th score so far; a bound equal to that
score is still scored, since ties go to the smaller id.  Blocks are taken in
waves that double (1, 1, 2, 4, ...), so all queries that want a block in a
wave are scored against it by one product of matrices.

First every shard answers the queries among its own rows.  Their k-th scores
go with them to all other shards as the threshold, which skip whatever cannot
reach it.  The centroids are fitted on a bounded sample (``SAMPLE`` rows); they
decide how much is skipped, never what is found.

Scores are exact: products are added in double precision where all sums stay
below 2**53, otherwise as Python integers.

Defined results: a vector that is NULL or holds a NULL or non-finite component
takes no part; one that is shorter than the longest counts as followed by
zeros (an empty one is all zeros); every other row is a candidate, also of a
query with the same id; a row without id can be found (its id is NULL and comes
last among ties) but asks nothing; queries with fewer than ``k`` candidates get
them all; scores are ranked up to 38 digits and returned as longs, larger ones
as the largest long; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.common import ship_package
from tallymart.llm.meet import meet
from tallymart.session import materialize

K = 5
SCALE = 256
SHARD = 16_384
BLOCK = 64
QUERY_BLOCK = 1024
#: Scores that a search holds before it drops all but the first k of a query.
HELD = 1 << 20
#: Rows that the centroids are fitted on, at most, and their number.
SAMPLE, CENTROIDS = 16_384, 256
SEED = 42
_EXACT = 2.0**53
_NULL_ID = 2**63 - 1
_LONG = 2**63 - 1
_DIGITS = 10**38 - 1

_HITS = "query_row long, query_id long, score decimal(38,0), vec_id long"
_SHARD = "shard long, width int, kind string, ids binary, no_id binary, rows binary, asks binary, x binary, upper binary, lower binary"
_ASKED = "shard long, width int, rows binary, ids binary, x binary, theta binary, hits array<struct<query_row:long,query_id:long,score:decimal(38,0),vec_id:long>>"


def _tight(x: np.ndarray) -> tuple[str, bytes]:
    """Whole numbers in doubles as the narrowest kind that holds them."""
    most = np.abs(x).max(initial=0)
    kind = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<f8"
    return kind, x.astype(kind).tobytes()


class Shard:
    """The vectors of a shard as whole numbers in doubles, in block order."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, no_id: np.ndarray, bounds=None):
        self.x, self.ids, self.no_id = x, ids, no_id
        self.starts = np.arange(0, len(x), BLOCK)
        if bounds is None:
            bounds = np.maximum.reduceat(x, self.starts, axis=0), np.minimum.reduceat(x, self.starts, axis=0)
        self.upper, self.lower = bounds
        self.most = float(max(self.upper.max(initial=0), -self.lower.min(initial=0)))

    def search(self, q: np.ndarray, theta: np.ndarray, k: int, own: np.ndarray | None = None):
        """Places and scores of the best ``k`` of every query that reach its
        threshold: (query, place, score) arrays.  ``own``: places left out."""
        if not len(q) or not len(self.x):
            return np.empty(0, int), np.empty(0, int), []
        if np.abs(q).max(initial=0) * self.most * q.shape[1] >= _EXACT:
            return self._search_whole(q, theta, k, own)
        bound = np.maximum(q, 0) @ self.upper.T + np.minimum(q, 0) @ self.lower.T
        order = np.argsort(-bound, axis=1, kind="stable")
        rows = np.arange(len(q))
        kth = theta.copy()
        best = (np.empty(0, int), np.empty(0, int), np.empty(0))
        done, size = 0, 1

        def kept(parts):
            """The first k of what was found so far; raises the k-th scores."""
            found = tuple(np.concatenate(part) for part in zip(*parts))
            if own is not None:
                other = found[1] != own[found[0]]
                found = tuple(part[other] for part in found)
            found, full = self._first(*found, k)
            kth[full[0]] = np.maximum(kth[full[0]], full[1])
            return found

        while done < order.shape[1]:
            wave = order[:, done : done + size]
            wanted = bound[rows[:, None], wave] >= kth[:, None]
            if not wanted.any():
                break
            asks = np.zeros(bound.shape, bool)
            asks[rows[:, None], wave] = wanted
            new, held = [best], 0
            for b in np.flatnonzero(asks.any(axis=0)).tolist():
                who = np.flatnonzero(asks[:, b])
                at = self.starts[b]
                score = q[who] @ self.x[at : at + BLOCK].T
                r, c = np.nonzero(score >= kth[who][:, None])
                new.append((who[r], at + c, score[r, c]))
                held += len(r)
                if held > HELD:  # many equal scores
                    new, held = [kept(new)], 0
            best = kept(new)
            done, size = done + size, max(1, done + size)
        return best[0], best[1], best[2].astype(np.int64).tolist()

    def _first(self, query, place, score, k):
        """The first ``k`` of every query, and the k-th scores there are."""
        order = np.lexsort((place, self.ids[place], self.no_id[place], -score, query))
        query, place, score = query[order], place[order], score[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query, side="left")
        some, last = rank < k, rank == k - 1
        return (query[some], place[some], score[some]), (query[last], score[last])

    def _search_whole(self, q, theta, k, own):
        """Without bounds, by whole numbers of any size."""
        out = [], [], []
        for i in range(len(q)):
            ask = [int(v) for v in q[i]]
            scores = [sum(a * int(v) for a, v in zip(ask, row)) for row in self.x]
            places = [p for p in range(len(scores)) if (own is None or p != own[i]) and scores[p] >= theta[i]]
            places.sort(key=lambda p: (-scores[p], self.no_id[p], self.ids[p], p))
            for p in places[:k]:
                out[0].append(i)
                out[1].append(p)
                out[2].append(scores[p])
        return np.array(out[0], int), np.array(out[1], int), out[2]


def usable(vectors: DataFrame, id_col: str, vector_col: str, scale: int = 1) -> DataFrame:
    """(row, id, vector) of the rows that take part, numbered; written once,
    so numbers hold."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * scale < float("inf")))
    given = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = given.where(v.isNotNull() & finite)
    return materialize(rows.select(F.monotonically_increasing_id().alias("row"), "id", "vector"), "topk-rows")


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Lists of doubles as rows, zeros behind the shorter ones."""
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(vectors), width))
    out[np.arange(width) < sizes[:, None]] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


def _centroids(rows: DataFrame, n: int, width: int) -> np.ndarray:
    """Centroids of a hash share of the rows, normed (at most ``SAMPLE``)."""
    share = F.pmod(F.xxhash64("row"), F.lit(1_000_000)) < F.lit(int(min(1.0, SAMPLE / max(n, 1)) * 1_000_000))
    some = rows.where(share).orderBy(F.xxhash64("row")).limit(SAMPLE).select("vector").toArrow()["vector"]
    x = _matrix(some.combine_chunks(), width)
    x = x[np.abs(x).max(axis=1, initial=0) > 0]
    x /= np.maximum(np.abs(x).max(axis=1, keepdims=True, initial=0), 1e-300)  # so that squares stay finite
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    count = min(CENTROIDS, len(x) // 32)
    if count < 2:
        return np.zeros((1, width))
    c = x[np.random.default_rng(SEED).choice(len(x), count, replace=False)]
    for _ in range(6):
        near = (x @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(norm > 0, total / np.maximum(norm, 1e-300), c)
    return c


def _placed(rows: DataFrame, centroids: np.ndarray, width: int) -> DataFrame:
    """Rows with the cell of their centroid and the product with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector"), width)
            x /= np.maximum(np.abs(x).max(axis=1, keepdims=True, initial=0), 1e-300)
            s = x @ centroids.T
            cell = s.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(s[np.arange(len(cell)), cell])],
                names=["row", "id", "vector", "asks", "cell", "near"],
            )

    return rows.mapInArrow(run, "row long, id long, vector array<double>, asks boolean, cell int, near double")


def _sharded(width: int, shard: int, scale: int):
    def emit(part: int, seq: int, some: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(some).combine_chunks()
        column = lambda name: rows[name].combine_chunks()
        x = np.floor(_matrix(column("vector"), width) * scale)
        held = Shard(x, None, None)
        kind, packed = _tight(x)
        no_id = column("id").is_null().to_numpy(zero_copy_only=False)
        values = [
            part << 20 | seq, width, kind,
            column("id").fill_null(_NULL_ID).to_numpy(zero_copy_only=False).astype("<i8").tobytes(), no_id.tobytes(),
            column("row").to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
            np.flatnonzero(column("asks").to_numpy(zero_copy_only=False)).astype("<i4").tobytes(),
            packed, held.upper.astype("<f8").tobytes(), held.lower.astype("<f8").tobytes(),
        ]
        kinds = [pa.int64(), pa.int32(), pa.string()] + [pa.binary()] * 7
        names = [c.split()[0] for c in _SHARD.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, some, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                take = min(shard - size, batch.num_rows - at)
                some.append(batch.slice(at, take))
                size, at = size + take, at + take
                if size == shard:
                    yield emit(part, seq, some)
                    seq, some, size = seq + 1, [], 0
        if size:
            yield emit(part, seq, some)

    return run


def build_index(rows: DataFrame, asks: Column, shard: int = SHARD, scale: int = SCALE) -> DataFrame:
    """One written row per shard: ids, whole-number vectors, bounds of blocks,
    places of the queries (rows where ``asks`` over ``id`` holds)."""
    ship_package(rows.sparkSession)
    n, width = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    marked = rows.withColumn("asks", F.coalesce(asks, F.lit(False)))
    placed = materialize(_placed(marked, _centroids(rows, n, width), width), "topk-placed")
    # A cell that holds a third of all rows is cut by the row number.
    spread = placed.repartitionByRange(max(1, -(-n // shard)), "cell", "near", "row").sortWithinPartitions("cell", "near", "row")
    return materialize(spread.drop("cell", "near").mapInArrow(_sharded(width, shard, scale), _SHARD), "topk-index")


def _loaded(row: dict) -> tuple[Shard, np.ndarray, np.ndarray]:
    ids, no_id = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["no_id"], bool)
    shape = (-1, row["width"]) if row["width"] else (len(ids), 0)
    x = np.frombuffer(row["x"], row["kind"]).astype(float).reshape(shape)
    blocks = -(-len(ids) // BLOCK)
    bounds = [np.frombuffer(row[c], "<f8").reshape(blocks, row["width"]) for c in ("upper", "lower")]
    return Shard(x, ids, no_id, bounds), np.frombuffer(row["rows"], "<i8"), np.frombuffer(row["asks"], "<i4")


def _hits(shard: Shard, rows: np.ndarray, ids: np.ndarray, found) -> list[pa.Array]:
    query, place, score = found
    return [
        pa.array(rows[query], pa.int64()),
        pa.array(ids[query], pa.int64()),
        pa.array([Decimal(max(-_DIGITS, min(_DIGITS, s))) for s in score], pa.decimal128(38, 0)),
        pa.array(shard.ids[place], pa.int64(), mask=shard.no_id[place]),
    ]


def _at_home(k: int):
    """Every shard answers its own queries, in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                shard, rows, asks = _loaded(row)
                for at in range(0, len(asks), QUERY_BLOCK):
                    own = asks[at : at + QUERY_BLOCK]
                    q = shard.x[own]
                    found = shard.search(q, np.full(len(q), -np.inf), k, own)
                    theta = np.full(len(q), -np.inf)
                    for j in np.flatnonzero(np.bincount(found[0], minlength=len(q)) == k).tolist():
                        # Rounded down, so that nothing that ties is lost.
                        lowest = found[2][np.searchsorted(found[0], j, side="right") - 1]
                        theta[j] = np.nextafter(float(lowest), -np.inf) if abs(lowest) >= _EXACT else lowest
                    hits = pa.StructArray.from_arrays(
                        _hits(shard, rows[own], shard.ids[own], found), ["query_row", "query_id", "score", "vec_id"]
                    )
                    values = [row["shard"], row["width"]]
                    values += [a.tobytes() for a in (rows[own], shard.ids[own], q, theta)]
                    kinds = [pa.int64(), pa.int32()] + [pa.binary()] * 4
                    yield pa.RecordBatch.from_arrays(
                        [*[pa.array([v], t) for v, t in zip(values, kinds)], pa.ListArray.from_arrays(pa.array([0, len(hits)], pa.int32()), hits)],
                        names=["shard", "width", "rows", "ids", "x", "theta", "hits"],
                    )

    return run


def _ask(k: int):
    def ask(held, block: dict) -> pa.RecordBatch:
        shard = held[0]
        rows, ids = np.frombuffer(block["rows"], "<i8"), np.frombuffer(block["ids"], "<i8")
        q = np.frombuffer(block["x"], "<f8").reshape(len(rows), block["width"])
        found = shard.search(q, np.frombuffer(block["theta"], "<f8"), k)
        return pa.RecordBatch.from_arrays(_hits(shard, rows, ids, found), names=["query_row", "query_id", "score", "vec_id"])

    return ask


def top_k(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    shard: int = SHARD,
    scale: int = SCALE,
) -> DataFrame:
    """The ``k`` highest scores of every row for which ``is_query`` (an
    expression over ``id``) holds: query_id, rank, vec_id, score."""
    rows = usable(vectors, id_col, vector_col, scale)
    index = build_index(rows, is_query & F.col("id").isNotNull(), shard, scale)
    home = materialize(index.mapInArrow(_at_home(k), _ASKED), "topk-home")
    numbers = [r[0] for r in index.select("shard").collect()]  # one number per shard
    others = F.array_except(F.lit(numbers) if numbers else F.array().cast("array<bigint>"), F.array("shard"))
    away = meet(index, home.drop("hits"), others, _loaded, _ask(k), _HITS, len(numbers))
    hits = home.select(F.inline("hits")).unionByName(away)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    limit = F.lit(_LONG).cast("decimal(38,0)")
    score = F.greatest(F.least(F.col("score"), limit), -limit).cast("long")
    return ranked.select("query_id", "rank", "vec_id", score.alias("score"))
