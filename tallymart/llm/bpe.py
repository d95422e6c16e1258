"""Byte-level BPE encoding and decoding by monoid tree reduction.

A piece of text (one match of the split pattern) is cut into halves down to
leaves, leaves are merged by rank, and encodings are joined upwards.  The
joined encoding of two neighbours differs from their concatenation only near
the seam: the last tokens of the left and the first of the right are encoded
anew as one window.  The tokens outside are proven final by pairs: a token
sequence is the BPE encoding of its bytes exactly if each adjacent pair of
tokens is the encoding of its own bytes (no merge of lower rank could ever
cross a seam that it does not cross in the pair).  Left and right are valid
encodings, the window is one, so two pairs remain to be checked, one at each
end of the window; an end that fails doubles its side and the window is
encoded again.  Joining is associative with the empty encoding as its unit.
Decoding concatenates up the same kind of tree.

Every distinct piece is encoded once per worker while it stays in a bounded
table; pieces that are a token as a whole are that token, as in the tiktoken
library.  Texts are looked up in longer units where that is safe: the usual
split patterns attach a single space to the character that follows it, so a
space before a non-space character always starts a piece.

Defined results: a NULL or empty text has no ids; ids that the vocabulary
lacks cannot be decoded and fail loudly; repeated rows are encoded each.
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.llm.common import fresh, ship_package

LEAF = 24
#: Bytes that a worker's memory of space-free units, and of other pieces,
#: may take; about ``OVERHEAD`` for an entry besides its characters and ids.
UNIT_BYTES, PIECE_BYTES, OVERHEAD = 160 << 20, 12 << 20, 200
_SLICE = 256
_LEAVES = 4096
_NO_RANK = 1 << 62
_LAST = np.int32(2**31 - 1)
_MARKS = frozenset(".,;:!?)")
_BYTE = [bytes([c]) for c in range(256)]

#: A space that is not followed by a non-space character.
_OPEN_SPACE = re.compile(r" (?:\s|\Z)").search

_models: dict[tuple[str, str, int], "Bpe"] = {}


def _unicode_space(pattern: str) -> str:
    return pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


class Memo:
    """A memory of ``compute`` (a list of keys to their values), bounded in
    bytes: a generation that has taken half of them becomes the old one, from
    which what is still in use moves back.  A call may hold more, what it asks
    for, but that is not kept beyond the next one."""

    def __init__(self, compute, limit: int):
        self.compute, self.half = compute, limit // 2
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def having(self, keys: set[str]) -> dict[str, bytes]:
        """The memory with all of ``keys`` in it."""
        if new := keys.difference(self.young):
            if self.held > self.half:
                self.old = self.young if self.held <= 2 * self.half else {}
                self.young, self.held, new = {}, 0, keys
            young, old = self.young, self.old
            back = old.keys() & new
            for k in back:
                young[k] = old[k]
            fresh = [k for k in new if k not in young]
            found = self.compute(fresh)
            young.update(zip(fresh, found))
            self.held += OVERHEAD * len(new) + sum(map(len, new)) + sum(map(len, found))
        return self.young


class Bpe:
    """A rank vocabulary and its split pattern, in which a space followed by
    a non-space character must start a piece.  White space in it means
    Unicode's property, as in the tiktoken library."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf: int = LEAF, memory: int | None = None):
        self.ranks, self.leaf = ranks, leaf
        self.bytes_of = {i: b for b, i in ranks.items()}
        # What two tokens in a row merge into: every cut of every token.
        self.pair = {
            ranks[t[:i]] << 20 | ranks[t[i:]]: r
            for t, r in ranks.items()
            for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        }
        keys = np.fromiter(self.pair, np.int64, len(self.pair))
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(np.fromiter(self.pair.values(), np.int32, len(keys))[order], _LAST)
        self.byte_id = [ranks[b] for b in _BYTE]
        self.byte_ids = np.array(self.byte_id, np.int32)
        self.first = [ranks.get(a + b, _NO_RANK) for a in _BYTE for b in _BYTE]
        self.firsts = np.minimum(np.array(self.first), _LAST).astype(np.int32)
        self.split = regex.compile(_unicode_space(pattern)).findall
        self.mark_ids = {m: array("I", [ranks[m.encode()]]).tobytes() for m in _MARKS}
        self.table = Memo(self._pieces, min(PIECE_BYTES, memory or PIECE_BYTES))
        self.units = Memo(self._units, memory or UNIT_BYTES)

    @classmethod
    def load(cls, path: str, pattern: str, memory: int | None = None) -> "Bpe":
        """The vocabulary file at ``path``, read once per worker; ``memory``:
        bytes of units to remember (default: ``UNIT_BYTES``)."""
        key = (path, pattern, memory or 0)
        model = _models.get(key)
        if model is None:
            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            model = _models[key] = cls(ranks, pattern, memory=memory)
        return model

    def merged(self, data: bytes) -> list[int]:
        """BPE of ``data`` by merging its bytes: always the adjacent pair of
        the lowest rank, the leftmost of equals."""
        return self._merged_short(data) if len(data) <= 2 * self.leaf else self._merged_long(data)

    def _merged_short(self, data: bytes) -> list[int]:
        get, first = self.pair.get, self.first
        ids = [self.byte_id[c] for c in data]
        pair = [first[a << 8 | b] for a, b in zip(data, data[1:])]
        while pair and (low := min(pair)) != _NO_RANK:
            at = pair.index(low)
            ids[at : at + 2] = [low]
            del pair[at]
            if at < len(pair):
                pair[at] = get(low << 20 | ids[at + 1], _NO_RANK)
            if at:
                pair[at - 1] = get(ids[at - 1] << 20 | low, _NO_RANK)
        return ids

    def leaves(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of many short pieces: each step merges the best pair of
        every piece at once.  Rows are pieces, columns tokens in a row."""
        if not pieces:
            return []
        sizes = np.array([len(p) for p in pieces])
        n, width = len(pieces), int(sizes.max())
        column = np.arange(width, dtype=np.int32)
        data = np.zeros((n, width), np.int32)
        data[column < sizes[:, None]] = np.frombuffer(b"".join(pieces), np.uint8)
        ids, left = self.byte_ids[data], sizes.copy()
        rank = np.full((n, width), _LAST, np.int32)  # of the pair that starts here
        rank[:, :-1] = self.firsts[data[:, :-1] << 8 | data[:, 1:]]
        rank[column >= sizes[:, None] - 1] = _LAST
        rows = np.arange(n)
        while rows.size:
            at = rank[rows].argmin(axis=1)
            low = rank[rows, at]
            more = low != _LAST
            rows, at, low = rows[more], at[more], low[more]
            if not rows.size:
                break
            own = np.arange(len(rows))
            moved = np.minimum(column + (column > at[:, None]), width - 1)
            new = np.take_along_axis(ids[rows], moved, axis=1)
            new[own, at] = low
            left[rows] -= 1
            moved = np.minimum(column + (column >= at[:, None]), width - 1)
            pairs = np.take_along_axis(rank[rows], moved, axis=1)
            pairs[:, -1] = _LAST
            right = at + 1 < left[rows]
            pairs[own, at] = _LAST
            pairs[own[right], at[right]] = self._pair_rank(low[right], new[own[right], at[right] + 1])
            before = at > 0
            pairs[own[before], at[before] - 1] = self._pair_rank(new[own[before], at[before] - 1], low[before])
            ids[rows], rank[rows] = new, pairs
        packed = ids[column < left[:, None]].astype("<u4").tobytes()
        ends = (np.cumsum(left) * 4).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def _pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 20 | b
        place = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[place] == key, self.pair_ranks[place], _LAST)

    def _merged_long(self, data: bytes) -> list[int]:
        """The same with a heap over linked parts, for wide windows."""
        get, n = self.ranks.get, len(data)
        end = list(range(1, n + 1))  # end of the part that starts here, 0 when it is gone
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            if not j or j >= n or end[j] != stop:
                continue  # one of the two has changed since
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := get(data[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            p = before[i]
            if p >= 0 and (r := get(data[p:stop])) is not None:
                heapq.heappush(heap, (r, p, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[data[i : end[i]]])
            i = end[i]
        return out

    def settled(self, left: int, right: int) -> bool:
        """Whether the two tokens are the encoding of their joint bytes."""
        return self.merged(self.bytes_of[left] + self.bytes_of[right]) == [left, right]

    def joined(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of both encodings in a row."""
        if not left or not right:
            return left or right
        a = b = 1
        while True:
            a, b = min(a, len(left)), min(b, len(right))
            window = self.merged(self.decode(left[len(left) - a :] + right[:b]))
            ok_left = a == len(left) or self.settled(left[len(left) - a - 1], window[0])
            ok_right = b == len(right) or self.settled(window[-1], right[b])
            if ok_left and ok_right:
                return left[: len(left) - a] + window + right[b:]
            a, b = (a if ok_left else 2 * a), (b if ok_right else 2 * b)

    def tree(self, data: bytes) -> list[int]:
        """BPE of ``data`` by halves."""
        if len(data) <= self.leaf:
            return self._merged_short(data) if data else []
        half = len(data) // 2
        return self.joined(self.tree(data[:half]), self.tree(data[half:]))

    def piece(self, text: str) -> list[int]:
        data = text.encode()
        whole = self.ranks.get(data)
        return self.tree(data) if whole is None else [whole]

    def _pieces(self, new: list[str]) -> list[bytes]:
        """Packed ids of pieces: short ones together, long ones by the tree."""
        out: list[bytes] = [b""] * len(new)
        short, data = [], [p.encode() for p in new]
        for i, d in enumerate(data):
            if (whole := self.ranks.get(d)) is not None:
                out[i] = array("I", [whole]).tobytes()
            elif len(d) <= self.leaf:
                short.append(i)
            else:
                out[i] = array("I", self.tree(d)).tobytes()
        short.sort(key=lambda i: len(data[i]))  # rows of a step are of like length
        for at in range(0, len(short), _LEAVES):
            some = short[at : at + _LEAVES]
            for i, packed in zip(some, self.leaves([data[i] for i in some])):
                out[i] = packed
        return out

    def _units(self, new: list[str]) -> list[bytes]:
        """Packed ids of space-free strings with a space in front.  Letters
        alone are one piece with it; so is a mark behind them by itself."""
        out: list[bytes] = [b""] * len(new)
        words, at, marked, other = [], [], [], []
        for i, u in enumerate(new):
            if u.isalpha():
                words.append(u)
                at.append(i)
            elif u and u[-1] in _MARKS and u[:-1].isalpha():
                marked.append(i)
            else:
                other.append((i, self.split(" " + u)))
        ids = self._pieces([" " + w for w in words])
        for i, found in zip(at, ids):
            out[i] = found
        known, learnt = self.units.young, dict(zip(words, ids))
        more = [w for w in {new[i][:-1] for i in marked} if w not in known and w not in learnt]
        learnt.update(zip(more, self._pieces([" " + w for w in more])))
        for i in marked:
            u = new[i]
            out[i] = (learnt.get(u[:-1]) or known[u[:-1]]) + self.mark_ids[u[-1]]
        pieces = self.table.having({p for _, cut in other for p in cut})
        for i, cut in other:
            out[i] = b"".join([pieces[p] for p in cut])
        return out

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        heads, tails = [], []
        for text in texts:
            if not text or _OPEN_SPACE(text):
                heads.append(self.split(text))
                tails.append([])
            else:
                first, *found = text.split(" ")
                heads.append(self.split(first))
                tails.append(found)
        units = self.units.having(set().union(*tails))
        out = [b"".join(map(units.__getitem__, t)) for t in tails]
        pieces = self.table.having(set().union(*heads))
        return [b"".join(map(pieces.__getitem__, h)) + t for h, t in zip(heads, out)]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of ``ids``, concatenated up the tree."""
        if len(ids) <= 1 << 12:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


def encoded(text: Column, path: str, pattern: str) -> Column:
    """Ids of a text as packed little-endian unsigned 32-bit integers."""

    @F.arrow_udf("binary")
    def run(texts: pa.Array) -> pa.Array:
        model = Bpe.load(path, pattern)
        out = []
        for at in range(0, len(texts), _SLICE):
            out += model.encode_all([t or "" for t in texts.slice(at, _SLICE).to_pylist()])
        return pa.array(out, pa.binary())

    return run(text.cast("string"))


def decoded(packed: Column, path: str, pattern: str) -> Column:
    """Bytes of packed ids."""

    @F.arrow_udf("binary")
    def run(ids: pa.Array) -> pa.Array:
        model = Bpe.load(path, pattern)
        return pa.array([model.decode(np.frombuffer(x.as_py(), "<u4").tolist()) for x in ids], pa.binary())

    return run(packed)


def unpacked(packed: Column) -> Column:
    """Packed ids as an array of integers."""

    @F.arrow_udf("array<int>")
    def run(ids: pa.Array) -> pa.Array:
        parts = [np.frombuffer(x.as_py(), "<i4") for x in ids]
        ends = np.cumsum([0, *map(len, parts)], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, "<i4"), *parts])))

    return run(packed)


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row (columns ``keep``, default all) followed by ``n_tokens`` and
    ``ids`` (packed).  Names the input uses already get underscores."""
    ship_package(docs.sparkSession)
    kept = list(docs.columns if keep is None else keep)
    out = docs.select(F.struct(*kept).alias("row"), encoded(F.col(text_col), path, pattern).alias("ids"))
    return out.select(
        *[F.col("row")[c].alias(c) for c in kept],
        (F.length("ids") / 4).cast("long").alias(fresh(kept, "n_tokens")),
        F.col("ids").alias(fresh(kept, "ids")),
    )


def encode_decoded(
    docs: DataFrame, path: str, pattern: str, text_col: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """Every row (columns ``keep``, default all) followed by ``n_tokens``,
    ``ids`` (packed) and ``decoded``, the bytes that the ids decode to.

    A text is encoded once, and its ids are decoded where they are made: Spark
    would run ``encoded`` a second time inside ``decoded``.
    """
    ship_package(docs.sparkSession)
    kept = list(docs.columns if keep is None else keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Bpe.load(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                part = batch.slice(at, _SLICE)
                packed = model.encode_all([t or "" for t in part.column(1).to_pylist()])
                back = [model.decode(np.frombuffer(p, "<u4").tolist()) for p in packed]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(packed, pa.binary()), pa.array(back, pa.binary())],
                    names=["row", "ids", "decoded"],
                )

    rows = docs.select(F.struct(*kept).alias("row"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])
    out = rows.mapInArrow(run, schema)
    return out.select(
        *[F.col("row")[c].alias(c) for c in kept],
        (F.length("ids") / 4).cast("long").alias(fresh(kept, "n_tokens")),
        F.col("ids").alias(fresh(kept, "ids")),
        F.col("decoded").alias(fresh(kept, "decoded")),
    )


def encode_checked(
    docs: DataFrame,
    path: str,
    pattern: str,
    text_col: str = "text",
    keep: list[str] | None = None,
    memory: int | None = None,
) -> DataFrame:
    """Every row (columns ``keep``, default all) followed by ``n_tokens``,
    ``ids`` (an array of integers) and ``round_trip``, whether they decode to
    the text.

    Ids are decoded where they are made, and rows leave a task a slice of texts
    at a time: neither packed ids nor decoded bytes are sent anywhere, and a
    worker holds its memory (``memory`` bytes of units), one batch of texts and
    one slice of results.
    """
    ship_package(docs.sparkSession)
    kept = list(docs.columns if keep is None else keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Bpe.load(path, pattern, memory)
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                part = batch.slice(at, _SLICE)
                some = [t or "" for t in part.column(1).to_pylist()]
                packed = model.encode_all(some)
                same = [model.decode(np.frombuffer(p, "<u4").tolist()) == t.encode() for p, t in zip(packed, some)]
                ends = np.cumsum([0, *(len(p) // 4 for p in packed)], dtype=np.int32)
                ids = pa.array(np.frombuffer(b"".join(packed), "<i4"), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(ends), ids), pa.array(same, pa.bool_())],
                    names=["row", "ids", "round_trip"],
                )

    rows = docs.select(F.struct(*kept).alias("row"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType())])
    out = rows.mapInArrow(run, schema)
    return out.select(
        *[F.col("row")[c].alias(c) for c in kept],
        F.size("ids").cast("long").alias(fresh(kept, "n_tokens")),
        F.col("ids").alias(fresh(kept, "ids")),
        F.col("round_trip").alias(fresh(kept, "round_trip")),
    )
