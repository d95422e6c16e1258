"""Periodic runs of words by Baier's grouping and Lyndon roots.

A run is a maximal stretch of words whose smallest period is ``q``: words ``q``
apart are equal, and no neighbouring word could join.  Every run with at least
two periods holds a Lyndon word of length ``q`` that is the longest one
starting at its place, under the order of the words or under the reversed
order (Bannai et al.).  So the candidates are two per word.

Phase one of Baier's suffix sorter yields them without sorting suffixes.
Suffixes start in groups by their first word.  Groups are taken from the
highest down; every suffix of the group taken becomes part of the nearest
lower suffix on its left, which grows by it, and the lower suffixes that have
grown move into new groups just above their old one, those that took more
copies higher.  A suffix's length at the time its group is taken is the
longest Lyndon word starting there.  The words of a text are always tiled by
the suffixes that nothing has absorbed, so the nearest lower one is the left
neighbour in that tiling.

A root that starts at ``i`` with length ``p`` is extended to both sides by
longest common extensions of ``i`` and ``i + p`` (compared in doubling
blocks); a root inside the run that its period has found last is not extended
again.  The words are numbered by an Arrow dictionary: any order of them will
do.  Work per text is linear but for the extensions, memory is a few numbers
per word, and a text never leaves its task.

Defined results: a NULL or blank text has no words and no runs; runs come by
start, then period; words that a run repeats, those after its first ``q``, are
left out of ``kept``; repeated rows are treated each; extra columns are kept,
and names already taken get underscores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.common import fresh, ship_package, words

MIN_LENGTH = 6
MIN_EXPONENT = 4
#: Texts numbered together.
_SLICE = 256

_RUN = "array<struct<start:long,length:long,period:long>>"


def lyndon_array(codes: list[int], reverse: bool = False) -> list[int]:
    """Length of the longest Lyndon word that starts at each place, under the
    order of the codes (0, 1, ... without gaps) or its reverse."""
    n = len(codes)
    if not n:
        return []
    top = max(codes)
    members: list[list[int]] = [[] for _ in range(top + 1)]
    for i, c in enumerate(codes):
        members[c].append(i)
    live = list(map(len, members))  # suffixes still in a group
    if reverse:
        below, above, group = [*range(1, top + 1), -1], list(range(-1, top)), 0
    else:
        below, above, group = list(range(-1, top)), list(range(1, top + 2)), top
    of = codes[:]  # group of a suffix, -1 once it has been taken
    size = [1] * n
    left = list(range(-1, n))  # the neighbour in the tiling

    def raised(anchor: int, grown: list[int]) -> int:
        """A new group just above ``anchor``."""
        new, over = len(members), above[anchor]
        members.append(grown)
        live.append(len(grown))
        below.append(anchor)
        above.append(over)
        above[anchor] = new
        below[over] = new
        for j in grown:
            of[j] = new
        return new

    while group >= 0:
        some = members[group]
        if len(some) == 1:
            i = some[0]
            if of[i] == group:
                of[i] = -1
                j = left[i]
                if j >= 0 and (g := of[j]) >= 0:
                    s = size[i]
                    size[j] += s
                    left[i + s] = j
                    if live[g] > 1:
                        live[g] -= 1
                        raised(g, [j])
        elif live[group]:
            taken: dict[int, int] = {}
            for i in some:
                if of[i] == group:
                    of[i] = -1
                    j = left[i]
                    if j >= 0 and of[j] >= 0:
                        s = size[i]
                        size[j] += s
                        left[i + s] = j
                        taken[j] = taken.get(j, 0) + 1
            grown: dict[tuple[int, int], list[int]] = {}
            risen: dict[int, int] = {}
            for j, copies in taken.items():
                g = of[j]
                if live[g] > 1:
                    grown.setdefault((g, copies), []).append(j)
                    risen[g] = risen.get(g, 0) + 1
            anchor, last = -1, -1
            for g, copies in sorted(grown):
                some = grown[g, copies]
                if g != last:
                    anchor = last = g
                    if live[g] == risen[g]:
                        continue  # all have grown: the lowest keep the group
                live[g] -= len(some)
                anchor = raised(anchor, some)
        group = below[group]
    return size


def _forward(a: np.ndarray, i: int, j: int) -> int:
    """How many items are equal from ``i`` and from ``j > i`` on."""
    at, step, most = 0, 16, len(a) - j
    while at < most:
        step = min(step, most - at)
        unequal = a[i + at : i + at + step] != a[j + at : j + at + step]
        if unequal.any():
            return at + int(unequal.argmax())
        at, step = at + step, 2 * step
    return most


def find_runs(codes: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least ``min_length`` items
    and ``min_exponent`` (2 or more) periods, by start, then period."""
    n = len(codes)
    if n < 2:
        return []
    ranks = np.unique(codes, return_inverse=True)[1]
    listed, back = ranks.tolist(), ranks[::-1]
    places = np.arange(n)
    found = set()
    for reverse in (False, True):
        period = np.array(lyndon_array(listed, reverse))
        follow = places + period
        # A root of a run goes on behind it, or is the end of what came before.
        onward = np.zeros(n, bool)
        inside = follow < n
        onward[inside] = ranks[inside.nonzero()[0]] == ranks[follow[inside]]
        onward[1:] |= ranks[:-1] == ranks[follow[1:] - 1]
        reached: dict[int, int] = {}
        roots = onward.nonzero()[0]
        for i, p in zip(roots.tolist(), period[roots].tolist()):
            if i + p <= reached.get(p, -1):
                continue
            end = i + p + _forward(ranks, i, i + p)
            start = i - _forward(back, n - i - p, n - i)
            reached[p] = end
            if end - start >= max(min_length, min_exponent * p):
                found.add((start, end - start, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def _offsets(lengths) -> pa.Array:
    return pa.array(np.cumsum([0, *lengths]), pa.int32())


def _runs_of(min_length: int, min_exponent: int):
    def some(texts: pa.ListArray) -> pa.StructArray:
        values = texts.flatten()
        codes = values.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        kept = np.ones(len(codes), bool)
        runs, n_runs, n_kept, at = [], [], [], 0
        for length in texts.value_lengths().fill_null(0).to_pylist():
            here = find_runs(codes[at : at + length], min_length, min_exponent)
            for start, size, period in here:
                kept[at + start + period : at + start + size] = False
            runs += here
            n_runs.append(len(here))
            n_kept.append(int(kept[at : at + length].sum()))
            at += length
        columns = np.array(runs, np.int64).reshape(-1, 3)
        found = pa.StructArray.from_arrays([pa.array(c) for c in columns.T], ["start", "length", "period"])
        return pa.StructArray.from_arrays(
            [
                pa.ListArray.from_arrays(_offsets(n_runs), found),
                pa.ListArray.from_arrays(_offsets(n_kept), values.filter(pa.array(kept))),
            ],
            ["runs", "kept"],
        )

    @F.arrow_udf(f"struct<runs:{_RUN},kept:array<string>>")
    def run(texts: pa.Array) -> pa.Array:
        parts = [some(texts.slice(at, _SLICE)) for at in range(0, len(texts), _SLICE)]
        return pa.concat_arrays(parts) if parts else some(texts)

    return run


def runs_of_words(
    docs: DataFrame,
    items: Column,
    keep: list[str] | None = None,
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """Every row (columns ``keep``, default all) followed by ``runs`` (start,
    length, period) of the array of strings ``items`` and ``kept``, the items
    that no run repeats."""
    if min_exponent < 2:
        raise ValueError("a run has at least two periods")
    ship_package(docs.sparkSession)
    kept = list(docs.columns if keep is None else keep)
    found = _runs_of(min_length, min_exponent)(items)
    out = docs.select(F.struct(*kept).alias("row"), found.alias("found"))
    return out.select(
        *[F.col("row")[c].alias(c) for c in kept],
        F.col("found.runs").alias(fresh(kept, "runs")),
        F.col("found.kept").alias(fresh(kept, "kept")),
    )


def text_runs(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``runs_of_words`` of whole texts."""
    return runs_of_words(docs, words(F.col(text_col).cast("string")), **options)


def longest(runs: Column) -> Column:
    """The longest run of an array (ties: least start, then period), or NULL."""
    return F.get(
        F.array_sort(
            runs,
            lambda x, y: F.when(x["length"] != y["length"], F.when(x["length"] > y["length"], -1).otherwise(1))
            .when(x["start"] != y["start"], F.when(x["start"] < y["start"], -1).otherwise(1))
            .otherwise(F.when(x["period"] < y["period"], -1).otherwise(F.when(x["period"] > y["period"], 1).otherwise(0))),
        ),
        F.lit(0),
    )
