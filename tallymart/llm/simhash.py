"""SimHash near duplicates by pigeonhole blocks.

A fingerprint's 64 bits are cut into ``blocks`` pieces.  Two fingerprints that
differ in at most ``max_bits`` bits agree on all of some ``blocks - max_bits``
pieces, so equal choices of so many pieces are the join keys: with 6 blocks
and 3 bits, 20 keys of 32 bits or so, selective enough for billions of
fingerprints.  Candidates that share a key are verified by Hamming distance.

Equal fingerprints are one class from the start (a group of copies is one
row), and a bucket is not expanded into pairs: from a pivot, all unvisited
members within the distance are reached at once and leave the search, so a
dense bucket costs about its size and yields a spanning forest: every link
between different fingerprints is inside one tree of some bucket.  Buckets
above ``tile`` members are spread over tiles, each pair of tiles in a group of
its own, so no task holds more than two tiles however large the bucket.
Components of the forests come from alternating large-star and small-star
steps on written tables.

Defined results: a text without words (NULL, empty, blank) has fingerprint
zero and links like any other; fewer words than the shingle length make one
shingle of them all; repeated rows and ids fall into the class of their text;
a class whose ids are all NULL has a NULL component id.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.common import fresh, ship_package
from tallymart.session import materialize

SHINGLE = 3
MAX_BITS = 3
BLOCKS = 6
TILE = 50_000
SEED = 42
_CHUNK = 1 << 16
_SLICE = 256


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of a whole UTF-8 text: a bit is 1 if it is set in over half
    the shingles' hashes."""
    words = text.lower().split()  # of bytes: A-Z only, and exactly the six breaks
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    n = len(words) - shingle + 1
    digest, join = xxhash.xxh64_intdigest, b" ".join
    grams = (digest(join(g), SEED) for g in zip(*[itertools.islice(words, i, None) for i in range(shingle)]))
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        h = np.fromiter(grams, np.uint64, min(_CHUNK, n - at))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprint_of(shingle: int = SHINGLE):
    """Arrow UDF: the fingerprint of a text as a signed long."""

    @F.arrow_udf("long")
    def run(texts: pa.Array) -> pa.Array:
        out = np.empty(len(texts), np.uint64)
        for at in range(0, len(texts), _SLICE):
            part = texts.slice(at, _SLICE).cast(pa.binary()).to_pylist()
            out[at : at + len(part)] = [fingerprint(t or b"", shingle) for t in part]
        return pa.array(out.view(np.int64))

    return run


def _cuts(blocks: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of each block."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def block_keys(fp, max_bits: int = MAX_BITS, blocks: int = BLOCKS):
    """Array of structs (choice, value): the chosen blocks' bits in place."""
    masks = []
    for chosen in itertools.combinations(_cuts(blocks), blocks - max_bits):
        mask = sum(((1 << width) - 1) << low for low, width in chosen)
        masks.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    return F.array(
        *[F.struct(F.lit(i).alias("choice"), fp.bitwiseAND(F.lit(m)).alias("value")) for i, m in enumerate(masks)]
    )


def forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """(root, member) links that connect what distances up to ``max_bits``
    connect among distinct ``fps``."""
    links: list[tuple[int, int]] = []
    rest = fps
    while rest.size > 1:
        root, rest = rest[0], rest[1:]
        queue = [root]
        while queue and rest.size:
            near = np.bitwise_count(rest ^ queue.pop()) <= max_bits
            if near.any():
                reached = rest[near]
                rest = rest[~near]
                queue.extend(reached)
                links.extend((int(root), int(x)) for x in reached)
    return links


def _bucket_links(max_bits: int):
    """Over rows sorted by bucket: the forests of all buckets of the partition."""

    def links(fps: np.ndarray, starts: np.ndarray) -> list[tuple[int, int]]:
        out = []
        ends = np.append(starts[1:], len(fps))
        for a, b in zip(starts[ends - starts > 1], ends[ends - starts > 1]):
            out += forest(fps[a:b], max_bits)
        return out

    def emit(found):
        pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = fps = None  # the rows of the bucket that may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            k = np.stack([batch.column(i).to_numpy() for i in range(2)], axis=1)
            f = batch.column(2).to_numpy().view(np.uint64)
            if keys is not None:
                k, f = np.concatenate([keys, k]), np.concatenate([fps, f])
            starts = np.flatnonzero(np.append(True, (k[1:] != k[:-1]).any(axis=1)))
            last = starts[-1]
            if found := links(f[:last], starts[:-1]):
                yield emit(found)
            keys, fps = k[last:].copy(), f[last:].copy()
        if fps is not None and (found := forest(fps, max_bits)):
            yield emit(found)

    return run


def _tile_number(choice: Column, own: Column, other: Column) -> Column:
    """One number for a choice of blocks and an unordered pair of tiles."""
    pair = F.least(own, other) * F.lit(1 << 20).cast("long") + F.greatest(own, other)
    return choice * F.lit(1 << 40).cast("long") + pair


def links(classes: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` of ``classes`` that
    connect exactly what distances of 1 to ``max_bits`` bits connect."""
    spark = classes.sparkSession
    ship_package(spark)
    keyed = classes.select("fp", F.explode(block_keys(F.col("fp"), max_bits, blocks)).alias("key")).select(
        "fp", "key.choice", "key.value"
    )
    # Usually empty; its written size decides how it is joined.
    heavy = materialize(
        keyed.groupBy("choice", "value").agg(F.count("*").alias("n")).where(F.col("n") > tile), "simhash-heavy"
    )
    tiles = F.coalesce(F.ceil(F.col("n") / F.lit(tile)), F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    spread = (
        keyed.join(heavy, ["choice", "value"], "left")
        .select("fp", "choice", "value", tiles.alias("tiles"))
        .select("fp", "choice", "value", "tiles", own.alias("own"))
        .select("fp", "choice", "value", "own", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
        .select(_tile_number(F.col("choice"), F.col("own"), F.col("other")).alias("tile"), "value", "fp")
    )
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    grouped = spread.repartition(n, "tile", "value").sortWithinPartitions("tile", "value")
    return grouped.mapInArrow(_bucket_links(max_bits), "a long, b long").distinct()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges (u, v) with u > v, in unsigned-free long order:
    neighbours of each node are re-linked to its least neighbour."""
    if large:  # larger neighbours go to the least of the neighbourhood
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        moved = edges.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least, "u").select(
            F.col("w").alias("u"), F.col("m").alias("v")
        )
    else:  # smaller neighbours, and the node itself, go to the least of them
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        near = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = near.union(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(pairs: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``pairs`` (a, b): the least node of its
    connected component.  Each round is written; rounds grow with the
    logarithm of the longest chain, not with the data."""
    ordered = pairs.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    state = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    edges = materialize(ordered, f"{name}-0")
    before = state(edges)
    for i in itertools.count(1):
        edges = materialize(_star(_star(edges, True), False), f"{name}-{i}")
        after = state(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _grouped(docs, kept, id_col, text_col, shingle, max_bits, blocks, tile):
    """The rows with their fingerprint, written (row, id, fp, place), and the
    written classes (fp, root, component)."""
    ship_package(docs.sparkSession)
    given = docs.select(
        F.struct(*kept).alias("row"),
        F.col(id_col).alias("id"),
        fingerprint_of(shingle)(F.col(text_col).cast("string")).alias("fp"),
    )
    prints = materialize(given.withColumn("place", F.monotonically_increasing_id()), "simhash-prints")
    classes = materialize(prints.groupBy("fp").agg(F.min("id").alias("rep")), "simhash-classes")
    groups = components(links(classes, max_bits, blocks, tile), "simhash-components")
    rooted = classes.join(groups, classes["fp"] == groups["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "rep"
    )
    least = rooted.groupBy("root").agg(F.min("rep").alias("component"))
    named = rooted.select("fp", "root").join(least, "root").select("fp", "root", "component")
    return prints, materialize(named, "simhash-named")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    blocks: int = BLOCKS,
    tile: int = TILE,
    keep: list[str] | None = None,
) -> DataFrame:
    """Every row of ``docs`` (columns ``keep``, default all) followed by its
    ``fingerprint`` (signed long) and ``component_id``, the least id that
    links reach, the row's own included.  Names that the input uses already
    get underscores."""
    kept = list(docs.columns if keep is None else keep)
    prints, named = _grouped(docs, kept, id_col, text_col, shingle, max_bits, blocks, tile)
    return prints.join(named, "fp").select(
        *[F.col("row")[c].alias(c) for c in kept],
        F.col("fp").alias(fresh(kept, "fingerprint")),
        F.col("component").alias(fresh(kept, "component_id")),
    )


def one_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    blocks: int = BLOCKS,
    tile: int = TILE,
) -> DataFrame:
    """One document of each group, columns as given: the one of the least id
    (NULL ids last), of rows that share it the first as written."""
    prints, named = _grouped(docs, docs.columns, id_col, text_col, shingle, max_bits, blocks, tile)
    first = F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("place"))).alias("first")
    stay = (
        prints.select("id", "place", "fp")
        .join(named.select("fp", "root"), "fp")
        .groupBy("root")
        .agg(first)
        .select(F.col("first.place").alias("place"))
    )
    return prints.join(stay, "place", "left_semi").select(*[F.col("row")[c].alias(c) for c in docs.columns])
