"""Mixing sources to target weights by systematic sampling.

A source's target is a number of words; each of its documents has the same
expected number of copies, ``target / source size``.  Documents are put in one
total order (source, size, id), expected copies are prefix-summed within the
source, one random offset per source is added, and a document is emitted once
for every integer boundary its interval crosses.  Because the order is by
size, the copies taken are spread evenly over short and long documents: the
words taken miss the target by about one longest document at most.

No window holds a source: the order comes from a range partitioning (a source
with a third of all rows spans many partitions), ranks are local row numbers
plus the counts of the partitions before.

Defined results: a NULL text has size 0; NULL is a source of its own (last in
the order); a source of size 0 has target 0 and none of its documents is
taken; repeated rows are separate documents; an empty table gives an empty
result.  The input's other columns pass through, clashing names included: the
columns added are called as the caller says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.common import fresh, n_words
from tallymart.session import materialize

#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)
#: No target is above this multiple of its source's size.
CAP = 3
SEED = "tallymart-mix"


def weighted_sources(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sizes`` (source, source_size) with the weight of each source: the
    given ones in turn, by code point order of the source, NULL last."""
    order = [F.col("source").isNull(), F.col("source")]
    ranked = ranks(placed(sizes, order, "mix-source-order"), [])
    at = F.pmod(F.col("rank"), F.lit(len(weights))).cast("int")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), at)
    return materialize(ranked.select("source", "source_size", weight.alias("weight")), "mix-sources")


def targets(sources: DataFrame, share: float = 1.0, cap: float = CAP) -> DataFrame:
    """Target words per source (source, source_size, weight, target).

    Sources share ``share`` of all sizes by weight; a target stops at ``cap``
    times its source's size and the excess is shared again among the others
    until none is above.  Each round is one aggregate over the sources; a
    round caps at least one more source or ends.
    """
    cap_of = F.col("source_size") * F.lit(float(cap))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    want, level = float(total) * share, 0.0
    while True:
        capped = cap_of <= F.col("weight") * F.lit(level)
        row = sources.agg(
            F.sum(F.when(capped, cap_of).otherwise(F.lit(0.0))).alias("full"),
            F.sum(F.when(~capped, F.col("weight")).otherwise(F.lit(0.0))).alias("weight"),
        ).first()
        new = (want - (row["full"] or 0.0)) / row["weight"] if row["weight"] else level
        if new <= level:
            break
        level = new
    target = F.least(cap_of, F.col("weight") * F.lit(level))
    return sources.select("source", "source_size", "weight", target.alias("target"))


def placed(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` in the total order of ``order``, written once with each row's
    place: ``part``, the range it fell into, and ``place``, its number there.

    The range boundaries are sampled, so they are fixed by writing the rows:
    every reader and every retried task sees the same places.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = F.monotonically_increasing_id()
    sorted_rows = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    numbered = sorted_rows.select(*df.columns, ids.alias("place"))
    return materialize(numbered.withColumn("part", F.shiftright("place", 33)), name)


def ranks(rows: DataFrame, groups: list[str]) -> DataFrame:
    """``rank`` for rows of ``placed``: the row's number, from 0, among the
    rows of its group (NULL being a group) in the total order, whose first
    keys are the groups.  The table that is windowed has one row per partition
    and group: never more than partitions plus groups."""
    local = rows.groupBy("part", *groups).agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy(*groups).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    keys = [f"group_{i}" for i in range(len(groups))]
    starts = local.select(
        F.col("part").alias("of_part"),
        *[F.col(g).alias(k) for g, k in zip(groups, keys)],
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
    )
    same = F.col("part") == F.col("of_part")
    for g, k in zip(groups, keys):
        same = same & F.col(g).eqNullSafe(F.col(k))
    return rows.join(starts, same).withColumn("rank", F.col("place") + F.col("shift")).drop("of_part", "shift", *keys)


def offset(source: Column, seed: str = SEED) -> Column:
    """One number in [0, 1) per source: the first 32 bits of a digest."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.concat(F.lit("s"), source), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _mixed(docs, kept, id_col, text_col, source_col, weights, share, cap, seed) -> DataFrame:
    """row (a struct of the ``kept`` columns), size, source_size, target, copies."""
    sized = docs.select(
        F.struct(*kept).alias("row"),
        F.col(source_col).alias("source"),
        n_words(F.col(text_col)).alias("size"),
        F.col(id_col).alias("id"),
        F.xxhash64(F.col(text_col)).alias("tie"),
    )
    keys = [F.col("source").isNull(), F.col("source"), F.col("size"), F.col("id").isNull(), F.col("id"), F.col("tie")]
    rows = placed(sized, keys, "mix-order")
    sources = weighted_sources(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights)
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goal = targets(sources, share, cap).select(
        F.col("source").alias("of_source"),
        "source_size",
        "target",
        expected.alias("expected"),
        offset(F.col("source"), seed).alias("offset"),
    )
    edge = lambda k: F.floor(k * F.col("expected") + F.col("offset"))
    return (
        ranks(rows, ["source"])
        .join(goal, F.col("source").eqNullSafe(F.col("of_source")))
        .select(
            "row",
            "size",
            "source_size",
            "target",
            (edge(F.col("rank") + 1) - edge(F.col("rank"))).cast("int").alias("copies"),
        )
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.0,
    cap: float = CAP,
    seed: str = SEED,
    keep: list[str] | None = None,
) -> DataFrame:
    """Every row of ``docs`` (columns ``keep``, default all) followed by its
    size, its source's size and target, and its number of copies.

    A column of the input called like an added one keeps its name; the added
    one gets underscores.
    """
    kept = list(docs.columns if keep is None else keep)
    out = _mixed(docs, kept, id_col, text_col, source_col, weights, share, cap, seed)
    added = [F.col(c).alias(fresh(kept, c)) for c in ("size", "source_size", "target", "copies")]
    return out.select(*[F.col("row")[c].alias(c) for c in kept], *added)


def emit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.0,
    cap: float = CAP,
    seed: str = SEED,
) -> DataFrame:
    """The mixed collection itself: each row of ``docs`` as often as it was
    taken, columns as given."""
    out = _mixed(docs, docs.columns, id_col, text_col, source_col, weights, share, cap, seed)
    taken = out.where(F.col("copies") > 0)
    times = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return taken.select("row", times.alias("time")).select(*[F.col("row")[c].alias(c) for c in docs.columns])
