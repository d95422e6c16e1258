"""A stated set of queries meets every shard of an index, in blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most shuffle partitions that shards are spread over.
MOST_PARTS = 20_000


def meet(
    shards: DataFrame,
    blocks: DataFrame,
    wanted: Column,
    load: Callable[[dict], object],
    ask: Callable[[object, dict], pa.RecordBatch],
    schema: str,
    n_shards: int,
) -> DataFrame:
    """``ask(load(shard), block)`` of every shard and every block of queries
    sent to it, as rows of ``schema``.

    ``shards`` has a column ``shard`` and a row per shard, ``blocks`` a row per
    block; ``wanted`` over the columns of ``blocks`` is the array of shards
    that a block goes to.  A shard's row is shuffled once and comes first in
    its task; its blocks follow one by one, so a task holds one shard and one
    block at a time, however many blocks there are.
    """
    index = shards.select("shard", F.lit(0).alias("kind"), F.struct(*shards.columns).alias("row"), F.lit(None).alias("block"))
    asked = blocks.select(
        F.explode(wanted).alias("shard"), F.lit(1).alias("kind"), F.lit(None).alias("row"), F.struct(*blocks.columns).alias("block")
    )
    stream = index.unionByName(asked).repartition(max(1, min(n_shards, MOST_PARTS)), "shard").sortWithinPartitions("shard", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["kind"] == 0:
                    held, number = load(row["row"]), row["shard"]
                elif row["shard"] == number:
                    yield ask(held, row["block"])

    return stream.mapInArrow(run, schema)
