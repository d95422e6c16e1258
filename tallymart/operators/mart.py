"""Summary mart.

Two plans with the same result:

* ``summary``: pivot of the totals rows grouped by join keys + attributes,
  left-joined on the join keys to the aggregate of the list rows
  (``list_aggregate``).  Three exchanges.
* ``summary_onepass``: one scan; a conditional aggregate by join keys +
  attributes, then a window over the (small) aggregate per join key.  Two
  exchanges, no join, and the input is evaluated once.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tallymart.operators.reshape import pivot_codes
from tallymart.spec import SummarySpec


def list_aggregate(df: DataFrame, spec: SummarySpec) -> DataFrame:
    """Sum and row count of the list rows per join key (A2)."""
    rows = df.filter(F.col(spec.kind) == F.lit(spec.lists_kind))
    return rows.groupBy(*spec.join_keys).agg(
        F.sum(spec.measure).alias(spec.lists_sum),
        F.count(F.lit(1)).alias(spec.lists_count),
    )


def totals_pivot(df: DataFrame, spec: SummarySpec) -> DataFrame:
    """Totals rows pivoted to one column per code."""
    rows = df.filter(F.col(spec.kind) == F.lit(spec.totals_kind))
    return pivot_codes(rows, (*spec.join_keys, *spec.attributes), spec.code, spec.totals, spec.measure)


def _order(df: DataFrame, spec: SummarySpec) -> DataFrame:
    return df.select(*spec.output_order) if spec.output_order else df


def summary(df: DataFrame, spec: SummarySpec) -> DataFrame:
    """Pivoted totals left-joined to list aggregates on the join keys.

    USING-join semantics: a NULL join key never matches, so such rows keep
    NULL list columns.
    """
    if spec.one_spelling:
        return summary_onepass(df, spec)
    joined = totals_pivot(df, spec).join(list_aggregate(df, spec), on=list(spec.join_keys), how="left")
    return _order(joined, spec)


def _all(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, cols)


def _per_key(spec: SummarySpec) -> WindowSpec:
    """Window over the rows of a join key.  Sorted by a hash of the key first:
    rows of different keys are then told apart by one number, whereas codes
    and padded ids begin alike and would be compared to their end."""
    return Window.partitionBy(F.xxhash64(*spec.join_keys), *spec.join_keys)


def summary_onepass(
    df: DataFrame, spec: SummarySpec, stage: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """The summary with one scan of the input and no join.

    Level 1 groups by join keys + attributes (partial/final aggregation, so a
    hot key is collapsed map-side) and computes, per attribute tuple, the
    pivot cells over the totals rows plus partial list sums and counts.
    Level 2 adds the list parts up over all tuples of the same join key with
    a window on the level-1 output, which holds one row per distinct tuple,
    not per input row.  Tuples without totals rows are then dropped.

    This is exactly the joined plan: lists are aggregated per join key
    whatever their attributes, and a NULL join key gets NULL list columns
    because an equi-join never matches it.

    ``stage`` writes level 1 and returns a scan of it, so that the shuffles of
    the two levels need not be on disk at once.
    """
    is_tot = F.col(spec.kind) == F.lit(spec.totals_kind)
    is_list = F.col(spec.kind) == F.lit(spec.lists_kind)
    aggs = [F.count_if(is_tot).alias("__ntot")]
    for code, name in spec.totals.items():
        aggs.append(F.max(F.when(is_tot & (F.col(spec.code) == F.lit(code)), F.col(spec.measure))).alias(name))
    aggs.append(F.sum(F.when(is_list, F.col(spec.measure))).alias("__lsum"))
    aggs.append(F.count_if(is_list).alias("__lcnt"))
    level1 = df.groupBy(*spec.join_keys, *spec.attributes).agg(*aggs)
    # A tuple without totals rows only adds its lists: its attributes are not carried on.
    named = {c: F.when(F.col("__ntot") > 0, F.col(c)) for c in spec.attributes if c not in spec.join_keys}
    level1 = level1.withColumns(named)
    if stage is not None:
        # Dealt by the keys before their hash is added, which need not be shuffled.
        level1 = stage(level1).repartition(*spec.join_keys)
    if spec.one_spelling:
        return _order(_one_row(level1, spec), spec)

    w = _per_key(spec)
    keys_present = _all([F.lit(True)] + [F.col(k).isNotNull() for k in spec.join_keys])
    n_lists = F.sum("__lcnt").over(w)
    has_lists = keys_present & (n_lists > 0)
    out = level1.select(
        *spec.join_keys,
        *spec.attributes,
        *spec.totals.values(),
        "__ntot",
        F.when(has_lists, F.sum("__lsum").over(w)).alias(spec.lists_sum),
        F.when(has_lists, n_lists).alias(spec.lists_count),
    )
    return _order(out.filter(F.col("__ntot") > 0).drop("__ntot"), spec)


def _one_row(level1: DataFrame, spec: SummarySpec) -> DataFrame:
    """One row per join key from the counts per attribute tuple: the tuple
    that comes first, with what all tuples of its key have.  One exchange and
    one sort, of a row per spelling of a polling table; tuples without totals
    rows come last."""
    present = _all([F.lit(True)] + [F.col(k).isNotNull() for k in spec.join_keys])
    # The order of ``preference`` by columns that the rows have anyway: Spark
    # would shuffle a computed struct of all attributes beside them.
    w = _per_key(spec).orderBy(F.col("__ntot").desc(), *[F.col(c).asc_nulls_last() for c in spec.attributes])
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = level1.select(
        *spec.join_keys,
        *spec.attributes,
        *[F.max(c).over(every).alias(c) for c in spec.totals.values()],
        "__ntot",
        F.sum("__lsum").over(every).alias("__lsum"),
        F.sum("__lcnt").over(every).alias("__lists"),
        F.row_number().over(w).alias("__at"),
    )
    has_lists = present & (F.col("__lists") > 0)
    return rows.filter((F.col("__at") == 1) & (F.col("__ntot") > 0)).select(
        *spec.join_keys,
        *spec.attributes,
        *spec.totals.values(),
        F.when(has_lists, F.col("__lsum")).alias(spec.lists_sum),
        F.when(has_lists, F.col("__lists")).alias(spec.lists_count),
    )
