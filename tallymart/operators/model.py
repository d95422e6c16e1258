"""Dimensional model builders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions.codes import lookup as lookup_expr
from tallymart.spec import DimSpec


def dimension(df: DataFrame, spec: DimSpec) -> DataFrame:
    """Project, filter and (optionally) de-duplicate one table of the model.

    ``distinct`` is a hash aggregate with map-side partials, so a value that
    repeats in a third of the rows is collapsed before it is shuffled.  Literal
    lookups run after the distinct, on the few remaining rows.
    """
    rows = df
    for c in spec.not_null:
        rows = rows.filter(F.col(c).isNotNull())
    if spec.filter:
        rows = rows.filter(F.expr(spec.filter))
    out = rows.select(*[F.expr(e).alias(n) for n, e in spec.columns.items()])
    if spec.one_per:
        out = one_spelling(out, spec.one_per)
    elif spec.distinct:
        out = out.distinct()
    for name, (code, mapping) in spec.lookups.items():
        out = out.withColumn(name, lookup_expr(code, mapping))
    return out


def preference(columns: Sequence[str], count: Column) -> Column:
    """Orders spellings: the most frequent first, then present before NULL,
    then least by code point, column by column."""
    parts = [p for c in columns for p in (F.col(c).isNull(), F.col(c))]
    return F.struct(-count, *parts)


def one_spelling(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key: its most frequent tuple of the other columns.

    Rows are counted per (key, tuple) first, with map-side partials, so a key
    with a third of all rows is one row per spelling before it is compared.
    """
    rest = [c for c in df.columns if c not in key]
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    if not rest:
        return counted.drop("__n")
    best = F.min_by(F.struct(*rest), preference(rest, F.col("__n"))).alias("__best")
    return counted.groupBy(*key).agg(best).select(
        *[F.col(f"__best.{c}").alias(c) if c in rest else F.col(c) for c in df.columns]
    )


def fact(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Fact rows (G1): one output row per input row, no de-duplication."""
    return df.select(*[F.expr(e).alias(n) for n, e in columns.items()])


def lookup(df: DataFrame, code: str, mapping: Mapping[str, str], output: str) -> DataFrame:
    """Code -> name via a literal map (P13); unknown codes -> NULL."""
    return df.withColumn(output, lookup_expr(code, mapping))


def lookup_table(
    df: DataFrame,
    code: str,
    table: DataFrame,
    table_key: str,
    value: str,
    output: str,
) -> DataFrame:
    """Code -> name via a lookup DataFrame (P13 for maps too large to inline).

    Left join, so unknown codes give NULL like the literal map.  A key that
    the table repeats gets its least value, so no row of ``df`` is multiplied.
    Spark broadcasts the side where its measured size allows it.
    """
    side = table.groupBy(F.col(table_key).alias("__lk")).agg(F.min(value).alias(output))
    return df.join(side, df[code] == side["__lk"], "left").drop("__lk")
