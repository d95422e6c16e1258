"""Entity classification from its rows.

An entity (a polling table) gets a class when any of its rows satisfies a
rule; rules are prioritised.  The default plan pre-aggregates one flag row
per entity and joins it back, instead of a whole-partition window:

* the flag aggregate is partial/final, so a hot entity holding a third of the
  rows collapses map-side before the shuffle;
* the join back is planned by Spark: broadcast when AQE measures the flag
  table under the broadcast threshold, otherwise a sort-merge join whose
  skewed partitions AQE splits (both inputs are shuffle stages by
  construction).  A window would instead buffer a hot entity's whole group
  inside one task.

``method="hash"`` is the same join with the special entities hashed instead of
both sides sorted: wide rows stream past one small row per entity, and AQE
splits a hot entity as well.

``method="dealt"`` hashes as well, by plain equality, for text keys that are
never NULL: rows stay dealt by the entity, so aggregates and windows whose keys
hold the entity need no exchange of their own.  Run it with
``session.hot_keys_split``: where AQE finds a hot entity it then splits the
join and puts those exchanges in again.

``method="window"`` keeps the single-Window plan (one Exchange, one Sort).

``method="clustered"`` is for a table bucketed by the entity key, which is
never NULL (``sink.publish_clustered``): flags are aggregated and joined back
by plain equality, bucket by bucket, without any exchange.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallymart.functions.codes import flag, row_kind as _row_kind
from tallymart.spec import ClassSpec, KindSpec


def row_kind(df: DataFrame, spec: KindSpec) -> DataFrame:
    """Add the row kind column."""
    return df.withColumn(spec.output, _row_kind(spec.code, spec.codes, spec.yes, spec.no))


def _flag_names(spec: ClassSpec) -> list[str]:
    return [f"__flag{i}" for i in range(len(spec.rules))]


def _class_expr(spec: ClassSpec) -> Column:
    expr = None
    for name, rule in zip(_flag_names(spec), spec.rules):
        cond = F.col(name) == 1
        expr = F.when(cond, F.lit(rule.label)) if expr is None else expr.when(cond, F.lit(rule.label))
    return F.lit(spec.otherwise) if expr is None else expr.otherwise(F.lit(spec.otherwise))


def entity_flags(df: DataFrame, spec: ClassSpec) -> DataFrame:
    """One row per entity with one 0/1 flag per rule (W1) and its class."""
    flags = [F.max(flag(r.predicate)).alias(n) for n, r in zip(_flag_names(spec), spec.rules)]
    if not flags:
        return df.select(*spec.key).distinct().withColumn(spec.output, F.lit(spec.otherwise))
    return df.groupBy(*spec.key).agg(*flags).withColumn(spec.output, _class_expr(spec))


def entity_class(df: DataFrame, spec: ClassSpec, method: str = "join") -> DataFrame:
    """Add the entity class column to every row."""
    if method == "window":
        w = Window.partitionBy(*spec.key)
        flags = {n: F.max(flag(r.predicate)).over(w) for n, r in zip(_flag_names(spec), spec.rules)}
        return df.withColumns(flags).withColumn(spec.output, _class_expr(spec)).drop(*flags)
    if method == "clustered":
        flagged = entity_flags(df, spec).select(*spec.key, spec.output)
        return df.join(flagged.hint("merge"), on=list(spec.key), how="inner").select(*df.columns, spec.output)
    if method not in ("join", "hash", "dealt"):
        raise ValueError(f"unknown method {method!r}")
    fields = {f.name: f for f in df.schema.fields}
    if method == "dealt" and any(fields[k].nullable or fields[k].dataType != StringType() for k in spec.key):
        raise ValueError(f"{spec.key}: only text keys that are never NULL stay dealt")
    keyed = [f"__key{i}" for i in range(len(spec.key))]
    # Entities of the default class need no row on the joined side: in a real
    # tally the special ones are few, so the side is small and the rows are
    # not shuffled at all; where it is large, the join below is split by AQE.
    # Only a row that satisfies a rule can make its entity special.
    hits = [F.expr(r.predicate) if isinstance(r.predicate, str) else r.predicate for r in spec.rules]
    hit_rows = df.filter(reduce(lambda a, b: a | b, hits)) if hits else df
    special = entity_flags(hit_rows, spec).filter(F.col(spec.output) != F.lit(spec.otherwise))
    classes = special.select(*[F.col(k).alias(a) for k, a in zip(spec.key, keyed)], F.col(spec.output).alias("__class"))
    # Null-safe equality, even for keys that cannot be NULL: a window groups
    # NULL keys together, so must we; and the null-safe join keys differ from
    # the aggregate's partitioning, so both join inputs get their own
    # shuffle - the only shape in which AQE can split a hot entity's
    # partition.  The extra shuffle moves one row per entity.
    eq = [df[k].eqNullSafe(classes[a]) for k, a in zip(spec.key, keyed)]
    if method == "dealt":
        # Spelled otherwise than the aggregate's key: the same reason, for the
        # special entities' side alone.
        classes = classes.withColumns({a: F.concat(F.col(a), F.lit("")) for a in keyed})
        eq = [df[k] == classes[a] for k, a in zip(spec.key, keyed)]
    if method in ("hash", "dealt"):
        classes = classes.hint("shuffle_hash")
    joined = df.join(classes, reduce(lambda a, b: a & b, eq), "left")
    return joined.withColumn(spec.output, F.coalesce("__class", F.lit(spec.otherwise))).drop("__class", *keyed)
