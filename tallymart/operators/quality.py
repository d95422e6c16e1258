"""Data-quality gates and key checks.

``evaluate`` folds every row rule and every distinct rule into one global
aggregate (``count_if`` per rule: one pass, map-side partials, a single-row
result), and each family of grouped rules sharing a key into one grouped
aggregate.  Nothing is collected until ``enforce``, whose input is one row
per rule.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallymart.spec import Contract, Rule

REPORT_COLUMNS = ("rule", "position", "violations")


class QualityError(RuntimeError):
    """Raised by ``enforce`` with every failing rule, in rule order."""

    def __init__(self, failures: Sequence[tuple[str, int]]):
        self.failures = list(failures)
        lines = "; ".join(f"{name}: {n} violation(s)" for name, n in self.failures)
        super().__init__(f"{len(self.failures)} quality rule(s) failed: {lines}")


def stack_rows(df: DataFrame, rows: Sequence[Sequence[Column]], names: Sequence[str]) -> DataFrame:
    """Turn the single row of ``df`` into ``len(rows)`` rows (one per entry)
    with the ``stack`` generator; values are columns, so names never need
    SQL quoting."""
    args = [F.lit(len(rows))] + [c for row in rows for c in row]
    return df.select(F.stack(*args).alias(*names))


def any_null(columns: Iterable[str]) -> str:
    """SQL predicate: at least one of the columns is NULL."""
    return " OR ".join(f"{c} IS NULL" for c in columns)


def _violation_rows(df: DataFrame, rule: Rule) -> DataFrame:
    rows = df.filter(F.expr(rule.violation))
    return rows.select(*rule.columns) if rule.columns else rows


def violations(df: DataFrame, rule: Rule) -> DataFrame:
    """The offending rows (row rules), distinct values (distinct rules) or
    groups (grouped rules) of one rule (D0)."""
    if rule.grouped:
        rows = df.filter(F.expr(rule.filter)) if rule.filter else df
        aggs = [F.expr(e).alias(n) for n, e in rule.agg.items()]
        return rows.groupBy(*rule.group_by).agg(*aggs).filter(F.expr(rule.having))
    out = _violation_rows(df, rule)
    return out.distinct() if rule.distinct else out


def _families(rules: Sequence[Rule]) -> list[tuple]:
    """Grouped rules that can share one aggregate: same key and filter, and
    no alias that stands for two expressions.  Each family is
    ``(group_by, filter, aggregates, [(position, rule)])``."""
    families: list[tuple] = []
    for i, r in enumerate(rules):
        if not r.grouped:
            continue
        for group_by, filt, aggs, members in families:
            agree = all(aggs.get(n, e) == e for n, e in r.agg.items())
            if (group_by, filt) == (r.group_by, r.filter) and agree:
                aggs.update(r.agg)
                members.append((i, r))
                break
        else:
            families.append((r.group_by, r.filter, dict(r.agg), [(i, r)]))
    return families


def evaluate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: ``(rule, position, violations)``.

    Row rules and distinct rules share one global aggregate; grouped rules
    with the same key and filter, whose aliases agree, share one grouped
    aggregate whose groups are then counted per rule.
    """
    parts: list[DataFrame] = []
    flat = [(i, r) for i, r in enumerate(rules) if not r.grouped]
    if flat:
        aggs = []
        for i, r in flat:
            if r.distinct:
                # A struct is non-NULL even when a member is NULL, so this
                # counts exactly the rows ``violations(df, r)`` returns.
                value = F.struct(*[F.col(c) for c in r.columns])
                aggs.append(F.count_distinct(F.when(F.expr(r.violation), value)).alias(f"r{i}"))
            else:
                aggs.append(F.count_if(F.expr(r.violation)).alias(f"r{i}"))
        one = df.agg(*aggs)
        parts.append(stack_rows(one, [(F.lit(r.name), F.lit(i), F.col(f"r{i}")) for i, r in flat], REPORT_COLUMNS))
    for group_by, filt, aggs, members in _families(rules):
        rows = df.filter(F.expr(filt)) if filt else df
        grouped = rows.groupBy(*group_by).agg(*[F.expr(e).alias(n) for n, e in aggs.items()])
        counts = grouped.agg(*[F.count_if(F.expr(r.having)).alias(f"r{i}") for i, r in members])
        parts.append(
            stack_rows(counts, [(F.lit(r.name), F.lit(i), F.col(f"r{i}")) for i, r in members], REPORT_COLUMNS)
        )
    if not parts:
        return df.sparkSession.createDataFrame([], "rule string, position int, violations bigint")
    report = reduce(DataFrame.unionByName, parts)
    return report.select(F.col("rule"), F.col("position").cast("int"), F.col("violations").cast("bigint"))


def enforce(report: DataFrame) -> list[tuple[str, int]]:
    """Collect the (one row per rule) report and raise ``QualityError`` when
    any rule has violations; returns the report rows otherwise."""
    rows = sorted(report.collect(), key=lambda r: r["position"])
    failures = [(r["rule"], int(r["violations"])) for r in rows if r["violations"]]
    if failures:
        raise QualityError(failures)
    return [(r["rule"], int(r["violations"])) for r in rows]


def observed_rules(rules: Sequence[Rule]) -> list[Rule]:
    """The rules that a write can count by itself: those about one row."""
    return [r for r in rules if not r.grouped]


def observe_rules(df: DataFrame, rules: Sequence[Rule], name: str = "rules") -> tuple[DataFrame, Observation]:
    """``df``, whose rows are counted while something is done with them
    (S9, D0, A6): all of them and those that each row rule objects to.  After
    the action, ``observed_counts`` has the counts; no scan of their own.

    Put it last before a write: there the counts are those of the tasks whose
    output is kept, whatever was tried twice.
    """
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    counts = [F.count_if(F.expr(r.violation)).alias(f"r{i}") for i, r in enumerate(observed_rules(rules))]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def observed_counts(seen: Observation, rules: Sequence[Rule]) -> tuple[int, dict[str, int]]:
    """(rows, offending rows per row rule) of an ``observe_rules`` whose
    action is over."""
    got = seen.get
    return int(got["rows"]), {r.name: int(got[f"r{i}"]) for i, r in enumerate(observed_rules(rules))}


def captured(df: DataFrame, rules: Sequence[Rule], fired: set[str] | None = None) -> DataFrame:
    """What each rule objects to, ``(rule, row)`` with the row as JSON, like
    ``violation_rows`` but in one scan for all row rules and one for each
    family of grouped rules (D0).

    Each offending row carries the rules that fired and is exploded once;
    groups likewise.  ``fired``: names of the row rules known to have offending
    rows (from ``observe_rules``); the others are not looked for.
    """
    parts = []
    flat = [r for r in rules if not r.grouped and (fired is None or r.name in fired)]
    if flat:
        hits = [
            F.when(
                F.expr(r.violation),
                F.struct(
                    F.lit(r.name).alias("rule"),
                    F.to_json(F.struct(*(r.columns or df.columns))).alias("row"),
                    F.lit(r.distinct).alias("once"),
                ),
            )
            for r in flat
        ]
        offending = reduce(lambda a, b: a | b, [F.coalesce(F.expr(r.violation), F.lit(False)) for r in flat])
        each = df.filter(offending).select(F.explode(F.array_compact(F.array(*hits))).alias("hit"))
        rows = each.select("hit.rule", "hit.row", "hit.once")
        if any(r.distinct for r in flat):
            # A distinct rule has each value once; other rows stay as many as they are.
            many = F.when(~F.col("once"), F.monotonically_increasing_id())
            rows = rows.withColumn("__n", many).distinct()
        parts.append(rows.select("rule", "row"))
    for group_by, filt, aggs, members in _families(rules):
        rows = df.filter(F.expr(filt)) if filt else df
        grouped = rows.groupBy(*group_by).agg(*[F.expr(e).alias(n) for n, e in aggs.items()])
        hits = [
            F.when(
                F.expr(r.having),
                F.struct(F.lit(r.name).alias("rule"), F.to_json(F.struct(*r.group_by, *r.agg)).alias("row")),
            )
            for _, r in members
        ]
        parts.append(grouped.select(F.explode(F.array_compact(F.array(*hits))).alias("hit")).select("hit.rule", "hit.row"))
    if not parts:
        return df.sparkSession.createDataFrame([], "rule string, row string")
    return reduce(DataFrame.unionByName, parts)


def key_collisions(df: DataFrame, key: str, parts: Sequence[str], name: str = "key") -> DataFrame:
    """Built keys that stand for more than one tuple of their parts (edges 12
    and 13 of P6, P10, P11): ``(key, tuples, least, most)``, the number of
    tuples and two of them as JSON, in which a NULL part is left out.

    Tuples are told apart exactly, by grouping on the parts themselves; pairs
    of key and tuple are counted with map-side partials.
    """
    pairs = df.select(F.expr(key).alias(name), *[F.expr(p).alias(f"p{i}") for i, p in enumerate(parts)]).distinct()
    shared = pairs.groupBy(name).agg(F.count(F.lit(1)).alias("tuples")).filter(F.col("tuples") > 1)
    spelled = F.to_json(F.struct(*[F.col(f"p{i}").alias(p) for i, p in enumerate(parts)]))
    return pairs.join(shared, on=name).groupBy(name, "tuples").agg(F.min(spelled).alias("least"), F.max(spelled).alias("most"))


def violation_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """What each rule objects to, as ``(rule, row)`` with the row as JSON:
    one table for rules of different columns."""
    parts = [
        found.select(F.lit(r.name).alias("rule"), F.to_json(F.struct(*found.columns)).alias("row"))
        for r in rules
        for found in [violations(df, r)]
    ]
    return reduce(DataFrame.unionByName, parts)


def pk_duplicates(df: DataFrame, key: Sequence[str], count_name: str = "n") -> DataFrame:
    """Key values that occur more than once, with their count (K1)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias(count_name)).filter(F.col(count_name) > 1)


def fk_orphans(
    child: DataFrame,
    columns: Sequence[str],
    parent: DataFrame,
    parent_columns: Sequence[str] | None = None,
    count_name: str = "n",
) -> DataFrame:
    """Child key values with no parent row, with the number of child rows
    carrying each (K2).

    The child side is pre-aggregated to one row per key (partial aggregation
    collapses a hot key before any shuffle), then anti-joined to the parent
    keys.  A key with a NULL part is not an orphan (SQL MATCH SIMPLE).
    """
    parent_columns = list(parent_columns or columns)
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    keys = child.filter(present).groupBy(*columns).agg(F.count(F.lit(1)).alias(count_name))
    parents = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_columns, columns)])
    return keys.join(parents, on=list(columns), how="left_anti")


def null_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """Per-column NULL counts against a contract (K3), in one aggregate:
    ``(column, position, nullable, nulls, violated)``."""
    fields = [f for f in contract.schema.fields if f.name in df.columns]
    one = df.agg(*[F.count_if(F.col(f.name).isNull()).alias(f"c{i}") for i, f in enumerate(fields)])
    out = stack_rows(
        one,
        [(F.lit(f.name), F.lit(i), F.lit(f.nullable), F.col(f"c{i}")) for i, f in enumerate(fields)],
        ("column", "position", "nullable", "nulls"),
    )
    return out.select(
        "column",
        F.col("position").cast("int"),
        "nullable",
        F.col("nulls").cast("bigint"),
        (~F.col("nullable") & (F.col("nulls") > 0)).alias("violated"),
    )
