"""DataFrame -> DataFrame operators."""

from tallymart.operators.classify import entity_class, entity_flags, row_kind
from tallymart.operators.clean import align, blank_to_null, pad_codes, project, trim_sentinel
from tallymart.operators.mart import list_aggregate, summary, summary_onepass, totals_pivot
from tallymart.operators.model import dimension, fact, lookup, lookup_table, one_spelling
from tallymart.operators.quality import (
    QualityError,
    captured,
    enforce,
    evaluate,
    fk_orphans,
    key_collisions,
    null_contract,
    observe_rules,
    observed_counts,
    pk_duplicates,
    violation_rows,
    violations,
)
from tallymart.operators.reshape import expand_measure, expand_measure_union, pivot_codes

__all__ = [
    "QualityError",
    "align",
    "blank_to_null",
    "captured",
    "dimension",
    "entity_class",
    "entity_flags",
    "enforce",
    "evaluate",
    "expand_measure",
    "expand_measure_union",
    "fact",
    "fk_orphans",
    "key_collisions",
    "list_aggregate",
    "lookup",
    "lookup_table",
    "null_contract",
    "observe_rules",
    "observed_counts",
    "one_spelling",
    "pad_codes",
    "pivot_codes",
    "pk_duplicates",
    "project",
    "row_kind",
    "summary",
    "summary_onepass",
    "totals_pivot",
    "trim_sentinel",
    "violation_rows",
    "violations",
]
