"""Frozen specs that drive every operator.

Each operator in the library is a ``DataFrame -> DataFrame`` function whose
behaviour is fixed by one of these small, immutable objects.  Predicates are
kept as Spark SQL expression strings so a spec stays declarative, printable
and free of live ``Column`` objects.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql.types import StructType


def text_schema(fields: Iterable[str]) -> StructType:
    """A schema of nullable text fields, in the order given."""
    schema = StructType()
    for name in fields:
        schema.add(name, "string")
    return schema


@dataclass(frozen=True)
class SourceSpec:
    """How to read a family of delimited text files.

    ``source_pattern`` is a regex with one group applied to the URL-decoded
    file path; the group is the source id (a district code, a partition value).
    ``mode`` is PERMISSIVE by default so malformed files can be quarantined per
    source instead of failing the whole scan.  ``placement`` is an optional
    SQL predicate over a row and its ``_source`` that says the row is in its
    own file, e.g. ``lpad(dist_codigo, 2, '0') = _source``; a source with a row
    that is not, is MISPLACED and kept out.
    """

    schema: StructType
    sep: str = "|"
    encoding: str = "ISO-8859-1"
    quote: str = '"'
    header: bool = False
    mode: str = "PERMISSIVE"
    source_pattern: str | None = None
    placement: str | None = None
    corrupt_column: str = "_corrupt_record"


@dataclass(frozen=True)
class KeySpec:
    """Composite fixed-width id (P6): coalesced parts + suffix."""

    parts: tuple[str, ...]
    placeholders: Mapping[str, str]
    suffix: str = "X"
    output: str = "id"

    @property
    def length(self) -> int:
        return sum(len(self.placeholders[p]) for p in self.parts) + len(self.suffix)


@dataclass(frozen=True)
class KindSpec:
    """Row kind (P9): ``yes`` when ``code`` is in ``codes`` else ``no``."""

    code: str
    codes: tuple[str, ...]
    yes: str = "MESA"
    no: str = "AGRUPACION"
    output: str = "registro"


@dataclass(frozen=True)
class ClassRule:
    """One entity flag: the entity gets ``label`` if any of its rows satisfies
    ``predicate`` (a Spark SQL boolean expression over row columns)."""

    label: str
    predicate: str


@dataclass(frozen=True)
class ClassSpec:
    """Prioritised entity classification (W1, W2): first matching rule wins."""

    key: tuple[str, ...]
    rules: tuple[ClassRule, ...]
    otherwise: str = "NORMAL"
    output: str = "tipo_mesa"


@dataclass(frozen=True)
class MeasureRowSpec:
    """Turn a measure column into an extra row.

    For every row where ``when`` holds, emit a copy with ``set_values`` applied
    (column -> SQL expression evaluated on the source row) and ``measure``
    moved into ``target`` with NULL replaced by ``fill``.  The measure column
    is dropped afterwards.
    """

    when: str
    measure: str
    target: str
    set_values: Mapping[str, str]
    fill: int | None = 0


@dataclass(frozen=True)
class Rule:
    """A data-quality rule.

    Row rules count rows satisfying ``violation``.  Grouped rules first
    ``filter`` rows, aggregate ``agg`` per ``group_by`` and count groups
    satisfying ``having``.  Distinct rules count distinct ``columns`` values
    among violating rows.
    """

    name: str
    violation: str | None = None
    columns: tuple[str, ...] = ()
    filter: str | None = None
    group_by: tuple[str, ...] = ()
    agg: Mapping[str, str] = field(default_factory=dict)
    having: str | None = None
    distinct: bool = False

    @property
    def grouped(self) -> bool:
        return bool(self.group_by)


@dataclass(frozen=True)
class DimSpec:
    """A fact or dimension (G1-G7): output column -> SQL expression.

    Rows are kept where every ``not_null`` source column is present (and
    ``filter`` holds), projected, made distinct when ``distinct`` is set, and
    finally ``lookups`` (output -> (code column, literal map)) are applied to
    the distinct rows only.  With ``one_per`` (output columns that make a key)
    a key has one row: of its spellings in the other columns the most frequent
    one (ties: present before NULL, then least by code point).
    """

    columns: Mapping[str, str]
    not_null: tuple[str, ...] = ()
    filter: str | None = None
    distinct: bool = True
    lookups: Mapping[str, tuple[str, Mapping[str, str]]] = field(default_factory=dict)
    one_per: tuple[str, ...] = ()


@dataclass(frozen=True)
class SummarySpec:
    """Pivoted summary mart.

    ``totals`` maps a code to the output column name; rows whose ``kind``
    equals ``totals_kind`` are pivoted, rows of ``lists_kind`` are summed into
    ``lists_sum`` and counted into ``lists_count``.  ``one_spelling`` gives a
    join key one row, with the most frequent tuple of attributes among its
    totals rows, where the mart has one row per tuple otherwise.
    """

    join_keys: tuple[str, ...]
    attributes: tuple[str, ...]
    code: str
    measure: str
    totals: Mapping[str, str]
    kind: str = "registro"
    totals_kind: str = "MESA"
    lists_kind: str = "AGRUPACION"
    lists_sum: str = "votos_afirmativos"
    lists_count: str = "listas"
    output_order: tuple[str, ...] = ()
    one_spelling: bool = False


@dataclass(frozen=True)
class Contract:
    """Target table contract (S8): ordered columns with types and nullability,
    plus an optional primary key and partition columns."""

    name: str
    schema: StructType
    primary_key: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def not_null(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]


@dataclass(frozen=True)
class ForeignKey:
    """Referential rule (K2): child.columns -> parent.columns."""

    child: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class TallySpec:
    """Everything a bronze -> silver -> gold run needs, in one value."""

    source: SourceSpec
    bronze_columns: tuple[str, ...]
    rename: Mapping[str, str]
    widths: Mapping[str, int]
    id_key: KeySpec
    label_output: str
    label_parts: tuple[str, ...]
    int_columns: tuple[str, ...]
    kind: KindSpec
    classes: ClassSpec
    measure_row: MeasureRowSpec
    categories: tuple[str, ...]
    rules: tuple[Rule, ...]
    silver: Contract
    fact: DimSpec
    dims: Mapping[str, DimSpec]
    summary: SummarySpec
    gold: Mapping[str, Contract]
    foreign_keys: tuple[ForeignKey, ...] = ()
    bronze_partition: str | None = None
    sentinel: str = "\\N"
    label_unicode: bool = False
