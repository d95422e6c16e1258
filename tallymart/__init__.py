"""tallymart: delimited tally files -> audited bronze/silver/gold tables,
as Spark DataFrame operators driven by small frozen specs."""

from tallymart.spec import (
    ClassRule,
    ClassSpec,
    Contract,
    DimSpec,
    ForeignKey,
    KeySpec,
    KindSpec,
    MeasureRowSpec,
    Rule,
    SourceSpec,
    SummarySpec,
    TallySpec,
)

__all__ = [
    "ClassRule",
    "ClassSpec",
    "Contract",
    "DimSpec",
    "ForeignKey",
    "KeySpec",
    "KindSpec",
    "MeasureRowSpec",
    "Rule",
    "SourceSpec",
    "SummarySpec",
    "TallySpec",
]
__version__ = "0.1.0"
