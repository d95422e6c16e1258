"""Projection and cleaning operators.

All are single ``select`` projections: Catalyst collapses the chain into one
Project next to the scan, so cleaning costs no extra pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tallymart.functions.codes import pad_code


def string_columns(df: DataFrame, columns: Iterable[str] | None = None) -> list[str]:
    wanted = None if columns is None else set(columns)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, StringType) and (wanted is None or f.name in wanted)
    ]


def project(df: DataFrame, mapping: Mapping[str, str] | Iterable[str]) -> DataFrame:
    """Column subset and rename in one projection.

    ``mapping`` is either a list of names to keep or ``{source: target}``;
    order follows the mapping.
    """
    if isinstance(mapping, Mapping):
        return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])
    return df.select(*mapping)


# Leading/trailing Unicode white space (NBSP included) for ``unicode=True``.
UNICODE_EDGES = r"(?U)^\s+|\s+$"


def trim_sentinel(
    df: DataFrame, sentinel: str = "\\N", columns: Iterable[str] | None = None, unicode: bool = False
) -> DataFrame:
    """Trim string columns and turn the sentinel into NULL.

    By default only U+0020 is trimmed (tab and NBSP survive, as in the
    original process); ``unicode=True`` strips any Unicode white space.  Only
    string columns are touched, so audit columns such as a TIMESTAMP keep
    their type.
    """
    targets = set(string_columns(df, columns))
    out = []
    for name in df.columns:
        if name in targets:
            t = F.regexp_replace(F.col(name), UNICODE_EDGES, "") if unicode else F.trim(F.col(name))
            out.append(F.when(t == F.lit(sentinel), F.lit(None)).otherwise(t).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def blank_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Empty string -> NULL on string columns; other types untouched."""
    targets = set(string_columns(df, columns))
    return df.select(
        *[F.nullif(F.col(n), F.lit("")).alias(n) if n in targets else F.col(n) for n in df.columns]
    )


def pad_codes(df: DataFrame, widths: Mapping[str, int], fill: str = "0") -> DataFrame:
    """Normalise code columns to fixed width (P5), see ``pad_code``."""
    return df.withColumns({c: pad_code(c, w, fill) for c, w in widths.items()})


def align(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Order columns by name (P12): fails loudly on a missing column instead
    of shifting values like a positional insert would."""
    return df.select(*names)
