"""Column expressions used by the operators."""

from tallymart.functions.codes import (
    clean_label,
    composite_id,
    flag,
    joined_key,
    lookup,
    matches,
    pad_code,
    path_key,
    row_kind,
    to_int,
)

__all__ = [
    "clean_label",
    "composite_id",
    "flag",
    "joined_key",
    "lookup",
    "matches",
    "pad_code",
    "path_key",
    "row_kind",
    "to_int",
]
