"""Column expressions shared by the operators."""

from tablecheck.functions.missing import mark_missing, normalize_missing
from tablecheck.functions.names import (
    any_null,
    column_id,
    field,
    quote,
    same_text,
    split_key,
    table_id,
)
from tablecheck.functions.properties import parse_properties

__all__ = [
    "any_null",
    "column_id",
    "field",
    "mark_missing",
    "normalize_missing",
    "parse_properties",
    "quote",
    "same_text",
    "split_key",
    "table_id",
]
