"""Names, derived ids and key helpers."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def quote(name: str) -> str:
    """A name in backticks, for use in expression text."""
    return "`" + name.replace("`", "``") + "`"


def field(name: str, alias: str | None = None) -> Column:
    """Column of exactly this name, whatever characters it holds."""
    return F.col(f"{alias}.{quote(name)}" if alias else quote(name))


def table_id(database: str | Column = "database", table: str | Column = "table") -> Column:
    """``database.table``; NULL when either part is NULL."""
    return F.concat(_col(database), F.lit("."), _col(table))


def column_id(
    database: str | Column = "database",
    table: str | Column = "table",
    column: str | Column = "column_name",
) -> Column:
    """``database.table.column``; NULL parts are left out."""
    return F.concat_ws(".", _col(database), _col(table), _col(column))


def same_text(left: str | Column, right: str | Column) -> Column:
    """Equality of two texts in any letter case; a plain string names a column."""
    return F.lower(_col(left)) == F.lower(_col(right))


def split_key(text: str) -> list[str]:
    """Key columns of a dictionary entry such as ``order_id;line``."""
    return [part.strip() for part in text.split(";") if part.strip()]


def any_null(columns: Iterable[Column]) -> Column:
    """True when at least one of the columns is NULL."""
    return reduce(lambda a, b: a | b, [c.isNull() for c in columns])


def _col(value: str | Column) -> Column:
    return field(value) if isinstance(value, str) else value
