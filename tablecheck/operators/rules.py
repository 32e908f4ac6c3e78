"""Rules kept in the dictionary, and their compilation to Spark expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.functions.names import field, quote, same_text, split_key
from tablecheck.operators.rowchange import update_where

PASS = "PASS"


class Rule(NamedTuple):
    """One test of one column: a null test, or a length test if a length is given."""

    name: str
    column: str
    length: int | None = None

    @property
    def condition(self) -> str:
        """Expression that is true for a row that fails; NULL passes a length test."""
        column = quote(self.column)
        if self.length is None:
            return f"{column} IS NULL"
        return f"length(CAST({column} AS STRING)) != {int(self.length)}"

    def condition_on(self, schema: T.StructType) -> str:
        """The condition for a table of this schema: binary columns count bytes."""
        kinds = {f.name.lower(): f.dataType for f in schema}
        if self.length is not None and isinstance(
            kinds.get(self.column.lower()), T.BinaryType
        ):
            return f"length({quote(self.column)}) != {int(self.length)}"
        return self.condition

    @property
    def result(self) -> Column:
        """The test's name for a failing row, else ``PASS``."""
        return F.when(F.expr(self.condition), F.lit(self.name)).otherwise(F.lit(PASS))


def null_rules(columns_df: DataFrame) -> DataFrame:
    """Active null tests: ``database, table, column_name, test_name``."""
    return columns_df.where((F.col("null_test") == True) & (F.col("is_deleted") == False)).select(  # noqa: E712
        "database",
        "table",
        "column_name",
        F.concat_ws(".", "column_id", F.lit("is_null")).alias("test_name"),
    )


def length_rules(columns_df: DataFrame) -> DataFrame:
    """Active length tests: ``database, table, column_name, length_test, test_name``."""
    return columns_df.where(
        F.col("length_test").isNotNull() & (F.col("is_deleted") == False)  # noqa: E712
    ).select(
        "database",
        "table",
        "column_name",
        "length_test",
        F.concat("column_id", F.lit("."), F.lit("is_not_length_"), "length_test").alias("test_name"),
    )


def compile_rules(
    null_df: DataFrame | None,
    length_df: DataFrame | None,
    database: str,
    table: str,
) -> list[Rule]:
    """Rules of one table, null tests first, each kind in name order.

    The table is picked in any letter case. Only its rule rows reach the driver,
    at most one of each kind per column.
    """
    rules = []
    for row in _rows_of(null_df, database, table):
        rules.append(Rule(_named(row), row["column_name"]))
    for row in _rows_of(length_df, database, table):
        rules.append(Rule(_named(row), row["column_name"], row["length_test"]))
    return rules


def resolve_key(tables_df: DataFrame, database: str, table: str, column: str = "Key") -> list[str]:
    """Key columns of a table, from dictionary text such as ``order_id;line``."""
    found = _rows_of(tables_df.select("database", "table", field(column).alias(column)), database, table)
    keys = split_key(found[0][column] or "") if found else []
    if not keys:
        raise KeyError(f"no key for {database}.{table} in the table dictionary")
    return keys


def set_key(
    tables_df: DataFrame,
    tables: Sequence[str],
    key: str | Iterable[str],
    databases: Sequence[str] | None = None,
) -> DataFrame:
    """Name the key columns of the listed tables, in all databases or in these."""
    text = key if isinstance(key, str) else ";".join(key)
    return update_where(tables_df, _named_in("table", tables, databases), {"Key": text})


def set_length_test(
    columns_df: DataFrame,
    columns: Sequence[str],
    length: int,
    databases: Sequence[str] | None = None,
) -> DataFrame:
    """Ask for a text length in every column of these names, in all databases or in these."""
    return update_where(
        columns_df, _named_in("column_name", columns, databases), {"length_test": length}
    )


def set_null_test(
    columns_df: DataFrame,
    columns: Sequence[str],
    wanted: bool = True,
    databases: Sequence[str] | None = None,
) -> DataFrame:
    """Ask for a null test in every column of these names, in all databases or in these."""
    return update_where(
        columns_df, _named_in("column_name", columns, databases), {"null_test": wanted}
    )


def _named_in(column: str, names: Sequence[str], databases: Sequence[str] | None) -> Column:
    chosen = F.col(column).isin(list(names))
    if databases is not None:
        chosen = chosen & F.lower("database").isin([d.lower() for d in databases])
    return chosen


def _rows_of(df: DataFrame | None, database: str, table: str) -> list:
    if df is None:
        return []
    picked = df.where(
        same_text("database", F.lit(database)) & same_text("table", F.lit(table))
    ).collect()
    order = "test_name" if "test_name" in df.columns else "table"
    return sorted(picked, key=lambda row: row[order] or "")


def _named(row) -> str:
    if row["test_name"] is None:
        raise ValueError(f"test of column {row['column_name']} has no name: its column_id is NULL")
    return row["test_name"]
