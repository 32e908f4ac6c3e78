"""Column order, types and comments of tables, from the column dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tablecheck.functions.names import field, same_text


def reorder_alphabetically(columns_df: DataFrame, database: str) -> DataFrame:
    """Number each table's columns by name, for one database in any letter case.

    Deleted columns are numbered too. The numbering is written in the same pass:
    rows of other databases, and rows without a table or column name, keep their
    ordinal. A window holds the columns of one table. Two rows for the same
    column are an error, as in a merge.
    """
    chosen = F.coalesce(same_text("database", F.lit(database)), F.lit(False))
    table = Window.partitionBy("__chosen", "table_id").orderBy("column_name")
    name = F.col("column_name")
    twice = F.raise_error(F.concat(F.lit("column listed twice: "), "table_id", F.lit("."), name))
    listed = F.col("__chosen") & F.col("table_id").isNotNull() & name.isNotNull()
    ordinal = (
        F.when(~listed, F.col("ordinal_position"))
        .otherwise(F.row_number().over(table))
    )
    kind = columns_df.schema["ordinal_position"].dataType
    return (
        columns_df.withColumn("__chosen", chosen)
        .withColumn("ordinal_position", ordinal.cast(kind))
        .withColumn("__before", F.when(listed, F.lag(name).over(table)))
        # a filter, since a projected check is pruned away under count()
        .where(F.when(F.col("__before") == name, twice.cast("boolean")).otherwise(F.lit(True)))
        .select(*columns_df.columns)
    )


class Layout:
    """The dictionary's word on the tables of one database, or on one of them.

    Holds dictionary rows on the driver: no more than the catalog lists there
    for the same tables.
    """

    def __init__(
        self,
        columns_df: DataFrame,
        tables_df: DataFrame,
        database: str,
        table: str | None = None,
    ) -> None:
        chosen = (F.col("is_deleted") == False) & same_text("database", F.lit(database))  # noqa: E712
        if table is not None:
            chosen = chosen & same_text("table", F.lit(table))
        self.database = database
        self._views = {
            row["table"].lower(): bool(row["is_view"])
            for row in tables_df.where(chosen).select("table", "is_view").collect()
        }
        self._columns: dict[str, list] = {}
        rows = columns_df.where(chosen).orderBy("table", "ordinal_position", "column_name")
        for row in rows.select("table", "column_name", "data_type", "description").collect():
            self._columns.setdefault(row["table"].lower(), []).append(row)

    def is_view(self, table: str) -> bool:
        """Whether the dictionary knows the table as a view; unknown is an error."""
        try:
            return self._views[table.lower()]
        except KeyError:
            raise KeyError(f"{self.database}.{table} is not in the table dictionary") from None

    def apply(self, df: DataFrame, table: str) -> DataFrame:
        """The table's columns in order, with types and comments; a view as it is."""
        if self.is_view(table):
            return df
        rows = self._columns.get(table.lower())
        if not rows:
            raise KeyError(f"{self.database}.{table} has no columns in the dictionary")
        return df.select(
            *[
                field(row["column_name"])
                .cast(row["data_type"])
                .alias(
                    row["column_name"],
                    metadata={"comment": row["description"]} if row["description"] else {},
                )
                for row in rows
            ]
        )


def apply_layout(
    df: DataFrame, columns_df: DataFrame, tables_df: DataFrame, database: str, table: str
) -> DataFrame:
    """Select the dictionary's columns in its order, with types and comments.

    Columns the dictionary marks deleted are left out. A view is returned as it
    is. Selection is by name, so data keeps its meaning.
    """
    return Layout(columns_df, tables_df, database, table).apply(df, table)
