"""Land what the catalog and the data say about tables.

Landed relations keep one row per column (``landed_columns`` shape) or table
(``landed_tables`` shape). Catalog calls run on the driver, one table at a time;
whatever is measured is measured by Spark over the data.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.functions.missing import normalize_missing
from tablecheck.functions.names import field, quote, table_id
from tablecheck.operators.rowchange import sync
from tablecheck.sources import folders
from tablecheck.sources.dictionary import LANDED_COLUMNS
from tablecheck.sources.footers import null_counts
from tablecheck.sources.tables import local_rows, quoted, table_description

# Names of the properties that file crawlers set on a table.
PROPERTY_NAMES = {
    "classification": "classification",
    "updateCrawler": "UPDATED_BY_CRAWLER",
    "areColumnsQuoted": "areColumnsQuoted",
    "columnsOrdered": "columnsOrdered",
    "compressionType": "compressionType",
    "delimiter": "delimiter",
    "skipLine": "skip.header.line.count",
    "typeData": "typeOfData",
}

# Providers that are files below a location.
_FILE_FORMATS = ("parquet", "orc", "csv", "json", "text", "avro", "hive")

_MEASURED = ("objectCount", "recordCount", "sizeKey")

# Texts that count as missing in landed table facts.
_NONE, _ANY_NONE = ("None",), ("None", "none")


def land_columns(
    df: DataFrame,
    database: str,
    table: str,
    measure: bool = True,
    partition_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    nullable: Mapping[str, bool] | None = None,
    known_nulls: Mapping[str, int] | None = None,
) -> DataFrame:
    """One row per column of ``df``, numbered from 1, with ids and flags.

    ``measure=True`` adds ``null_count``, because files declare every column nullable.
    NULLs that ``known_nulls`` tells are taken from there; those of the other columns are
    counted in one pass that reads these columns only.
    """
    known = known_nulls or {}
    rows = [
        {
            "column_id": ".".join([database, table, f.name]),
            "table_id": f"{database}.{table}",
            "database": database,
            "table": table,
            "columnName": f.name,
            "description": f.metadata.get("comment"),
            "dataType": f.dataType.simpleString(),
            "nullable": (nullable or {}).get(f.name, f.nullable),
            "isPartitioned": f.name in partition_by,
            "isBucket": f.name in bucket_by,
            "ordinalPosition": ordinal,
            "null_count": known.get(f.name),
        }
        for ordinal, f in enumerate(df.schema, start=1)
    ]
    if not measure:
        return local_rows(df.sparkSession, rows, LANDED_COLUMNS)
    kind = T.StructType([*LANDED_COLUMNS, T.StructField("null_count", T.LongType())])
    open_ = [name for name in df.columns if name not in known]
    if not open_:
        return local_rows(df.sparkSession, rows, kind)
    counts = F.map_from_arrays(
        F.lit(open_), F.array(*[F.count(F.lit(1)) - F.count(quote(name)) for name in open_])
    )
    counted = df.agg(counts.alias("__nulls"))
    facts = F.from_json(F.lit(json.dumps(rows)), T.ArrayType(kind))
    return counted.select("*", F.inline(facts)).select(
        *LANDED_COLUMNS.names,
        F.coalesce("null_count", F.try_element_at("__nulls", "columnName")).alias("null_count"),
    )


def land_file_columns(
    spark: SparkSession, path: str, database: str, table: str, measure: bool = True, **flags
) -> DataFrame:
    """Columns of the Parquet files below ``path``, as ``land_columns`` gives them.

    NULLs come from the files' footers. Only columns that these don't tell are read:
    nested ones, and those of which a chunk lacks statistics.
    """
    df = spark.read.parquet(path)
    told = null_counts(spark, path, df) if measure else None
    return land_columns(df, database, table, measure, known_nulls=told, **flags)


def land_database_columns(
    spark: SparkSession, databases: Sequence[str], measure: bool = False
) -> DataFrame:
    """Columns of every non-temporary table of the databases."""
    landed = []
    for database, table in list_tables(spark, databases):
        name = quoted(f"{database}.{table}")
        columns = spark.catalog.listColumns(name)
        df = spark.table(name)
        told = None
        if measure:
            found = table_description(spark, f"{database}.{table}")
            if found.get("provider", "").lower() == "parquet" and found.get("location"):
                told = null_counts(spark, found["location"], df)
                for column in found.get("partition_columns", []):
                    told.pop(column, None)
        landed.append(
            land_columns(
                df,
                database,
                table,
                measure=measure,
                partition_by=[c.name for c in columns if c.isPartition],
                bucket_by=[c.name for c in columns if c.isBucket],
                nullable={c.name: c.nullable for c in columns},
                known_nulls=told,
            )
        )
    return _union(landed)


def land_tables(
    spark: SparkSession,
    tables: Mapping[tuple[str, str], DataFrame | str | None],
) -> DataFrame:
    """Facts of each table: measured record count, file count and size, and properties.

    ``tables`` maps (database, table) to the data, to a path, or to ``None`` for
    the catalog table of that name. Files of a path or a catalog table are counted and
    sized from their listing, empty ones too; records are counted without reading any
    column, where files keep row counts from those. Of data given as a relation, files
    without rows are not seen. The number of shuffles does not grow with the number of
    tables. Views, tables whose files are gone and tables that are not files land with
    zero counts.
    """
    described, records, places, scanned = [], [], [], []
    for (database, table), given in tables.items():
        number = len(described)
        found: dict = {}
        if given is None:
            found = table_description(spark, f"{database}.{table}")
            if found.get("provider", "").lower() in _FILE_FORMATS and found.get("location"):
                if folders.exists(spark, found["location"]):
                    places.append((found["location"], number))
                    records.append(spark.table(quoted(f"{database}.{table}")).select(F.lit(number).alias("number")))
        elif isinstance(given, str):
            found = {"provider": "parquet", "location": given}
            if folders.exists(spark, given):
                places.append((given, number))
                # only the records are counted, so no schema has to be inferred
                rows = spark.read.schema(T.StructType([])).parquet(given)
                records.append(rows.select(F.lit(number).alias("number")))
        else:
            scanned.append(
                given.selectExpr(
                    f"{number} AS number", "_metadata.file_path AS path", "_metadata.file_size AS size"
                )
            )
        described.append(
            {
                "number": number,
                "database": database,
                "table": table,
                "known": found.get("table_properties", {}),
                "provider": found.get("provider"),
                "location": found.get("location"),
                "is_view": found.get("type") == "VIEW",
                "description": found.get("comment"),
            }
        )
    facts = local_rows(
        spark,
        described,
        "number int, database string, table string, known map<string,string>, provider string, "
        "location string, is_view boolean, description string",
    )
    zero = F.lit(0).cast("long")
    parts = []
    if places:
        counted = _union(records).groupBy("number").agg(F.count(F.lit(1)).alias("recordCount"))
        bases = [{"base": folders.base_of(spark, place), "number": n} for place, n in places]
        files = folders.listed(spark, [place for place, _ in places]).where(~F.col("is_folder"))
        # two tables may share a location
        sized = (
            files.groupBy("base")
            .agg(F.count(F.lit(1)).alias("objectCount"), F.sum("length").alias("sizeKey"))
            .join(local_rows(spark, bases, "base string, number int"), "base")
            .drop("base")
        )
        parts.append(counted.join(sized, "number", "full"))
    if scanned:
        parts.append(measure_files(_union(scanned), ["number"]))
    if parts:
        measured = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        facts = facts.join(measured, "number", "left")
    else:
        facts = facts.select("*", *[zero.alias(c) for c in _MEASURED])
    return facts.selectExpr(
        "database",
        "table",
        *[f"known['{PROPERTY_NAMES[n]}'] AS {n}" for n in ("updateCrawler", "areColumnsQuoted")],
        "coalesce(CAST(try_divide(sizeKey, recordCount) AS BIGINT), 0L) AS avgRecordSize",
        f"coalesce(known['{PROPERTY_NAMES['classification']}'], provider) AS classification",
        *[
            f"known['{PROPERTY_NAMES[n]}'] AS {n}"
            for n in ("columnsOrdered", "compressionType", "delimiter")
        ],
        *[f"coalesce({c}, 0L) AS {c}" for c in _MEASURED],
        f"coalesce(try_cast(known['{PROPERTY_NAMES['skipLine']}'] AS BIGINT), 0L) AS skipLine",
        f"known['{PROPERTY_NAMES['typeData']}'] AS typeData",
        "location",
        "is_view",
        "description",
    )


def land_database_tables(spark: SparkSession, databases: Sequence[str]) -> DataFrame:
    """Facts of every non-temporary table of the databases."""
    return land_tables(spark, {name: None for name in list_tables(spark, databases)})


def land_create_statements(spark: SparkSession, databases: Sequence[str]) -> DataFrame:
    """``database, table, createStatement`` of every non-temporary table."""
    rows = [
        {
            "database": d,
            "table": t,
            "createStatement": spark.sql(f"SHOW CREATE TABLE {quoted(f'{d}.{t}')}").first()[0],
        }
        for d, t in list_tables(spark, databases)
    ]
    return local_rows(spark, rows, "database string, table string, createStatement string")


def list_tables(spark: SparkSession, databases: Sequence[str]) -> list[tuple[str, str]]:
    """Non-temporary tables and views of the databases."""
    return [
        (database, t.name)
        for database in databases
        for t in spark.catalog.listTables(database)
        if not t.isTemporary
    ]


def stage_table_metadata(tables: DataFrame, creates: DataFrame) -> DataFrame:
    """Rows for the table dictionary: landed facts joined with create statements.

    Missing markers become NULL, for the two flags false. Numbers and flags that
    are not well-formed become NULL.
    """
    clean = normalize_missing(
        tables.join(creates, ["database", "table"]),
        {
            "description": _NONE,
            "delimiter": _NONE,
            "classification": _ANY_NONE,
            "compressionType": _ANY_NONE,
        },
    )

    def flag(name: str):
        text = F.coalesce(F.col(name).cast("string"), F.lit("None"))
        return F.when(text.isin(*_ANY_NONE), F.lit(False)).otherwise(text.try_cast("boolean"))

    def number(name: str):
        return F.col(name).cast("string").try_cast("bigint")

    return clean.select(
        table_id().alias("table_id"),
        "database",
        "table",
        "description",
        F.col("createStatement").alias("create_statement"),
        F.col("updateCrawler").alias("update_crawler"),
        flag("areColumnsQuoted").alias("are_columns_quoted"),
        "classification",
        flag("columnsOrdered").alias("columns_ordered"),
        F.col("compressionType").alias("compression_type"),
        "delimiter",
        number("objectCount").alias("object_count"),
        number("recordCount").alias("record_count"),
        number("sizeKey").alias("size_key"),
        number("skipLine").alias("skip_line"),
        F.col("typeData").alias("type_data"),
        "location",
        "is_view",
        F.lit(False).alias("is_deleted"),
    )


def sync_columns(
    dictionary: DataFrame, landed: DataFrame, scoped: bool = True, **options
) -> DataFrame:
    """Bring the column dictionary in line with landed columns.

    Both sides are bounded by what the catalog lists and hold a column once, so
    no split of frequent keys is planned unless asked for.
    """
    options = {"split_hot": False, **options}
    return sync(
        dictionary,
        landed,
        {"database": "database", "table": "table", "column_name": "columnName"},
        matched={
            "description": F.nullif(field("description", "s"), F.lit("None")),
            "ordinal_position": "ordinalPosition",
            "data_type": "dataType",
            "nullable": "nullable",
            "is_partitioned": "isPartitioned",
        },
        not_matched={
            "column_id": "column_id",
            "table_id": "table_id",
            "database": "database",
            "table": "table",
            "column_name": "columnName",
            "description": F.nullif(field("description", "s"), F.lit("None")),
            "ordinal_position": "ordinalPosition",
            "data_type": "dataType",
            "nullable": "nullable",
            "is_partitioned": "isPartitioned",
        },
        scope=["database"] if scoped else None,
        **options,
    )


def sync_tables(
    dictionary: DataFrame,
    staged: DataFrame,
    scoped: bool = True,
    refresh: Sequence[str] = (),
    **options,
) -> DataFrame:
    """Bring the table dictionary in line with staged tables.

    A known table keeps its description and header lines unless ``refresh`` names them.
    """
    names = [*_REFRESHED, *refresh]
    options = {"split_hot": False, **options}  # bounded by the catalog, as above
    return sync(
        dictionary,
        staged,
        ["database", "table"],
        matched={name: name for name in names},
        not_matched="*",
        scope=["database"] if scoped else None,
        **options,
    )


_REFRESHED = (
    "create_statement",
    "update_crawler",
    "are_columns_quoted",
    "classification",
    "columns_ordered",
    "compression_type",
    "delimiter",
    "object_count",
    "record_count",
    "size_key",
    "type_data",
    "location",
    "is_view",
)


def measure_files(scanned: DataFrame, by: Sequence[str]) -> DataFrame:
    """Record count, file count and total file size of each table.

    ``scanned`` holds one row per record with its file's ``path`` and ``size``.
    Rows are summed per file before the shuffle. Files without rows are not seen: those
    only ``land_tables`` finds, by their listing.
    """
    files = scanned.groupBy(*by, "path", "size").agg(F.count(F.lit(1)).alias("n"))
    return files.groupBy(*by).agg(
        F.sum("n").alias("recordCount"),
        F.count(F.lit(1)).alias("objectCount"),
        F.sum("size").alias("sizeKey"),
    )


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    """Union in a balanced tree, which keeps the plan shallow for many tables."""
    if not parts:
        raise ValueError("no tables to land")
    parts = list(parts)
    while len(parts) > 1:
        pairs = [parts[i : i + 2] for i in range(0, len(parts), 2)]
        parts = [p[0].unionByName(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return parts[0]
