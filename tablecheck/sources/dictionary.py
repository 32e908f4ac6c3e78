"""Schemas of the dictionary tables and the registry."""

from __future__ import annotations

from pyspark.sql import types as T

_STRING, _BOOL, _LONG = T.StringType(), T.BooleanType(), T.LongType()

COLUMN_DICTIONARY = T.StructType(
    [
        T.StructField("column_id", _STRING),
        T.StructField("table_id", _STRING),
        T.StructField("database", _STRING),
        T.StructField("table", _STRING),
        T.StructField("column_name", _STRING),
        T.StructField("description", _STRING),
        T.StructField("data_type", _STRING),
        T.StructField("nullable", _BOOL),
        T.StructField("is_partitioned", _BOOL),
        T.StructField("ordinal_position", T.IntegerType()),
        T.StructField("is_deleted", _BOOL),
    ]
)

# Counts and sizes are bigint: an int overflows on a table above 2 GiB.
TABLE_DICTIONARY = T.StructType(
    [
        T.StructField("table_id", _STRING),
        T.StructField("database", _STRING),
        T.StructField("table", _STRING),
        T.StructField("description", _STRING),
        T.StructField("create_statement", _STRING),
        T.StructField("update_crawler", _STRING),
        T.StructField("are_columns_quoted", _BOOL),
        T.StructField("classification", _STRING),
        T.StructField("columns_ordered", _STRING),
        T.StructField("compression_type", _STRING),
        T.StructField("delimiter", _STRING),
        T.StructField("object_count", _LONG),
        T.StructField("record_count", _LONG),
        T.StructField("size_key", _LONG),
        T.StructField("skip_line", _LONG),
        T.StructField("type_data", _STRING),
        T.StructField("location", _STRING),
        T.StructField("is_view", _BOOL),
        T.StructField("is_deleted", _BOOL),
    ]
)

LANDED_COLUMNS = T.StructType(
    [
        T.StructField("column_id", _STRING),
        T.StructField("table_id", _STRING),
        T.StructField("database", _STRING),
        T.StructField("table", _STRING),
        T.StructField("columnName", _STRING),
        T.StructField("description", _STRING),
        T.StructField("dataType", _STRING),
        T.StructField("nullable", _BOOL),
        T.StructField("isPartitioned", _BOOL),
        T.StructField("isBucket", _BOOL),
        T.StructField("ordinalPosition", T.IntegerType()),
    ]
)

# Columns the quality run adds to the two dictionaries.
COLUMN_RULES = {"null_test": "boolean", "length_test": "int"}
TABLE_KEY = {"Key": "string"}

REGISTRY = T.StructType(
    [
        T.StructField("database", _STRING),
        T.StructField("table", _STRING),
        T.StructField("column_name", _STRING),
        T.StructField("test_name", _STRING),
        T.StructField("is_block", _BOOL),
        T.StructField("is_deleted", _BOOL),
    ]
)

LEDGER = T.StructType([T.StructField("folder", _STRING)])
