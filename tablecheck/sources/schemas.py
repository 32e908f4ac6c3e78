"""The schema that all files of a landing fit, as the fold of their own schemas."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from tablecheck.functions.names import field
from tablecheck.sources import folders

# Digits of the whole numbers, from the narrowest type to the widest.
_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)
_FILES_PER_TASK = 64


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both; text where nothing else does.

    Whole numbers widen to the longer one, with decimals to a decimal of all digits, with
    floats to double; dates widen to timestamps. Arrays, maps and structs widen part by
    part; a struct has the fields of both.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if type(a) in _WHOLE and type(b) in _WHOLE:
        return max(a, b, key=lambda kind: _WHOLE[type(kind)])
    exact = [_decimal(kind) for kind in (a, b)]
    if all(exact):
        scale = max(d.scale for d in exact)
        digits = max(d.precision - d.scale for d in exact) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else T.StringType()
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    if isinstance(a, _TIMES) and isinstance(b, _TIMES):
        return max(a, b, key=lambda kind: _TIMES.index(type(kind)))
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_schema(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(common_type(a.keyType, b.keyType), common_type(a.valueType, b.valueType))
    return T.StringType()


def common_schema(a: T.StructType, b: T.StructType) -> T.StructType:
    """The fields of both, in the order they first come; names in any letter case are one."""
    other = {f.name.lower(): f for f in b}
    fields = []
    for f in a:
        g = other.pop(f.name.lower(), f)
        fields.append(T.StructField(f.name, common_type(f.dataType, g.dataType)))
    return T.StructType([*fields, *[T.StructField(g.name, g.dataType) for g in other.values()]])


def _decimal(kind: T.DataType) -> T.DecimalType | None:
    if isinstance(kind, T.DecimalType):
        return kind
    return T.DecimalType(_WHOLE[type(kind)], 0) if type(kind) in _WHOLE else None


def files_by_schema(spark: SparkSession, path: str, names: Sequence[str]) -> dict[str, list[str]]:
    """The Parquet files directly in these folders, by their schema as JSON.

    Schemas are in the order of the first file, by name, that has them. Footers are read in
    tasks; the driver holds file names, as it does for any file source. Empty for a store
    that Arrow cannot reach.
    """
    base, encoded = folders._qualified(spark, path)
    if not folders._reaches(encoded):
        return {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = folders._arrow(encoded)
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                found = [e[2] for e in folders._entries(store, root, base, folder) if not e[3]]
                kinds = []
                for path in found:
                    with store.open_input_file(root.rstrip("/") + path[len(base) :]) as file:
                        kinds.append(_schema_json(pq.ParquetFile(file)))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(kinds)], ["path", "kind"])

    level = spark.createDataFrame([(n,) for n in names], "folder string")
    tasks = max(1, -(-len(names) // _FILES_PER_TASK))
    rows = level.repartition(tasks).mapInArrow(run, "path string, kind string").collect()
    out: dict[str, list[str]] = {}
    for row in sorted(rows):
        out.setdefault(row["kind"], []).append(row["path"])
    return out


def _schema_json(file: pq.ParquetFile) -> str:
    """Spark's own note of the schema, where Spark wrote the file, else by its columns."""
    noted = (file.metadata.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
    return noted.decode() if noted else from_arrow_schema(file.schema_arrow).json()


def widest(schemas: Iterable[T.StructType]) -> T.StructType:
    return reduce(common_schema, schemas)


def fitted(df: DataFrame, schema: T.StructType) -> list:
    """The columns of ``schema`` from a relation that may lack some or have other types.

    A value that does not fit its column, and a column that is missing, is NULL.
    """
    known = {f.name.lower(): f for f in df.schema}
    out = []
    for f in schema:
        g = known.get(f.name.lower())
        if g is None:
            value = F.lit(None).cast(f.dataType)
        elif g.dataType == f.dataType:
            value = field(g.name)
        else:
            value = field(g.name).try_cast(f.dataType)
        out.append(value.alias(f.name))
    return out
