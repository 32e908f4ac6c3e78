"""What the footers of Parquet files tell of their columns, without reading the columns."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.sources import folders

_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
# Footers that one task reads.
_FILES_PER_TASK = 64


def null_counts(spark: SparkSession, path: str, df: DataFrame) -> dict[str, int]:
    """NULLs of those columns of the files below ``path`` for which all footers tell them.

    ``df`` is the relation read from the files. A column that a file lacks is NULL in all
    its rows. Nested and partition columns are not told, nor a column of which any chunk
    lacks statistics; files in a store that Arrow cannot reach tell nothing. Footers are
    read in tasks, and one row for each column comes back.
    """
    base, encoded = folders._qualified(spark, path)
    if not folders._reaches(encoded):
        return {}
    flat = [f.name for f in df.schema if not isinstance(f.dataType, _NESTED)]
    files = folders.listed(spark, path).where(~F.col("is_folder")).select("path")
    tasks = max(1, -(-files.count() // _FILES_PER_TASK))
    counted = files.repartition(tasks).mapInArrow(
        _counting(base, encoded, flat), "name string, nulls long, unknown long"
    )
    total = counted.groupBy("name").agg(F.sum("nulls").alias("nulls"), F.sum("unknown").alias("unknown"))
    return {r["name"]: r["nulls"] for r in total.where("unknown = 0").collect()}


def _counting(base: str, encoded: str, names: Sequence[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = folders._arrow(encoded)
        nulls, unknown = dict.fromkeys(names, 0), dict.fromkeys(names, 0)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with store.open_input_file(root.rstrip("/") + path[len(base) :]) as file:
                    found = _file_nulls(pq.ParquetFile(file), path)
                for name in names:
                    told = found(name)
                    nulls[name] += told or 0
                    unknown[name] += told is None
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(nulls.values(), pa.int64()), pa.array(unknown.values(), pa.int64())],
            ["name", "nulls", "unknown"],
        )

    return run


def _file_nulls(file: pq.ParquetFile, path: str):
    """The NULLs of a column of this name in one file, None where its footer does not tell."""
    metadata = file.metadata
    groups = [metadata.row_group(g) for g in range(metadata.num_row_groups)]
    tops = [f.name.lower() for f in file.schema_arrow]
    places: dict[str, list[int]] = {}
    for at in range(len(metadata.schema)):
        leaf = metadata.schema.column(at)
        places.setdefault(leaf.path.lower(), []).append(at)

    def told(name: str) -> int | None:
        key = name.lower()
        if f"/{key}=" in path.lower():
            return None  # a partition column, or named like one
        if key not in tops:
            return metadata.num_rows
        if tops.count(key) > 1 or len(places.get(key, ())) != 1:
            return None
        chunks = [group.column(places[key][0]).statistics for group in groups]
        if any(s is None or not s.has_null_count for s in chunks):
            return None
        return sum(s.null_count for s in chunks)

    return told
