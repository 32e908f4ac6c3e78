"""Load, create, widen and replace catalog tables."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.functions.names import field, quote
from tablecheck.sources.scratch import stored


_BUCKET = "__bucket"

# Property of a staged copy whose table is at a location of its own.
_LOCATION = "tablecheck.location"


def load(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A catalog table by name, or files by path (anything holding a slash)."""
    if "/" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(quoted(name_or_path))


def quoted(name: str) -> str:
    """Dotted name with each part in backticks, so keywords and hyphens are fine."""
    if "`" in name:
        return name
    return ".".join(f"`{part}`" for part in name.split("."))


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, Sequence[str]] | None = None,
    location: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> bool:
    """Create the table unless it is there; returns whether it was created."""
    name = quoted(name)
    if spark.catalog.tableExists(name):
        return False
    empty = local_rows(spark, [], schema)
    _writer(empty, partition_by, bucket_by, location).saveAsTable(name)
    _set_properties(spark, name, properties or {})
    return True


def local_rows(
    spark: SparkSession, rows: Sequence[Mapping[str, object]], schema: T.StructType | str
) -> DataFrame:
    """A few rows the driver knows, as a relation; missing entries are NULL.

    The rows are a constant in the plan, so Spark knows the relation is small.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    values = F.from_json(F.lit(json.dumps(list(rows))), T.ArrayType(schema))
    return spark.range(1).select(F.inline(values))


def add_columns(df: DataFrame, columns: Mapping[str, str], after: str | None = None) -> DataFrame:
    """Add NULL columns at the end or behind ``after``; those present are kept as they are."""
    known = {c.lower() for c in df.columns}
    new = [
        F.lit(None).cast(kind).alias(name)
        for name, kind in columns.items()
        if name.lower() not in known
    ]
    if after is not None and after.lower() not in known:
        raise ValueError(f"no column {after} to add behind")
    place = len(df.columns)
    if after is not None:
        place = [c.lower() for c in df.columns].index(after.lower()) + 1
    old = [field(c) for c in df.columns]
    return df.select(*old[:place], *new, *old[place:])


def replace_table(
    df: DataFrame, name: str, bucket_by: tuple[int, Sequence[str]] | None = None
) -> None:
    """Store ``df`` as the new content of an existing table.

    The new content is written beside the table, which may be one of its inputs,
    and the two are then swapped by rename. Provider, partitioning, buckets, comment and
    properties are kept; ``bucket_by`` gives it other buckets. The swap is two renames
    and not atomic: a reader in between finds no table, and after a failure in between
    ``recover_table`` brings the former content back. A table at a location of its own
    cannot be renamed there, so its files are written once more from the staged copy,
    which knows the location, should that be cut off. Files of another format at a
    location of their own belong to someone else: replacing them is an error.

    Rows are dealt to tasks by bucket before the write; a partition is written by every task
    that holds rows of it. A bucket with very many rows is written by several tasks.
    """
    spark = df.sparkSession
    recover_table(spark, name)
    partition_by, buckets_now = table_layout(spark, name)
    bucket_by = bucket_by or buckets_now
    properties = table_properties(spark, name)
    detail = table_detail(spark, name)
    if is_foreign(detail):
        raise ValueError(f"{name} holds files of another format at a location of its own")
    fmt = detail.get("Provider", "parquet").lower()
    comment = detail.get("Comment")
    stage, old, name = _beside(name)
    spark.sql(f"DROP TABLE IF EXISTS {stage}")
    _writer(df, partition_by, bucket_by, fmt=fmt).saveAsTable(stage)
    _describe(spark, stage, properties, comment)
    if detail.get("Type") == "EXTERNAL":
        _set_properties(spark, stage, {_LOCATION: detail["Location"]})
        _restore(spark, stage, name, partition_by, bucket_by)
        return
    _rename(spark, name, old)
    _rename(spark, stage, name)
    spark.sql(f"DROP TABLE {old}")


def recover_table(spark: SparkSession, name: str) -> bool:
    """Undo or finish a swap that was cut off; returns whether a missing table came back.

    The former content comes back if it is there, else the staged content, which
    is registered only once it is complete.
    """
    stage, old, name = _beside(name)
    if spark.catalog.tableExists(name):
        spark.sql(f"DROP TABLE IF EXISTS {old}")
        return False
    for kept in (old, stage):
        if spark.catalog.tableExists(kept):
            if _LOCATION in table_properties(spark, kept):
                _restore(spark, kept, name, *table_layout(spark, kept))
            else:
                _rename(spark, kept, name)
            return True
    return False


def is_foreign(detail: Mapping[str, str]) -> bool:
    """Whether a table of these details is files of another format at their own location."""
    return detail.get("Type") == "EXTERNAL" and detail.get("Provider", "").lower() != "parquet"


def _restore(spark: SparkSession, stage: str, name: str, partition_by, bucket_by) -> None:
    """Write the staged copy to the location that it knows, and drop it."""
    properties = table_properties(spark, stage)
    location = properties.pop(_LOCATION)
    comment = table_detail(spark, stage).get("Comment")
    staged = _writer(spark.table(stage), partition_by, bucket_by, location)
    staged.mode("overwrite").saveAsTable(name)
    _describe(spark, name, properties, comment)
    spark.sql(f"DROP TABLE {stage}")


def _describe(
    spark: SparkSession, name: str, properties: Mapping[str, str], comment: str | None
) -> None:
    _set_properties(spark, name, properties)
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {_text(comment)}")


def overwrite_partitions(df: DataFrame, name: str) -> None:
    """Store ``df`` in place of the partitions it has rows of; others stay untouched."""
    spark = df.sparkSession
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        df.write.mode("overwrite").insertInto(quoted(name))
    finally:
        spark.conf.set(mode, before)


# So many partitions are picked by their values; more by a join.
_PICKED = 1000


def rewrite_partitions(
    spark: SparkSession, name: str, touched: DataFrame, change: Callable[[DataFrame], DataFrame]
) -> int:
    """Change the rows of the partitions in ``touched``; returns how many there were.

    ``touched`` holds the partition columns, in any number of rows. Only those partitions
    are read and, after the change is stored beside the table, written; the files of all
    others stay as they are. Rows stay in their partition: the change must not alter the
    partition columns, nor leave out all rows of a partition. The driver holds the touched
    partitions' values, as it does the catalog's.
    """
    partition_by, _ = table_layout(spark, name)
    values = stored(touched.select(*[field(c) for c in partition_by]).distinct(), "touched")
    count = values.count()
    if not count:
        return 0
    rows = load(spark, name)
    if count <= _PICKED:
        picked = [
            reduce(lambda a, b: a & b, [field(c).eqNullSafe(F.lit(row[c])) for c in partition_by])
            for row in values.collect()
        ]
        inside = rows.where(reduce(lambda a, b: a | b, picked))
    else:
        same = [field(c, "t").eqNullSafe(field(c, "s")) for c in partition_by]
        inside = rows.alias("t").join(values.alias("s"), reduce(lambda a, b: a & b, same), "left_semi")
    overwrite_partitions(stored(change(inside).select(*[field(c) for c in rows.columns]), "rewritten"), name)
    spark.catalog.refreshTable(quoted(name))
    return count


def append_rows(df: DataFrame, name: str) -> None:
    """Add rows to a table, in files of their own."""
    table = df.sparkSession.table(quoted(name))
    df.select(*[field(c) for c in table.columns]).write.mode("append").insertInto(quoted(name))


def table_layout(
    spark: SparkSession, name: str
) -> tuple[list[str], tuple[int, list[str]] | None]:
    """Partition columns, and bucket number and columns, of a catalog table."""
    found = table_description(spark, name)
    buckets = found.get("bucket_columns")
    number = found.get("num_buckets")
    return found.get("partition_columns", []), (int(number), buckets) if number and buckets else None


def table_description(spark: SparkSession, name: str) -> dict:
    """What the catalog says of a table, as it is; no text is split."""
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)} AS JSON").first()[0])


# Labels of a table's details and their names in the catalog's description.
_LABELS = {
    "Type": "type",
    "Provider": "provider",
    "Location": "location",
    "Comment": "comment",
    "Num Buckets": "num_buckets",
}


def table_detail(spark: SparkSession, name: str) -> dict[str, str]:
    """Type, provider, location, comment and bucket number of a table, where it has them."""
    found = table_description(spark, name)
    return {label: str(found[key]) for label, key in _LABELS.items() if found.get(key) is not None}


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    """Table properties the user set."""
    return table_description(spark, name).get("table_properties", {})


# Formats whose files name their columns.
_BY_NAME = ("parquet", "orc", "json", "avro")


def lay_out_columns(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Give a table's columns this order and these comments, without touching its files.

    The table stays what it is, with its partitions, buckets and properties; only its
    registered columns change. Files of these formats name their columns, so values keep
    their column. A column left out is no longer shown, though files still hold it.
    Partition columns stay last and keep their comments. Formats that are read by position,
    columns the table lacks and other types are errors: those need a rewrite.
    """
    found = table_description(spark, name)
    if found.get("provider", "").lower() not in _BY_NAME:
        raise ValueError(f"{name}: columns of {found.get('provider')} files go by position")
    now = {f.name: f for f in spark.table(quoted(name)).schema}
    other = [f.name for f in schema if f.name not in now or f.dataType != now[f.name].dataType]
    last = found.get("partition_columns", [])
    lost = [c for c in [*last, *found.get("bucket_columns", [])] if c not in schema.names]
    if other or lost:
        raise ValueError(f"{name}: a rewrite is needed for {', '.join(other + lost)}")
    data = T.StructType([
        T.StructField(f.name, f.dataType, now[f.name].nullable, _commented(now[f.name].metadata, f.metadata))
        for f in schema
        if f.name not in last
    ])
    jvm = spark._jvm.org.apache.spark.sql.types.DataType
    catalog = spark._jsparkSession.sharedState().externalCatalog()
    catalog.alterTableDataSchema(found["namespace"][-1], found["table_name"], jvm.fromJson(data.json()))
    spark.catalog.refreshTable(quoted(name))


def _commented(kept: Mapping, given: Mapping) -> dict:
    """Metadata of a column with the comment that is given, or none."""
    rest = {k: v for k, v in kept.items() if k != "comment"}
    return rest | ({"comment": given["comment"]} if given.get("comment") else {})


def _beside(name: str) -> tuple[str, str, str]:
    """Quoted names of the staged, the former and the table itself."""
    return quoted(f"{name}__stage"), quoted(f"{name}__old"), quoted(name)


def _set_properties(spark: SparkSession, name: str, properties: Mapping[str, str]) -> None:
    if properties:
        pairs = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def _rename(spark: SparkSession, name: str, new_name: str) -> None:
    spark.sql(f"ALTER TABLE {name} RENAME TO {new_name}")
    if any(c.isPartition for c in spark.catalog.listColumns(new_name)):
        # partitions are listed with their former paths until they are synced
        spark.sql(f"MSCK REPAIR TABLE {new_name} SYNC PARTITIONS")


def _writer(df, partition_by, bucket_by, location=None, fmt="parquet"):
    if bucket_by:
        df = _dealt_by_bucket(df, *bucket_by)
    writer = df.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        number, columns = bucket_by
        writer = writer.bucketBy(number, list(columns))
    if location:
        writer = writer.option("path", location)
    return writer


def _dealt_by_bucket(df: DataFrame, number: int, columns: Sequence[str]) -> DataFrame:
    """Rows dealt to tasks by bucket, so that a bucket is one file and not one for each task.

    The exchange is one that Spark may rebalance: small buckets share a task, and a bucket
    that has filled far more than a task's share is split over several, a file for each.
    """
    bucket = F.pmod(F.hash(*[field(c) for c in columns]), F.lit(number))
    dealt = df.withColumn(_BUCKET, bucket).hint("rebalance", F.col(_BUCKET))
    return dealt.select(*[field(c) for c in df.columns])


def _text(value: str) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
