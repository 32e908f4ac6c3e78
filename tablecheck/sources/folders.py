"""Land files folder by folder, each folder once.

Folders are listed level by level, large levels in tasks. A folder that has landed is
dropped before it is listed, so a run costs what is new, and not what is there.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.sources.dictionary import LEDGER
from tablecheck.sources.scratch import stored
from tablecheck.sources.tables import local_rows

# What lies directly in a folder below a base.
ENTRY = T.StructType(
    [
        T.StructField("base", T.StringType()),
        T.StructField("folder", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("is_folder", T.BooleanType()),
        T.StructField("length", T.LongType()),
    ]
)
_LEVEL = "base string, folder string"
# Folders that one task lists, and so many that the driver lists by itself, unless they
# hold more entries than that.
_FOLDERS_PER_TASK = 64
_ENTRIES_ON_DRIVER = 10_000
_ROWS_PER_BATCH = 4096


def new_folders(spark: SparkSession, path: str, ledger: DataFrame | None) -> DataFrame:
    """Folders below ``path`` that hold files and are not in the ledger."""
    files = listed(spark, path, ledger).where(~F.col("is_folder"))
    found = files.select("folder").distinct()
    return found if ledger is None else found.join(ledger, "folder", "left_anti")


def listed(
    spark: SparkSession, paths: str | Sequence[str], ledger: DataFrame | None = None
) -> DataFrame:
    """Rows (base, folder, path, is_folder, length): what lies below one path or several.

    Folders of the ledger are named, but not gone into, unless the ledger holds a folder
    below them: such a one holds folders beside its files and may have got more. A folder
    that had none when it landed is closed, with all that is ever put below it. Names that
    file sources pass over are passed over here.

    A level of a few folders with a few thousand entries is listed by the driver, as file
    sources list them; larger ones are listed in tasks, and neither their folders nor their
    names come to the driver. Only a store that Arrow cannot reach from a task is listed
    through Spark's own file system throughout. A path that does not exist is an error.
    """
    bases = dict(_qualified(spark, p) for p in ([paths] if isinstance(paths, str) else paths))
    closed = None
    if ledger is not None:
        closed = _closed(ledger.select("folder"), next(iter(bases)))
    spread = all(_reaches(encoded) for encoded in bases.values())
    level: DataFrame | list = [{"base": base, "folder": base} for base in bases]
    count, parts, rows = len(level), [], []
    while count:
        found = None
        if isinstance(level, list):
            found = _driver_listing(spark, level, bases, None if not spread else _ENTRIES_ON_DRIVER)
        if found is not None:
            rows += found
            inner = [{"base": r[0], "folder": r[2]} for r in found if r[3]]
            if closed is not None and inner:
                below = spark.createDataFrame(inner, _LEVEL).join(closed, "folder", "left_anti")
                inner = [r.asDict() for r in below.collect()]
            level, count = inner, len(inner)
            if spread and count > _FOLDERS_PER_TASK:
                level = spark.createDataFrame(inner, _LEVEL)
            continue
        if isinstance(level, list):
            level = spark.createDataFrame(level, _LEVEL)
        level = level.repartition(-(-count // _FOLDERS_PER_TASK))
        found = stored(level.mapInArrow(_listing(bases), ENTRY), "listing")
        parts.append(found)
        level = found.where("is_folder").select("base", F.col("path").alias("folder"))
        if closed is not None:
            level = level.join(closed, "folder", "left_anti").select("base", "folder")
        count = level.count()
    return reduce(DataFrame.unionByName, [spark.createDataFrame(rows, ENTRY), *parts])


def _closed(ledger: DataFrame, base: str) -> DataFrame:
    """Landed folders without landed ones below them."""
    parts = F.split(F.substring(F.col("folder"), len(base) + 2, 1 << 30), "/")
    above = F.transform(  # from the base down to the folder that holds it
        F.sequence(F.lit(0), F.size(parts) - 1),
        lambda n: F.concat_ws("/", F.lit(base), F.slice(parts, 1, n)),
    )
    below = ledger.where(F.startswith("folder", F.lit(f"{base}/")))
    inner = below.select(F.explode(above).alias("folder")).distinct()
    return ledger.distinct().join(inner, "folder", "left_anti")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or a folder at the path."""
    store, at = _store(spark, path)
    return store.exists(at)


def base_of(spark: SparkSession, path: str) -> str:
    """The name by which a listing calls a path."""
    return _qualified(spark, path)[0]


def _qualified(spark: SparkSession, path: str) -> tuple[str, str]:
    """The path with its scheme, as Spark names files, and encoded as a URI."""
    store, at = _store(spark, path)
    full = store.makeQualified(at)
    return full.toString().rstrip("/"), full.toUri().toString()


def _store(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def _arrow(encoded: str) -> tuple[pafs.FileSystem, str]:
    if encoded.startswith("file:/") and not encoded.startswith("file://"):
        encoded = "file://" + encoded[len("file:") :]
    return pafs.FileSystem.from_uri(encoded)


def _reaches(encoded: str) -> bool:
    try:
        store, at = _arrow(encoded)
        return store.get_file_info(at).type != pafs.FileType.NotFound
    except (OSError, ValueError, NotImplementedError):
        return False


def _hidden(name: str) -> bool:
    """Whether file sources pass over a name."""
    return name.startswith(".") or name.endswith("._COPYING_") or (name[:1] == "_" and "=" not in name)


def _listing(bases: dict[str, str]):
    """Entries of folders, listed in a task; ``bases`` maps each base to its URI."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stores: dict[str, tuple] = {}
        for batch in batches:
            for base, folder in zip(batch.column("base").to_pylist(), batch.column("folder").to_pylist()):
                if base not in stores:
                    stores[base] = _arrow(bases[base])
                rows = _entries(*stores[base], base, folder)
                for at in range(0, len(rows), _ROWS_PER_BATCH):
                    columns = zip(*rows[at : at + _ROWS_PER_BATCH])
                    kinds = (pa.string(), pa.string(), pa.string(), pa.bool_(), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds)], ENTRY.names
                    )

    return run


def _entries(store: pafs.FileSystem, root: str, base: str, folder: str) -> list[tuple]:
    inside = store.get_file_info(pafs.FileSelector(root.rstrip("/") + folder[len(base) :]))
    return [
        (base, folder, f"{folder}/{x.base_name}", x.type == pafs.FileType.Directory, x.size or 0)
        for x in inside
        if not _hidden(x.base_name)
    ]


def _driver_listing(
    spark: SparkSession, level: list[dict], bases: dict[str, str], most: int | None
) -> list[tuple] | None:
    """Entries of a few folders; none if there are more than ``most``."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    stores = {base: _store(spark, base)[0] for base in {row["base"] for row in level}}
    rows = []
    for row in level:
        inside = stores[row["base"]].listStatusIterator(path(row["folder"]))
        while inside.hasNext():
            if most is not None and len(rows) >= most:
                return None
            status = inside.next()
            if not _hidden(status.getPath().getName()):
                name = status.getPath().toString()
                rows.append((row["base"], row["folder"], name, status.isDirectory(), status.getLen()))
    return rows


def read_folders(
    spark: SparkSession,
    path: str,
    names: Sequence[str],
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """Rows of these folders below ``path``, with the folder each came from.

    With a ``schema`` new files never alter it: other columns are not read, missing ones
    are NULL. Without one the files' own schema is taken; of Parquet files that differ, the
    one that all of them fit (see ``schemas``). Files whose types differ from the schema are
    read by their own and cast, values that don't fit being NULL. Partition values in folder
    names become columns.
    """
    if not names:
        fields = schema.fields if schema else []
        return local_rows(spark, [], T.StructType([*fields, *LEDGER.fields]))
    reader = spark.read.format(fmt).option("basePath", path).options(**options)
    # the listing gives plain paths, this column encoded ones; plus signs stay plus signs
    path_of = F.url_decode(F.regexp_replace("_metadata.file_path", r"\+", "%2B"))
    folder = F.regexp_replace(path_of, "/[^/]*$", "").alias("folder")
    if fmt == "parquet":
        from tablecheck.sources import schemas  # which lists folders itself

        found = schemas.files_by_schema(spark, path, names)
        kinds = [T.StructType.fromJson(json.loads(kind)) for kind in found]
        if schema is None and kinds:
            schema = schemas.widest(kinds)
            partitions = [f for f in reader.load(list(names)).schema if f.name not in schema.names]
            schema = T.StructType([*schema, *partitions])
        if any(f.dataType != g.dataType for kind in kinds for f in kind for g in schema if f.name == g.name):
            parts = []
            for kind, files in zip(kinds, found.values()):
                rows = reader.schema(_with_partitions(kind, schema)).load(files)
                parts.append(rows.select(*schemas.fitted(rows, schema), folder))
            return reduce(DataFrame.unionByName, parts)
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt == "csv":
        reader = reader.option("inferSchema", "true")
    return reader.load(list(names)).select("*", folder)


def _with_partitions(own: T.StructType, schema: T.StructType) -> T.StructType:
    """A file's own columns, and those of the table that its folder may name."""
    known = {f.name.lower() for f in own}
    return T.StructType([*own, *[f for f in schema if f.name.lower() not in known]])


def land_new_folders(
    spark: SparkSession,
    path: str,
    ledger: DataFrame | None,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """Rows of the folders not landed before, with the folder each came from.

    Only new folders are read; the driver holds their names, as it does for any file
    source. ``batch.land_files`` takes them in rounds of bounded size. Add the result of
    ``new_folders`` to the ledger after the rows are stored.
    """
    found = [row["folder"] for row in new_folders(spark, path, ledger).collect()]
    return read_folders(spark, path, found, fmt, schema, **options)
