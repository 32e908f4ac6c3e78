"""What the operators of this package share: inputs, splits and scratch tables."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tablecheck.functions.names import field
from tablecheck.sources.scratch import stored

__all__ = [
    "Memory", "bytes_of", "id_remainder", "mapped", "read", "rows_of", "ship", "stored", "text_of", "turn_of"
]


class Memory(dict):
    """What a worker remembers between rows, up to a number of bytes.

    Subclasses say in ``__missing__`` what to remember, and put it there by ``keep``. Beyond
    ``most`` bytes all is forgotten. A worker serves one task after the other, whatever
    operator they are of; each calls ``turn_of`` first, which makes the others' memories
    forget, so those of one operator only count.
    """

    ENTRY_BYTES = 180  # of a slot, and of the objects of a small key and value
    _all: dict[str, list[Memory]] = {}

    def __init__(self, owner: str, most: int) -> None:
        super().__init__()
        self.most, self.used = most, 0
        self._all.setdefault(owner, []).append(self)

    def keep(self, key, value, size: int = 0):
        """Remember a value; ``size`` is what key and value take beyond a small entry."""
        self.used += self.ENTRY_BYTES + size
        if self.used > self.most:
            self.clear()
            self.used = self.ENTRY_BYTES + size
        self[key] = value
        return value


def turn_of(*owners: str) -> None:
    """From here on this worker serves these operators: what others remember is forgotten."""
    for owner, memories in Memory._all.items():
        if owner not in owners:
            for memory in memories:
                memory.clear()
                memory.used = 0


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_of(name: str) -> Column:
    """A text column, null as the empty text."""
    return F.coalesce(field(name).cast("string"), F.lit(""))


def bytes_of(name: str) -> Column:
    """The UTF-8 bytes of a text column, null as none."""
    return text_of(name).cast("binary")


def id_remainder(name: str, divisor: int) -> Column:
    """crc32 of an id as text, modulo ``divisor``; a null id counts as the text ''."""
    return F.crc32(bytes_of(name)) % divisor


def rows_of(df: DataFrame, **columns: Column) -> DataFrame:
    """Only these columns, under names of our own, so names in ``df`` cannot clash."""
    return df.select(*[column.alias(name) for name, column in columns.items()])


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, wherever it is not installed there."""
    context = spark.sparkContext
    if getattr(context, "_tablecheck_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(), "tablecheck.zip")
    with zipfile.ZipFile(archive, "w") as bundle:
        for folder, _, names in os.walk(root):
            for name in (n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                bundle.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._tablecheck_shipped = True


def mapped(
    df: DataFrame, function: Callable[[], Callable[[dict], dict]], schema: str, rows: int = 512
) -> DataFrame:
    """Rows mapped in blocks of ``rows``, as columns of Python values.

    ``function()`` is called once for each task and returns what maps a block.
    """
    struct = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, arrow = function(), to_arrow_schema(struct)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                out = block(batch.slice(at, rows).to_pydict())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], f.type) for f in arrow], schema=arrow
                )

    return df.mapInArrow(run, struct)
