"""Keep a key that holds very many rows from overloading one shuffle task.

By default nothing is looked for beforehand. Joins carry a hash of the key beside the key,
so that the side with unique keys, which comes out of an aggregation by the key, is
exchanged once more: then both inputs of the join are plain shuffles, and Spark's adaptive
execution can split a partition of the other side, whatever key has filled it.

Where frequent keys are known, or worth a pass to find, operators take them as a value:
``measure_keys`` reads the key columns and returns a ``FrequentKeys``, to be used by any
number of operators on the same key. Those keys are joined against the few matching rows of
the other side, which fit in a broadcast: no more keys than there are shuffle tasks can
hold more than an average task's share each.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecheck.functions.names import any_null, field


@dataclass(frozen=True)
class FrequentKeys:
    """Hashes of keys that hold more than an average shuffle task's rows, and their rows."""

    total: int
    counts: Mapping[int, int]

    def __or__(self, other: FrequentKeys) -> FrequentKeys:
        """Those of two sides, with the larger count of either."""
        both = {
            h: max(self.counts.get(h, 0), other.counts.get(h, 0)) for h in {*self.counts, *other.counts}
        }
        return FrequentKeys(max(self.total, other.total), both)


# Frequent keys to split off: none beforehand (None, False), those that a pass finds (True),
# those measured, or given by hash. ALL_HOT says that the sides hold frequent keys only.
SplitHot = bool | str | FrequentKeys | Collection[int] | None
ALL_HOT = "all"

_HASH = "__key_hash"


def spread(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], null_safe: bool = False
) -> tuple[DataFrame, DataFrame, Column]:
    """Both sides as ``t`` and ``s`` with the hash of their key, and its equality.

    Unless keys compare null-safe, a left row whose key is NULL in part matches nothing,
    so it may go anywhere: such rows are dealt by all they hold, not into one task.
    """
    types = key_types(left, right, on)
    names = [a for a, _ in on]
    key = key_hash(names, types)
    if not null_safe:
        rest = [field(f.name) for f in left.schema if _hashable(f.dataType)]
        key = F.when(any_null([field(a) for a in names]), F.xxhash64(*rest)).otherwise(key)
    t = left.withColumn(_HASH, key).alias("t")
    s = right.withColumn(_HASH, key_hash([b for _, b in on], types)).alias("s")
    return t, s, field(_HASH, "t") == field(_HASH, "s")


def _hashable(kind: T.DataType) -> bool:
    """Whether Spark hashes values of this type: those of maps and variants it does not."""
    return not any(name in kind.simpleString() for name in ("map<", "variant"))


def key_types(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]]) -> list[T.DataType]:
    """Common type of each key pair, as Spark's set operations widen them."""
    both = left.select(*[field(a) for a, _ in on]).union(right.select(*[field(b) for _, b in on]))
    return [f.dataType for f in both.schema]


def key_hash(names: Sequence[str], types: Sequence[T.DataType]) -> Column:
    """64-bit hash of a key, NULL parts included. Equal keys get equal hashes on both sides."""
    parts = []
    for name, kind in zip(names, types):
        part = field(name).cast(kind)
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            part = part + F.lit(0.0).cast(kind)  # -0.0 equals 0.0
        parts.append(part)
    return F.xxhash64(*parts)


def measure_keys(df: DataFrame, keys: Sequence[str]) -> FrequentKeys:
    """The frequent keys of a relation, exactly counted.

    Two passes over the key columns, without a shuffle of keys: frequent-item counters
    give a superset of bounded size, an exact count then confirms it.
    """
    return _measured(df, key_hash(keys, [df.schema[k].dataType for k in keys]))


def _measured(df: DataFrame, key: Column) -> FrequentKeys:
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    limit = max(tasks, 2)
    keys = df.select(key.alias("h"))
    candidates = keys.freqItems(["h"], 1.0 / limit).first()[0]
    if not candidates:
        return FrequentKeys(0, {})
    counted = keys.groupBy(F.when(F.col("h").isin(candidates), F.col("h")).alias("h")).count().collect()
    total = sum(row["count"] for row in counted)
    frequent = {r["h"]: r["count"] for r in counted if r["h"] is not None and r["count"] * limit > total}
    return FrequentKeys(total, frequent)


def hot_hashes(df: DataFrame, key: Column) -> list[int]:
    """Hashes of the keys holding more than an average shuffle task's rows."""
    return sorted(_measured(df, key).counts)


def find_hot(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    split_hot: SplitHot,
    both: bool,
) -> list[int]:
    """Hashes of the frequent keys of the left side or, with ``both``, of either side."""
    if isinstance(split_hot, FrequentKeys):
        return sorted(split_hot.counts)
    if split_hot is None or split_hot is False:
        return []
    if split_hot is not True:
        return sorted(split_hot)
    types = key_types(left, right, on)
    found = set(hot_hashes(left, key_hash([a for a, _ in on], types)))
    if both:
        found |= set(hot_hashes(right, key_hash([b for _, b in on], types)))
    return sorted(found)


def split(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    split_hot: SplitHot,
    both: bool,
) -> list[tuple[DataFrame, DataFrame, bool]]:
    """Parts of the two sides that hold the same keys, each marked frequent or not.

    ``both`` says that the right side may repeat keys too.
    """
    if split_hot == ALL_HOT:
        return [(left, right, True)]
    found = find_hot(left, right, on, split_hot, both)
    if not found:
        return [(left, right, False)]
    types = key_types(left, right, on)
    lhot = key_hash([a for a, _ in on], types).isin(found)
    rhot = key_hash([b for _, b in on], types).isin(found)
    return [
        (left.where(~lhot), right.where(~rhot), False),
        (left.where(lhot), right.where(rhot), True),
    ]
