"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows of equal text form a group, which stays together. Groups enter bins from the
largest to the smallest; each takes the bin with the tightest remaining capacity that
still holds it, found in a balanced tree of remaining capacities. Packing runs twice:
groups are dealt by hash to tasks that pack them into fixed-capacity packs, then the
packs, a few thousand at most besides one for each task of the first step, are packed
into as few shards as the capacity allows. No group, shard or table passes through
one task whole: tasks see sizes, never texts, and a group is one row to them.

Edge cases: a null text counts as the empty one (size 1 with the one added byte); an
empty table gives no rows; a null id is kept and gets a slot like any other; repeated
rows are rows of their own in the same group; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablecheck.functions.names import field
from tablecheck.llm.common import bytes_of, rows_of, stored

PACKS_PER_SHARD = 512
GROUPS_PER_TASK = 65_536
ROWS_PER_SLICE = 65_536


class CapacityTree:
    """An AVL tree of (remaining capacity, bin), for tightest-fit lookups."""

    def __init__(self) -> None:
        self.root: list | None = None  # [key, left, right, height]

    def add(self, key: tuple[int, int]) -> None:
        self.root = self._add(self.root, key)

    def pop_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the smallest key whose capacity is at least ``size``."""
        node, found = self.root, None
        while node is not None:
            if node[0][0] >= size:
                found, node = node[0], node[1]
            else:
                node = node[2]
        if found is not None:
            self.root = self._remove(self.root, found)
        return found

    def _add(self, node: list | None, key: tuple[int, int]) -> list:
        if node is None:
            return [key, None, None, 1]
        side = 1 if key < node[0] else 2
        node[side] = self._add(node[side], key)
        return self._balanced(node)

    def _remove(self, node: list, key: tuple[int, int]) -> list | None:
        if key != node[0]:
            side = 1 if key < node[0] else 2
            node[side] = self._remove(node[side], key)
            return self._balanced(node)
        if node[1] is None or node[2] is None:
            return node[1] or node[2]
        least = node[2]
        while least[1] is not None:
            least = least[1]
        node[0] = least[0]
        node[2] = self._remove(node[2], least[0])
        return self._balanced(node)

    def _balanced(self, node: list) -> list:
        lean = _height(node[1]) - _height(node[2])
        if lean > 1:
            if _height(node[1][1]) < _height(node[1][2]):
                node[1] = _turned(node[1], 2)
            node = _turned(node, 1)
        elif lean < -1:
            if _height(node[2][2]) < _height(node[2][1]):
                node[2] = _turned(node[2], 1)
            node = _turned(node, 2)
        else:
            node[3] = 1 + max(_height(node[1]), _height(node[2]))
        return node


def _height(node: list | None) -> int:
    return node[3] if node is not None else 0


def _turned(node: list, side: int) -> list:
    """The child on this side lifted above its parent."""
    other = 3 - side
    top = node[side]
    node[side], top[other] = top[other], node
    node[3] = 1 + max(_height(node[1]), _height(node[2]))
    top[3] = 1 + max(_height(top[1]), _height(top[2]))
    return top


def best_fit_decreasing(sizes: Sequence[int], capacity: int) -> list[int]:
    """The bin of each item; an item over the capacity fills a bin of its own."""
    tree, bins, chosen = CapacityTree(), 0, [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.pop_tightest(sizes[i])
        if found is None:
            found, bins = (max(capacity, sizes[i]), bins), bins + 1
        chosen[i] = found[1]
        tree.add((found[0] - sizes[i], found[1]))
    return chosen


def smallest_capacity(sizes: Sequence[int], bins: int) -> list[int]:
    """Bins of the items at the smallest capacity found that needs ``bins`` at most."""
    low = max([1, math.ceil(sum(sizes) / bins), *sizes])
    step = max(1, low // 100_000)
    high = low
    while max(best := best_fit_decreasing(sizes, high), default=0) >= bins:
        low, high, step = high + 1, high + step, 2 * step
    while low < high:
        middle = (low + high) // 2
        if max(tried := best_fit_decreasing(sizes, middle), default=0) < bins:
            high, best = middle, tried
        else:
            low = middle + 1
    return best


def shard_by_size(
    df: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (doc_id, size, text_crc32, shard, slot, pack) with near equal bytes a shard.

    Slots count a shard's rows from 0 without gaps. Equal texts share a shard, so a
    shard can only be larger than its share where one group is.
    """
    rows = stored(
        rows_of(
            df,
            doc_id=field(id_col),
            size=F.octet_length(bytes_of(text_col)).cast("long") + 1,
            text_crc32=F.crc32(bytes_of(text_col)),
            text_key=F.unhex(F.substring(F.sha2(bytes_of(text_col), 256), 1, 32)),
        ),
        "shard-rows",
    )
    count, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    slices = max(64, math.ceil(count / ROWS_PER_SLICE))
    rows = rows.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(slices)))
    parts = stored(
        rows.groupBy("text_key", "slice").agg(
            F.count("*").alias("rows"), F.sum("size").alias("bytes")
        ),
        "shard-parts",
    )
    groups = parts.groupBy("text_key").agg(
        F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")
    )
    capacity = max(1, total // (shards * PACKS_PER_SHARD))
    tasks = max(1, math.ceil(count / GROUPS_PER_TASK))
    packed = stored(
        groups.withColumn("task", F.pmod(F.xxhash64("text_key"), F.lit(tasks)))
        .groupBy("task")
        .applyInPandas(
            lambda pdf: _packs(pdf, capacity),
            "text_key binary, pack long, start long, rows long, bytes long",
        ),
        "shard-packs",
    )
    packs = (
        packed.groupBy("pack")
        .agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"))
        .groupBy(F.lit(0).alias("all"))
        .applyInPandas(lambda pdf: _shards(pdf, shards), "pack long, shard int, first long")
    )
    before = Window.partitionBy("text_key").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        parts.select(
            "text_key", "slice", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("earlier")
        )
        .join(packed.select("text_key", "pack", "start"), "text_key")
        .join(packs, "pack")
        .select(
            "text_key",
            "slice",
            "pack",
            "shard",
            (F.col("first") + F.col("start") + F.col("earlier")).alias("base"),
        )
    )
    place = F.row_number().over(
        Window.partitionBy("text_key", "slice").orderBy("doc_id", "text_crc32")
    )
    return (
        rows.withColumn("place", place - 1)
        .join(starts, ["text_key", "slice"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "shard",
            (F.col("base") + F.col("place")).alias("slot"),
            "pack",
        )
    )


def _packs(pdf: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """One task's groups in packs, with the rows that stand before each in its pack."""
    pdf = pdf.sort_values(["bytes", "text_key"], ascending=False, ignore_index=True)
    chosen = best_fit_decreasing(pdf["bytes"].tolist(), capacity)
    pdf["pack"] = [(int(pdf["task"].iloc[0]) << 32) + x for x in chosen]
    pdf["start"] = pdf.groupby("pack")["rows"].cumsum() - pdf["rows"]
    return pdf[["text_key", "pack", "start", "rows", "bytes"]]


def _shards(pdf: pd.DataFrame, shards: int) -> pd.DataFrame:
    """The packs' shards, with the rows that stand before each in its shard."""
    pdf = pdf.sort_values(["bytes", "pack"], ascending=[False, True], ignore_index=True)
    pdf["shard"] = smallest_capacity(pdf["bytes"].tolist(), shards)
    pdf["first"] = pdf.groupby("shard")["rows"].cumsum() - pdf["rows"]
    return pdf[["pack", "shard", "first"]]
